"""Column functions: time base and cleaning."""
