"""Operators on events, time axes and signals."""
