"""Bedside: clinical time series and corpus preparation as Spark DataFrame jobs."""
