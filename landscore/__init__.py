"""Spark-first engine for multi-scale environmental time series."""
