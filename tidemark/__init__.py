"""Tidemark: financial time series on Spark, from raw payloads to marts."""
