"""Sensor telemetry analytics as PySpark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; the same functions
serve batch tables and Structured Streaming.  Only ``fieldpulse.streaming``
starts queries.
"""
