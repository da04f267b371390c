"""Sensor and metric analytics on Spark DataFrames."""
