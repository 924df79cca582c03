"""Taxi-trip and weather analytics as lazy PySpark DataFrames."""
