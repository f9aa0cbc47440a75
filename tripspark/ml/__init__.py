"""Regression models over the trip table, on Spark ML."""
