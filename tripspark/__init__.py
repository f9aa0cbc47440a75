"""Table-in, table-out operators for vehicle sensor telemetry on Spark."""

__version__ = "0.1.0"
