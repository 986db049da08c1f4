"""meterflow: smart-meter feeder data engineering and analytics on Spark."""

__version__ = "0.1.0"
