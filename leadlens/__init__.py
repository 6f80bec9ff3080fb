"""leadlens: lead-time and bottleneck analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
