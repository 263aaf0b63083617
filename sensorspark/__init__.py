"""DataFrame operators for multi-site sensor time series on Apache Spark."""

__version__ = "0.1.0"
