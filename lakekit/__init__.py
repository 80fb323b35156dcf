"""lakekit — Spark-native operators for building trustworthy analytical lakes from batch-arriving files."""

__version__ = "0.1.0"
