"""lossline — a Spark-native claims lakehouse: bronze ingest, silver quality,
gold loss ratios, dashboard marts and business questions as DataFrame jobs."""

__version__ = "0.1.0"
