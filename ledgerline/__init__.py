"""Spark-native marketplace sales analytics: drift-tolerant ingest, canonical
sales table, marts, reports and streaming ingest on PySpark DataFrames."""

__version__ = "0.1.0"
