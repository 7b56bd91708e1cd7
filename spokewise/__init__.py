"""Batch retail analytics on PySpark: clean, audit, aggregate, forecast, segment, recommend."""
