"""Layered service-operations analytics on Spark: raw -> clean -> analytics."""
