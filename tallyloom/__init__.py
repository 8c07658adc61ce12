"""Spark-first KPI analytics."""
