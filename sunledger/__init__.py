"""Telemetry ingestion and data quality as Spark DataFrame jobs."""
