"""Data-quality checks for SAP-style master data, run as Spark jobs."""
