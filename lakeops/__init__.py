"""Batch ETL, data-quality and reporting operators for PySpark."""
