"""Layered, audited batch ETL as PySpark DataFrame operators."""
