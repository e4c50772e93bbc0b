"""Retail medallion analytics as PySpark DataFrame operators."""
