"""Clickstream purchase-intent analytics as PySpark DataFrame operators."""
