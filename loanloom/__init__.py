"""Tabular default-risk analytics as Spark DataFrame operators."""
