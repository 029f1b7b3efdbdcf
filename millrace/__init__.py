"""Standardization, conformance and data-quality jobs written as Spark DataFrame plans."""
