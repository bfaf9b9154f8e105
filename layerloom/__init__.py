"""Layered data-warehouse operators written as lazy PySpark DataFrame functions."""
