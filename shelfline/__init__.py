"""Retail lakehouse analytics as plain PySpark DataFrame functions."""
