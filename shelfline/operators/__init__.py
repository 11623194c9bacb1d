"""Reusable column and row operators: money, newest-per-key, expectations."""
