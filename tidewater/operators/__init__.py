"""Operators: models and user-level DataFrame jobs, DataFrame -> DataFrame."""
