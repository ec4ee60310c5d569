"""Operators: DataFrame -> DataFrame."""
