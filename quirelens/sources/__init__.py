"""Readers of packed files, file lists, volume and concept records, and side tables."""
