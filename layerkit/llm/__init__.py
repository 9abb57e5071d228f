"""Operators and queries for building training data from raw documents and pages."""
