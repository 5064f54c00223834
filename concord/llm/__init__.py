"""Operators for preparing training data, each with a query over the given tables."""
