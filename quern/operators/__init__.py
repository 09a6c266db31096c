"""Operators: every function takes DataFrames and returns a DataFrame."""

from quern.operators import agg, bloom, joins, layout, metrics, sizing

__all__ = ["agg", "bloom", "joins", "layout", "metrics", "sizing"]
