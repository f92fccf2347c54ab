"""Operators over DataFrames: aggregates, joins, windows, metrics, catalogs and kernels."""
