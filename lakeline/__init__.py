"""Lakeline: order, payment and courier analytics on Spark DataFrames."""

__version__ = "0.1.0"
