"""Operators that prepare training data for language models.

Nothing outside this package imports it. Every operator takes DataFrames and returns
DataFrames; ``queries`` holds the thin registered queries, ``oracle`` their SQL.
"""
