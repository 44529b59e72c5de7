"""Spark-native QC, cost and agreement analytics.

Every operator is a function from DataFrames to a DataFrame; column names are parameters, so the same operator
runs on the record tables of :mod:`tidemark.schemas` and on any table of the same shape.
"""
