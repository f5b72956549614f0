"""Layered lakehouse tables on plain Spark DataFrames.

``sources`` read files, tables and databases, ``operators`` transform DataFrames,
``functions`` are column expressions, ``sinks`` write tables and serving databases,
``plans`` put them together for the order, trip and sales data sets.
"""
