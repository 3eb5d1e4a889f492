"""Panel analytics and forecasting written as Spark DataFrame operators.

``sources`` reads and writes tables, ``functions`` holds column expressions,
``operators`` turns DataFrames into DataFrames, ``plans`` registers the queries.
"""
