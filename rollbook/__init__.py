"""Education-records analytics on Spark DataFrames.

Operators are plain functions ``f(df, ..., params) -> DataFrame`` with column names as
parameters, so they run on any table with the right grain.
"""
