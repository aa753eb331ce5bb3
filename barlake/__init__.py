"""Spark-native operators and jobs for securities market data.

Every operator is a plain function from DataFrames to a DataFrame with the key and
value column names as parameters, so it composes with ``DataFrame.transform`` and is
planned by Catalyst together with whatever surrounds it.
"""
