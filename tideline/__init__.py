"""Forecasting of many related daily series with Spark DataFrames.

Every stage takes DataFrames that hold all series at once and returns DataFrames; the series
key is an ordinary column, never a loop variable.
"""
