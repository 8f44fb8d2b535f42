"""Hierarchical retail demand forecasting tables on Spark DataFrames."""
