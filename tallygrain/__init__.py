"""Exploratory analytics on Spark DataFrames: profiling, cleaning, ranking, forecasting, recommending, modelling."""
