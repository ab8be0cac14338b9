"""Hourly air-quality and weather panels on Spark: checks, features, splits, forecasts, drift, alerts."""
