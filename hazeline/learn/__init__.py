"""Spark ML forecasts of the index change one to three days ahead."""
