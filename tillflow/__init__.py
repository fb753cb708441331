"""Retail revenue analytics and forecasting as plain Spark DataFrame functions."""
