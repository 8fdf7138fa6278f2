"""Monitoring-session analytics on Spark DataFrames."""
