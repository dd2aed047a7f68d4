"""Audit operators: functions from DataFrames to DataFrames."""
