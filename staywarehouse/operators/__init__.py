"""Warehouse operators: functions from DataFrames to DataFrames."""
