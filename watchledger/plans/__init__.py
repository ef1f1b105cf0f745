"""The models: functions from DataFrames to DataFrames."""
