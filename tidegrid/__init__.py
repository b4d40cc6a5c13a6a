"""Spark jobs over daily gridded time series kept as long, day-partitioned DataFrames."""
