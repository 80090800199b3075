"""Daily, reprojected climate fields from hourly gridded data, as Spark DataFrames."""
