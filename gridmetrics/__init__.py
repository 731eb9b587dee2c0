"""Statistics, rankings and day profiles of hourly energy measurements, as Spark DataFrames."""
