"""cadenza: music-consumption analytics as plain functions over Spark DataFrames."""
