"""geoloom: geospatial aggregation and corpus preparation on Spark DataFrames."""
