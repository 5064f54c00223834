"""Golden-record consolidation of overlapping listing feeds, on Spark DataFrames."""
