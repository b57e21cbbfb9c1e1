"""Area-level data integration and analytics on Spark DataFrames."""
