"""Record linkage, curation and graph analytics on Spark DataFrames."""
