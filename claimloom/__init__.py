"""claimloom: curate collections of fact-checked claims with Spark DataFrames."""
