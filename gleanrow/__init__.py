"""Record linkage, position fusion and semi-structured extraction on Spark DataFrames."""
