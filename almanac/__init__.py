"""almanac: lookups over a multilingual encyclopedic corpus, as Spark DataFrames."""
