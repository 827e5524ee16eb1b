"""Commerce warehouse on Spark: raw order files in, a star of dimensions and facts, reports out."""
