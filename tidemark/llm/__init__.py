"""Training-data operators: dedup, scoring, search, packing and mixing on Spark."""
