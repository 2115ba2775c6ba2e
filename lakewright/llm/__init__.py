"""Training-data operators: quality, dedup, mixing, packing, archives, retrieval."""
