"""Training-data operators: mixing, counting, sharding, deduplication, extraction and packing."""
