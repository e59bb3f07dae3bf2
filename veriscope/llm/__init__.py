"""Training-data operators: deduplication, filtering, sharding, mixing and token output."""
