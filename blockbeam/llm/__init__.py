"""Training-data operators: quality, language, sharding, mixing, dedup, packing, scans."""
