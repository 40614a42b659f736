"""Training-data operators: language, fingerprints, extraction, dedup, mixing, quality, sharding."""
