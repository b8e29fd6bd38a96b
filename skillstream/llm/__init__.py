"""Training-data operators (mixing, near-dedup, sharding, quality, tokenisers, classifiers, extraction)."""
