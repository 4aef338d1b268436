"""Operators for training data: cleaning, deduplication, mixing, tokenising, packing and sharding of documents."""
