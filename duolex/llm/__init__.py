"""Operators for preparing training data at scale: sharding, dedup, packing, mixing, scoring."""
