"""Operators of a training-data pipeline: quality, secrets, search, language, mixing, deduplication, counting and packing."""
