"""Operators for training-data corpora: duplicates, decontamination, quality, language, packing, sharding, token files."""
