"""Operators for large text corpora: fingerprints, scans, packing, shards, classifiers, extraction, duplicates, files."""
