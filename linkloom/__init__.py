"""Spark-native record linkage: ingest, normalise, block, score, band, persist, evaluate."""
