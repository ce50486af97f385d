"""Operators of a training-data pipeline: packing, deduplication, language,
decontamination, toxicity, similarity joins, extraction and quality."""
