"""Operators of a training-data pipeline: scoring, deduplication, search,
packing, language identification and source mixing over whole tables."""
