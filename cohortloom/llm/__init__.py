"""Operators of a training-data pipeline. Nothing outside this package and corpus_pipeline.py imports it."""
