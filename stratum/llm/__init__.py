"""Operators of a training-data pipeline: scans, formatting, scoring, mixing,
deduplication, decontamination and exact vector search.

Nothing outside this package imports it; ``queries`` holds its registered
queries and ``corpus_pipeline.py`` (repository top) chains five of them.
"""
