"""Operators of a training-data pipeline: deduplication, extraction, tokenising, filtering.

Every operator takes and returns DataFrames; nothing outside this subpackage imports it.
"""
