"""Operators of a training-data pipeline: token counts, language and quality
models, deduplication, packing, vector search and sharding.

Nothing outside this subpackage imports it.  Operators take and return
DataFrames; Python code runs inside Spark tasks on bounded Arrow batches.
"""
