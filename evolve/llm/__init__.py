"""Operators for large text corpora and their embeddings.

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames; where one works in Arrow batches, Spark partitions and shuffles the
rows and the Python part sees a bounded slice of them at a time.
"""
