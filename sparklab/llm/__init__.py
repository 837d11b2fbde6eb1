"""Operators for training-data pipelines over text corpora.

Each module holds one operator with a general interface (DataFrame in, DataFrame out); ``queries`` holds the thin
queries over the fixture tables.  Python work runs inside Arrow batches that Spark partitions and shuffles.
"""
