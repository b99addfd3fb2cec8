"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage. Each operator takes and returns DataFrames; Python runs inside
tasks on Arrow batches, and Spark partitions and shuffles the work.
"""
