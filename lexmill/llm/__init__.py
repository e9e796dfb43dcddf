"""Operators of a training-data pipeline: language, quality, secrets, duplicates,
nearest neighbours, byte-pair ids, scoring and packing.

Nothing else in the library imports this subpackage. Every operator takes and gives
DataFrames; ``queries`` binds them to the given tables.
"""
