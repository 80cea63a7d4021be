"""Operators of a training-data pipeline: extract, filter, deduplicate, encode, pack.

Nothing outside this package imports it, apart from the guarded registration.
"""
