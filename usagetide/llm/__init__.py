"""Operators for training-data pipelines: filtering, scoring, deduplication, sharding, packing, archives.

Nothing outside this package imports it. ``queries`` holds one named query per operator.
"""
