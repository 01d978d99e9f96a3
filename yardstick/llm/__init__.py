"""Operators of a large-scale training-data pipeline (quality, dedup, scoring, mixing, packing, sharding).

Nothing outside this package imports it; `registry` lists the queries.
"""
