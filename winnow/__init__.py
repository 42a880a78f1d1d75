"""Data cleaning and profiling as Spark jobs.

Every step fits with a few fused aggregations into a small frozen model and is applied
as a projection or filter, so the same model serves batch tables and streams.
"""
