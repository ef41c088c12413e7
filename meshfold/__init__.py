"""Spatial analytics over Spark DataFrames.

Geometry lives in plain columns (see ``meshfold.functions.geometry``), every
operator takes and returns DataFrames, and predicates are Column expressions,
so Catalyst sees the whole plan.
"""
