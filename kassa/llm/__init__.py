"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames, reads whole texts, and keeps per-task memory bounded by
slicing its input into blocks of a few megabytes (a single longer document is
its own block).
"""
