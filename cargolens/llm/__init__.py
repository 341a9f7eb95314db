"""Operators of a training-data pipeline. Nothing outside this folder (but the
guarded registration in ``__spark_entry__``) imports it."""
