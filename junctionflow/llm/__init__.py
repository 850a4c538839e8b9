"""Operators of a training-data pipeline (filtering, dedup, scoring, mixing, search).

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
only when it is present.
"""
