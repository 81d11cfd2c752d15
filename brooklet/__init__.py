"""Brooklet: ingest and analyse shop activity events with Spark.

Everything here takes and returns DataFrames; the caller owns the session.
"""
