"""Operators of a training-data pipeline: de-duplication, search, tokens,
decontamination, packing, quality and licence scans.

Nothing outside this package imports it.  ``llm.catalog`` holds the registered
queries and their SQL.
"""
