"""Real-time commerce analytics as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame``; the same function
body runs on batch tables and, where state is needed, inside a Structured
Streaming query (see :mod:`shopstream.streaming`).
"""

__all__ = ["session", "schemas", "fixtures"]
