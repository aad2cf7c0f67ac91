"""The registered queries, each with its DuckDB counterpart where SQL can express it."""

from millrace.plans import columns, counting, documents, extraction, features, joining, relational, shaping, sinks, taggers, texts, tickets
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "columns", "counting", "documents", "extraction", "features", "joining", "relational", "shaping", "sinks", "taggers", "texts", "tickets"]
