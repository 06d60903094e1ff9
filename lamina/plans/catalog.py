"""All queries of the engine's own operators."""

from . import flow_queries, layout_queries, model_queries, record_queries, text_queries, vector_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
