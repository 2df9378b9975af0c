"""Queries and plans built from the operators."""

from . import array_queries, check_queries, detail_queries, event_queries, model_queries, response_queries, scan_queries, source_queries, spectra_queries, table_queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "array_queries", "check_queries", "detail_queries", "event_queries", "model_queries", "response_queries", "scan_queries", "source_queries", "spectra_queries", "table_queries"]
