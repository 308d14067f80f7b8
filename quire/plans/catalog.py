"""Registered queries of the document operators."""

from __future__ import annotations

from . import block_queries, layout_queries, text_queries

FLAGSHIP = "merge_paragraphs"
QUERIES: dict = {**text_queries.QUERIES, **block_queries.QUERIES, **layout_queries.QUERIES}
ORACLES: dict = {**text_queries.ORACLES, **block_queries.ORACLES, **layout_queries.ORACLES}
