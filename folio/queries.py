"""The registered queries of the document engine, and their SQL."""

from __future__ import annotations

from folio.plans import check_queries, derived_queries, flow_queries, layout_queries, scan_queries, slide_queries, text_queries

FLAGSHIP = "packed_coverage"
_PARTS = [text_queries, layout_queries, check_queries, scan_queries, derived_queries, flow_queries, slide_queries]
QUERIES = {name: f for part in _PARTS for name, f in part.Q.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.O.items()}
