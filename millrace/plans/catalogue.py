"""All queries over the reference's operators, with their SQL."""

from __future__ import annotations

from . import generator_queries, model_queries, quality_queries, text_queries

MODULES = (generator_queries, model_queries, quality_queries, text_queries)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in MODULES for k, s in m.ORACLES.items()}
