"""Every registered query: ``QUERIES[name](spark, sf_dir)`` and ``ORACLE[name]``.

Importing the query modules fills the two dictionaries.
"""

from __future__ import annotations

from songgraph.plans import explore_queries  # noqa: F401
from songgraph.plans import graph_queries  # noqa: F401
from songgraph.plans import recommend_queries  # noqa: F401
from songgraph.plans import segment_queries  # noqa: F401
from songgraph.plans import year_queries  # noqa: F401
from songgraph.plans import ingest_queries  # noqa: F401
from songgraph.plans.base import ORACLE, QUERIES  # noqa: F401

FLAGSHIP = "recommend_batch"
