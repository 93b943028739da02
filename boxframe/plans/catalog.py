"""All registered queries and checks."""

from __future__ import annotations

from boxframe.plans import (  # noqa: F401  (importing a module registers its queries)
    box_queries,
    file_queries,
    frame_queries,
    matching_queries,
    split_queries,
)
from boxframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
