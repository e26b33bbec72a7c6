"""Named queries over the star schema, each with its counterpart in plain SQL where there is one."""

from __future__ import annotations

from tillwork.registry import checks, lake, models, reshaping, scalars, streams
from tillwork.registry.base import Query

GROUPS = (models, lake, reshaping, scalars, checks, streams)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for group in GROUPS:
        twice = found.keys() & group.QUERIES.keys()
        if twice:
            raise ValueError(f"query names given twice: {sorted(twice)}")
        found.update(group.QUERIES)
    return found
