"""Names for columns an operator adds for itself."""

from __future__ import annotations

from collections.abc import Iterable


def hidden(*columns: Iterable[str]) -> str:
    """A prefix that none of the columns begins with, in any case."""
    taken = [c.lower() for names in columns for c in names]
    prefix = "_"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return prefix
