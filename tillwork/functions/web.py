"""Host, path and parameters of URLs that may lack a scheme."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _without(url: Column, *schemes: str) -> Column:
    for scheme in schemes:
        url = F.replace(url, F.lit(scheme), F.lit(""))
    return url


def _piece(text: Column, mark: str, number: int) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(number))


def url_host(url: Column) -> Column:
    """Text before the first ``/`` and before any ``?``, scheme removed."""
    bare = _without(url, "android-app://", "http://", "https://")
    return _piece(_piece(bare, "/", 1), "?", 1)


def url_path(url: Column) -> Column:
    """Text after the first ``/`` up to ``?``; a ``#`` part stays.

    A URL with neither ``/`` nor ``?`` yields all of its text.
    """
    bare = _without(url, "http://", "https://")
    slash = F.instr(bare, F.lit("/"))
    # without a slash the query string alone is left, hence an empty path
    cut = F.when(slash > 0, slash).otherwise(F.instr(bare, F.lit("?")) - 1)
    return _piece(F.right(bare, F.length(bare) - cut), "?", 1)


def url_parameter(url: Column, name: str) -> Column:
    """Text after the first ``name=`` up to ``&``, NULL when empty or absent.

    The name is found anywhere in the URL, also as the tail of a longer name.
    """
    return F.nullif(_piece(_piece(url, f"{name}=", 2), "&", 1), F.lit(""))
