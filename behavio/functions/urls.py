"""URL predicates (F3) and host extraction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_static_resource(col: Column | str, suffixes=("css", "js")) -> Column:
    """True when the URL ends in ``.css`` / ``.js`` (query strings count as
    part of the URL, so ``/a.css?x`` is not static)."""
    c = F.col(col) if isinstance(col, str) else col
    alt = "|".join(suffixes)
    return c.rlike(rf"\.({alt})$")


def url_host(col: Column | str) -> Column:
    """Lower-cased host of an absolute URL (empty string when absent)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
