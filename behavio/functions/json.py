"""Small JSON accessors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_long(col: Column | str, field: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.get_json_object(c, f"$.{field}").cast("long")
