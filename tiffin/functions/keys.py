"""References and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference(prefix: str, number: Column) -> Column:
    return F.format_string(f"{prefix}-%07d", number)


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the parts, stable across runs; NULL has its own mark so it cannot erase the key."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("||", *[F.coalesce(p.cast("string"), F.lit("_NULL_"))
                                     for p in parts]))
