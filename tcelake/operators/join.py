"""Join and set operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_enrich(base: DataFrame, others: Sequence[DataFrame], key: str | Sequence[str],
                fill: Mapping[str, object] | None = None) -> DataFrame:
    """Left-join each frame in ``others`` on ``key`` (all rows of ``base`` kept), then fill NULLs in ``fill``.

    All joins share the key, so after the first exchange the base side stays partitioned and later joins shuffle only
    the right sides. Right sides must be unique on the key (checked in tests).
    """
    out = base
    for o in others:
        out = out.join(o, on=key, how="left")
    if fill:
        out = out.fillna(dict(fill))
    return out


def full_outer_merge(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """FULL OUTER join with one coalesced key column (``coalesce(a.key, b.key)``)."""
    return a.join(b, on=key, how="full_outer")


def union_distinct(parts: Sequence[tuple[DataFrame, Mapping[str, str]]], distinct: bool = True) -> DataFrame:
    """``UNION`` of projections: each part renames source columns to target names; NULLs compare equal."""
    frames = [df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()]) for df, mapping in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct() if distinct else out
