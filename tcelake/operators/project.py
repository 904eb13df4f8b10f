"""Projection helpers: typed casts (strict/lenient) and column lists with defaults for absent keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast the named columns. ``strict`` raises on bad text (ANSI cast); otherwise ``try_cast`` gives NULL."""
    cols = []
    for c in df.columns:
        if c in types:
            cols.append((F.col(c).cast(types[c]) if strict else F.col(c).try_cast(types[c])).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def cast_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column: number of non-null values that a lenient cast turns into NULL (one aggregate row)."""
    return df.agg(*[F.sum((F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).cast("long")).alias(c)
                    for c, t in types.items()])


def project_with_default(records: DataFrame, map_col: str, columns: Sequence[str], default: str = "N/A") -> DataFrame:
    """Keep ``columns`` from a MAP<STRING,STRING> record column; an absent key gives ``default``, a present NULL stays
    NULL (``dict.get(key, default)`` semantics)."""
    m = F.col(map_col)
    return records.select(*[F.when(F.map_contains_key(m, F.lit(c)), m[c]).otherwise(F.lit(default)).alias(c)
                            for c in columns])
