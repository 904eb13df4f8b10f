"""Dense surrogate keys: ``row_number() over (order by ...)`` from a tree of prefix counts, without a single-partition exchange.

The order's leading key is written as text that sorts like it (:func:`sortable`). Rows are counted by growing prefixes of that text,
level by level, until no prefix holds more than ``LEAF`` rows; only counts leave the tasks (combined on the map side), rows do not move for it.
A row's key is then the number of rows below smaller prefixes plus its place among the rows of its own prefix: one exchange by
prefix, in which no group is larger than a leaf. Nothing is sampled and nothing is checkpointed: the key is a function of the
data alone, so a recomputed task gives the same keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tcelake.session import written_table

LEAF = 1 << 16          # rows of a prefix that one window group may hold
_PREFIX, _BELOW = "__rank_prefix", "__rank_below"


def sortable(df: DataFrame, col: str) -> Column:
    """Text whose byte order is the column's ascending order with nulls last; strings and whole numbers."""
    kind = df.schema[col].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        text = F.lpad(F.hex(F.col(col).cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    elif kind == "string":
        text = F.col(col)
    else:
        raise TypeError(f"no sortable text for {col}: {kind}")
    return F.when(F.col(col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), text))


def _common(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def prefix_counts(df: DataFrame, by: Column, leaf: int | None = None) -> tuple[DataFrame | None, int]:
    """``(prefix, n)`` of the shortest prefixes tried that hold at most ``leaf`` (``LEAF``) rows each, and their length; no counts where all rows
    fit into one leaf. Equal keys cannot be parted: growing stops when prefixes reach the longest key."""
    leaf = leaf or LEAF
    total = df.agg(F.count(F.lit(1)), F.min(by), F.max(by), F.max(F.length(by))).first()
    if total[0] <= leaf:
        return None, 0
    first, grow = _common(total[1], total[2]), 2
    while True:
        length = first + grow
        counts = df.groupBy(F.substring(by, 1, length).alias(_PREFIX)).agg(F.count(F.lit(1)).alias("n"))
        counts = written_table(counts, "prefixes")
        if length >= total[3] or counts.agg(F.max("n")).first()[0] <= leaf:
            return counts, length
        grow *= 2


def rows_below(counts: DataFrame, length: int) -> DataFrame:
    """``(prefix, below)``: rows of smaller prefixes, by two levels of the tree: whole branches first, siblings within a branch after."""
    nodes = counts.withColumn("branch", F.substring(_PREFIX, 1, max(1, length - max(1, length // 4))))
    branches = nodes.groupBy("branch").agg(F.sum("n").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    branches = branches.select("branch", before(Window.orderBy("branch")).alias("outside"))
    inside = nodes.withColumn("inside", before(Window.partitionBy("branch").orderBy(_PREFIX)))
    return inside.join(branches, "branch").select(_PREFIX, (F.col("inside") + F.col("outside")).alias(_BELOW))


def dense_rank_key(df: DataFrame, order: Sequence[str | Column], out: str, by: Column | None = None, leaf: int | None = None,
                   counted: tuple[DataFrame | None, int] | None = None) -> DataFrame:
    """BIGINT 1..n in the order of ``order`` (names ascending, nulls last); ``out`` is the first column.

    ``by`` is text that sorts like the order or a leading part of it; by default the first of ``order``. ``counted`` are the prefix
    counts of the same rows where a caller has them. An empty frame stays empty."""
    by = sortable(df, order[0]) if by is None else by
    columns = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    counts, length = counted or prefix_counts(df, by, leaf)
    if counts is None:
        return df.select(F.row_number().over(Window.orderBy(*columns)).cast("long").alias(out), *df.columns)
    keyed = df.withColumn(_PREFIX, F.substring(by, 1, length))
    place = F.row_number().over(Window.partitionBy(_PREFIX).orderBy(*columns))
    ranked = keyed.withColumn(out, place.cast("long")).join(rows_below(counts, length), _PREFIX)
    return ranked.select((F.col(out) + F.col(_BELOW)).alias(out), *df.columns)
