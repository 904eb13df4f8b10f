"""Grouping operators. All are single ``groupBy`` passes with map-side partial aggregation, so a hot key is
combined on the map side before the shuffle (count/max/set states are small per key)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_by(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    """``count(*)`` per key as BIGINT."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias(out))


def conditional_max_pivot(df: DataFrame, key: str | Sequence[str],
                          specs: Mapping[str, tuple[Column, str | Column, str]], strict: bool = True) -> DataFrame:
    """One row per key with ``max(case when predicate then cast(value as type) end)`` per output column.

    The cast sits inside the CASE branch, so rows that do not match are never cast (a text such as ``<50`` in a
    non-selected field cannot fail the query). NULL when no row matches.
    """
    keys = [key] if isinstance(key, str) else list(key)
    def cast(v, t):
        return _c(v).cast(t) if strict else _c(v).try_cast(t)
    aggs = [F.max(F.when(pred, cast(value, dtype))).alias(out) for out, (pred, value, dtype) in specs.items()]
    return df.groupBy(*keys).agg(*aggs)


def flags_by_value(col: str, flags: Mapping[str, str]) -> list[Column]:
    """0/1 INT flags ``max(case when col = value then 1 else 0 end)``; a NULL value gives 0."""
    return [F.max(F.when(F.col(col) == F.lit(v), F.lit(1)).otherwise(F.lit(0))).cast("int").alias(out)
            for out, v in flags.items()]


def set_signature_aggs(col: str, sep: str = "+", count_out: str = "n_distinct",
                       signature_out: str = "signature") -> list[Column]:
    """Distinct count and the sorted distinct values joined by ``sep`` from one shared ``collect_set`` state."""
    s = F.collect_set(F.col(col))
    return [F.size(s).cast("long").alias(count_out), F.array_join(F.array_sort(s), sep).alias(signature_out)]


def set_signature(df: DataFrame, keys: Sequence[str], col: str, sep: str = "+", count_out: str = "n_distinct",
                  signature_out: str = "signature", extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """Per key: number of distinct non-null values and their sorted ``sep``-joined list. NULL members are removed first."""
    return (df.filter(F.col(col).isNotNull())
              .groupBy(*keys)
              .agg(*set_signature_aggs(col, sep, count_out, signature_out), *extra_aggs))


def keep_frequent(df: DataFrame, col: str, min_count: int, population: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` whose ``col`` value occurs at least ``min_count`` times in ``population`` (default ``df``).

    Counting is a partially aggregated group-by; the filter is a left-semi join, which AQE may turn into a broadcast
    when the frequent-value set is small at run time, and splits when one value is hot (skew-join handling).
    """
    pop = df if population is None else population
    frequent = (pop.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
                   .filter(F.col("__n") >= min_count).select(col))
    return df.join(frequent, on=col, how="left_semi")


def fold_small(df: DataFrame, label: str, count: str, threshold: int = 7, other: str = "Other") -> DataFrame:
    """Relabel groups whose count is strictly below ``threshold`` as ``other``, re-sum, order with ``other`` last.

    Returns (label, count, ordinal). The ordinal is a dense key: Other last, then count descending, label as the tiebreak.
    """
    from tcelake.operators.rank import dense_rank_key, sortable
    from tcelake.session import written_table
    relabeled = df.select(F.when(F.col(count) < threshold, F.lit(other)).otherwise(F.col(label)).alias(label),
                          F.col(count))
    summed = written_table(relabeled.groupBy(label).agg(F.sum(count).cast("long").alias(count)), "folded")
    is_other = (F.col(label) == F.lit(other)).cast("int")
    summed = summed.withColumn("__down", -F.col(count))
    by = F.concat(is_other.cast("string"), sortable(summed, "__down"))
    ranked = dense_rank_key(summed, [is_other.asc(), F.col(count).desc(), F.col(label).asc_nulls_last()], "ordinal", by)
    return ranked.select(label, count, "ordinal")


def share_of_total(df: DataFrame, count: str, out: str = "share") -> DataFrame:
    """Each row's share of the column total; the total is a scalar subquery (partial sums per partition combined),
    so no step sees all rows at once."""
    total = df.select(F.sum(count)).scalar()
    return df.withColumn(out, F.col(count) / total)
