"""Scalar expressions used by the models: casts, CASE buckets, decade, unit conversion, label signatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for right results:
# drug-class flag column -> class label used in the class signature (labels sort ascending in the signature).
CLASS_LABELS = {
    "contains_cri": "CRI",
    "contains_fi": "FI",
    "contains_insti": "INI",
    "contains_nnrti": "NNRTI",
    "contains_nrti": "NRTI",
    "contains_pi": "PI",
}
# drug_class value -> flag column in dim_regimen.
CLASS_FLAGS = {
    "contains_pi": "PI",
    "contains_nrti": "NRTI",
    "contains_nnrti": "NNRTI",
    "contains_insti": "INI",
    "contains_cri": "CRI",
    "contains_fi": "FI",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strict_or_lenient_cast(col, dtype: str, strict: bool = True) -> Column:
    """``cast`` (raises on bad text under ANSI mode) or ``try_cast`` (NULL on bad text)."""
    c = _c(col)
    return c.cast(dtype) if strict else c.try_cast(dtype)


def is_truthy(col) -> Column:
    """Non-null and non-empty text (whitespace-only text counts as a value)."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit(""))


def formatted_id(*parts) -> Column:
    """``a_b_c`` identifier from columns/literals."""
    return F.concat_ws("_", *[_c(p) for p in parts])


def tag_to_timepoint_type(tag, measurement_type) -> Column:
    """``baselineRNA`` minus ``RNA``, lower-cased -> ``baseline``."""
    return F.lower(F.replace(_c(tag), _c(measurement_type), F.lit("")))


def bucketize(branches: Sequence[tuple[Column, str]], otherwise: str | None) -> Column:
    """Searched CASE: first matching predicate wins; ``otherwise`` None means no ELSE (NULL)."""
    expr = None
    for pred, label in branches:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    if otherwise is not None:
        expr = expr.otherwise(F.lit(otherwise))
    return expr


def decade(year) -> Column:
    """``1999 -> '1990s'``: truncating integer division, written as ``y - y % 10`` (``%`` keeps the sign of ``y``)."""
    y = _c(year).cast("int")
    return F.concat((y - y % 10).cast("string"), F.lit("s"))


def year_bucket(year) -> Column:
    y = _c(year)
    return bucketize([
        (y < 2000, "<2000"),
        (y.between(2000, 2005), "2000-2005"),
        (y.between(2006, 2010), "2006-2010"),
    ], "2011+")


def convert_units(value, unit, factors: dict[str, float]) -> Column:
    """Multiply ``value`` by the factor of its unit; unknown or NULL unit keeps the value."""
    v, u = _c(value), _c(unit)
    expr = None
    for name, factor in factors.items():
        expr = F.when(u == F.lit(name), v * F.lit(factor)) if expr is None else expr.when(u == F.lit(name), v * F.lit(factor))
    return v if expr is None else expr.otherwise(v)


def relative_phase(d) -> Column:
    d = _c(d)
    return bucketize([(d < 0, "pre"), (d == 0, "baseline")], "post")


def relative_bucket(d) -> Column:
    """Bucket on the raw number (not weeks); the gaps (-1,0) and (0,1) fall to ``late_post`` as in the reference."""
    d = _c(d)
    return bucketize([
        (d < -52, "far_pre"),
        (d.between(-52, -1), "recent_pre"),
        (d == 0, "baseline"),
        (d.between(1, 24), "early_post"),
    ], "late_post")


def label_signature(flags: dict[str, str], sep: str = "+") -> Column:
    """Labels of the flags equal to 1, ascending, joined by ``sep``; no flag -> ``''``.

    ``concat_ws`` skips NULLs, so emitting the labels in sorted order gives the sorted signature without an array sort.
    """
    ordered = sorted(flags.items(), key=lambda kv: kv[1])
    return F.concat_ws(sep, *[F.when(F.col(flag) == 1, F.lit(label)) for flag, label in ordered])


def class_label_signature() -> Column:
    return label_signature(CLASS_LABELS)
