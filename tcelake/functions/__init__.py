"""Column builders. Each returns a ``Column`` made of built-in expressions, so it stays inside whole-stage codegen."""

from tcelake.functions.scalar import (
    CLASS_LABELS,
    bucketize,
    class_label_signature,
    convert_units,
    decade,
    formatted_id,
    is_truthy,
    label_signature,
    strict_or_lenient_cast,
    tag_to_timepoint_type,
    year_bucket,
    relative_phase,
    relative_bucket,
)

__all__ = [
    "CLASS_LABELS",
    "bucketize",
    "class_label_signature",
    "convert_units",
    "decade",
    "formatted_id",
    "is_truthy",
    "label_signature",
    "strict_or_lenient_cast",
    "tag_to_timepoint_type",
    "year_bucket",
    "relative_phase",
    "relative_bucket",
]
