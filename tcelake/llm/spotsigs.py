"""Document fingerprints by spot signatures, DataFrame functions only.

A signature is a common word (the anchor) with the chain of the next content words after it, common words left out. The
fingerprint of a text is the sorted set of its signatures' hashes. Fingerprints are compared by Jaccard similarity, which
the set lengths bound from above: pairs whose lengths already rule a threshold out are never intersected, and near
duplicates are only looked for between neighbouring length partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tcelake.llm.common import texts_of, written

#: Anchors, the commonest words of four languages.
ANCHORS = ("the a an of to in and is that it for on with as at by this be are was or from "
           "der die das und zu den mit von für ist ein eine auf im dem "
           "le la les de des et un une en que qui est dans pour au du "
           "el los las y es por con una lo se del al").split()
CHAIN = 2                # content words of a signature
REACH = 9                # words after an anchor that are looked at for them


def signatures(text: Column) -> Column:
    """Sorted distinct signature hashes (array<int>) of a text. A text without anchors has one for its whole word sequence,
    one without words one for the text itself, the empty text none."""
    return F.transform(F.array(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda words: _signatures(words, text))[0]


def _signatures(words: Column, text: Column) -> Column:
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(ANCHORS))
    chain = lambda i: F.slice(F.filter(F.slice(words, i + 2, REACH), lambda w: (w != "") & ~w.isin(ANCHORS)), 1, CHAIN)
    spots = F.array_sort(F.array_distinct(F.transform(places, lambda i: F.hash(F.get(words, i), chain(i)))))
    whole = F.when(text == "", F.array().cast("array<int>")).when(
        F.size(F.array_remove(words, "")) > 0, F.array(F.hash(F.array_remove(words, "")))).otherwise(F.array(F.hash(text)))
    return F.when(F.size(places) > 0, spots).otherwise(whole)


def pruned_jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without intersecting them where their lengths allow less than ``least``. Two empty sets
    are alike (1), an empty and another one are not (0)."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return (F.when(large == 0, 1.0).when(small == 0, 0.0).when(small < least * large, 0.0)
            .otherwise(both / (F.size(a) + F.size(b) - both)))


def with_next(docs: DataFrame, rows_per_bucket: int = 10_000) -> DataFrame:
    """``doc_id, text, next_text``: the text of the next document by ascending doc_id; after the last comes the first.

    Documents are sorted in buckets bounded by quantiles of doc_id, so no task sorts them all; every bucket also gets the
    first document of the next one. Nulls come first; equal doc_ids are ordered by their texts' hash."""
    n, low = docs.agg(F.count("*"), F.min("doc_id")).first()
    steps = max(0, math.ceil(math.log2(max(1, n / rows_per_bucket))))
    cuts = 1 << steps
    bounds = docs.agg(F.percentile_approx("doc_id", [i / cuts for i in range(1, cuts)], 20 * cuts)).first()[0] if steps and low is not None else []
    bounds = F.array(*map(F.lit, bounds)).cast("array<bigint>") if bounds else None
    if bounds is None:
        bucket = F.lit(0)
    else:                # binary search: the number of bounds that are not above doc_id
        bucket = F.coalesce(F.aggregate(
            F.array(*[F.lit(1 << s) for s in reversed(range(steps))]), F.lit(0),
            lambda at, step: F.when(F.get(bounds, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at)), F.lit(0))
    own = texts_of(docs).withColumn("bucket", bucket)
    firsts = own.groupBy("bucket").agg(F.min(F.struct("doc_id")).alias("first"))    # one row per bucket, doc_id alone is read; null is smallest
    firsts = firsts.select("bucket", F.col("first.doc_id").alias("first_id"))
    order = Window.orderBy("bucket")
    last = F.max("bucket").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("first_id", F.coalesce(F.lag("bucket").over(order), last).alias("into"),
                           F.lag("bucket").over(order).isNull().alias("wraps"))
    own = own.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
    rows = own.select("doc_id", "text", F.explode(F.when(
        F.col("into").isNull(), F.array(F.struct("bucket", F.lit(0).alias("guest")))).otherwise(
        F.array(F.struct("bucket", F.lit(0).alias("guest")), F.struct(F.col("into").alias("bucket"), F.lit(1).alias("guest"))))).alias("at"))
    rows = rows.select("doc_id", "text", "at.bucket", "at.guest")
    line = Window.partitionBy("bucket").orderBy("guest", "doc_id", F.xxhash64("text"))
    return rows.withColumn("next_text", F.lead("text").over(line)).filter("guest = 0").select("doc_id", "text", "next_text")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text, edited, own, edited_own, next_own``: every text, its edited text (the last quarter replaced by the
    head of the next document) and the signatures of all three. Null and empty texts have no signatures; a single document is its
    own next one."""
    n, cut = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = with_next(docs).withColumn("edited", edited)
    return rows.select("*", signatures(F.col("text")).alias("own"), signatures(F.col("edited")).alias("edited_own"),
                       signatures(F.col("next_text")).alias("next_own"))


def fingerprint_text(signs: Column) -> Column:
    return F.array_join(signs.cast("array<string>"), ",")


def near_pairs(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """``a, b, similarity``: fingerprint classes (named by their smallest doc_id) at least ``least`` alike, a < b.

    Equal fingerprints are one class, so copies are never paired. Sets of length n lie in the length partition
    floor(log n / log(1/least)); alike sets lie in one partition or in neighbouring ones, and share one of the first
    n - ceil(least n) + 1 signatures of each."""
    own = texts_of(docs).select("doc_id", signatures(F.col("text")).alias("own")).filter(F.size("own") > 0)
    classes = written(own.groupBy("own").agg(F.min("doc_id").alias("id")), "spotsigs")
    size = F.size("own")
    part = F.floor(F.log(size) / F.lit(math.log(1 / least)) + 1e-9).cast("int")
    keys = classes.withColumn("part", part).withColumn(
        "sign", F.explode(F.slice("own", F.lit(1), (size - F.ceil(size * F.lit(least) - 1e-9) + 1).cast("int"))))
    left = keys.select(F.col("id").alias("a"), F.col("own").alias("x"), "sign", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = keys.select(F.col("id").alias("b"), F.col("own").alias("y"), "sign", "part")
    longer = (F.size("x") < F.size("y")) | ((F.size("x") == F.size("y")) & (F.col("a") < F.col("b")))
    found = left.join(right, ["sign", "part"]).filter(longer & (F.size("x") >= least * F.size("y")))
    found = found.withColumn("similarity", pruned_jaccard(F.col("x"), F.col("y"), least)).filter(F.col("similarity") >= least)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").distinct()
