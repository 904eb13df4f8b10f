"""Interaction audit of filters by the Hart-Mas-Colell potential of their removal game.

Coalition S of filters removes v(S) documents: those that fail at least one filter of S. The potential of a coalition is
``P(S) = (v(S) + sum of P(S without i) over i in S) / |S|`` from P(empty) = 0 up, and the Shapley value of filter i is
``P(all) - P(all without i)``. Potentials are kept times 60, the least common multiple of 1 to 5, and are exact integers. What a filter removes
at a step is the difference of two coalitions. Documents are only counted by their set of failed filters, so after one
pass over the texts everything is computed from at most 32 x 4 numbers a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
SCALE, ORDERS = 60, 120
#: Characters whose presence fails filter D.
SYMBOLS = b"#$%&*|"


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()                                   # bytes part at 0x20 and 0x09-0x0D
    n = len(words)
    mask = (n < 100) | (100 * len(set(words)) < 80 * n) << 1
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    if upper:
        points = len(text.decode()) if not text.isascii() else len(text)
        mask |= (100 * upper > 10 * points) << 2
    return mask | (len(text.translate(None, SYMBOLS)) < len(text)) << 3


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, name``: the filters A to D that each text fails and a 128-bit digest of it."""
    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        for batch in batches:
            raw = [t.as_py().encode() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(map(failures, raw)), pa.int32()),
                 pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in raw], pa.binary())], names=["doc_id", "part", "mask", "name"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, part string, mask int, name binary")


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the set of filters they fail, and how many of them are labelled.

    A text fails E when a smaller doc_id has the same one, so all of a group of copies but the rows of its smallest doc_id.
    Copies are counted by (text, labels, doc_id), then by (text, labels), before they meet: a large group reaches one task
    as a row per map task, and never as its documents."""
    flag = lambda c: F.max((F.col(c) == 1).cast("int")).alias(c)
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(flag("quality"), flag("toxic"))
    rows = judged(docs).join(known, "doc_id", "left").select(
        "doc_id", "part", "mask", "name", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    kind = ["name", "part", "mask", "good", "toxic"]
    single = rows.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    # Rows without doc_id stand in the same group but are copies of nothing: they never fail E.
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    group = single.groupBy(*kind).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("none"), first.alias("first"))
    lowest = F.min("first.doc_id").over(Window.partitionBy("name"))       # one row per part and labels
    kept = F.col("none") + F.when(F.col("first.doc_id") == F.col("lowest"), F.col("first.n")).otherwise(0)
    split = group.withColumn("lowest", lowest).withColumn("kept", kept).select(
        "part", "good", "toxic", F.explode(F.array(F.struct("mask", F.col("kept").alias("n")), F.struct(
            (F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - F.col("kept")).alias("n")))).alias("x"))
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``: every order of the five
    filters on every part (``lang``; null: empty string) of ``docs`` (``doc_id, lang, text``); ``labels`` has ``doc_id, quality, toxic``.

    Other columns are ignored. A null text is empty: it fails A. A doc_id labelled more than once is good or toxic if any of its
    rows says so; null labels say nothing. Rows without doc_id have no labels and are no copies. Rows that repeat a
    doc_id count each; they are copies of smaller doc_ids only. An empty table of documents has no parts and gives no rows."""
    counts = failure_counts(docs, labels)
    hit = lambda s, c: F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(c)).otherwise(0))
    lost = [F.array(*[hit(s, c) for s in range(ALL + 1)]).alias(name) for c, name in (("n", "v"), ("good", "v_good"), ("toxic", "v_toxic"))]
    only = F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(len(FILTERS))]).alias("only")
    games = counts.groupBy("part").agg(F.sum("n").alias("total"), *lost, only)

    # P of one coalition after another: the array grows by the next coalition's potential.
    smaller = F.array(*[F.array(*[F.lit(s & ~(1 << i)) for i in range(len(FILTERS)) if s >> i & 1]) for s in range(1, ALL + 1)])
    below = lambda s: F.get(F.col("smaller"), s - 1)
    step = lambda p, s: F.concat(p, F.array(F.call_function("div", F.get(F.col("v"), s) * SCALE + F.aggregate(
        below(s), F.lit(0).cast("long"), lambda t, k: t + F.get(p, k)), F.size(below(s)))))
    games = games.withColumn("smaller", smaller).withColumn(
        "p", F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), step))

    steps = F.array(*[F.struct(F.lit("".join(o)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(FILTERS.index(f)).alias("i"),
                               F.lit(reduce(lambda m, g: m | 1 << FILTERS.index(g), o[:k], 0)).alias("before"))
                      for o in permutations(FILTERS) for k, f in enumerate(o)])
    rows = games.withColumn("x", F.explode(steps)).select("*", "x.*")
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), F.col("i") + 1)
    after = F.col("before").bitwiseOR(bit)
    gain = lambda c: F.get(F.col(c), after) - F.get(F.col(c), F.col("before"))
    shapley = (F.get(F.col("p"), F.lit(ALL)) - F.get(F.col("p"), F.lit(ALL) - bit)) * (ORDERS // SCALE)
    out = {"kept": F.col("total") - F.get(F.col("v"), after), "removed": gain("v"), "redundant": F.get(F.col("v"), bit) - gain("v"),
           "unique_fails": F.get(F.col("only"), F.col("i")), "good_lost": gain("v_good"), "toxic_lost": gain("v_toxic"), "shapley": shapley}
    return rows.select("part", "filter_order", "step", *[c.cast("long").alias(name) for name, c in out.items()])
