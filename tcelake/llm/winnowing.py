"""Benchmark decontamination by winnowing.

Of the k-gram hashes in a window of w neighbouring k-grams the smallest is kept, on both sides. A shared span of
``k + w - 1`` words holds the same window of hashes on both sides, so both keep the same minimum there: with k = 5 and w = 6
no shared span of ten words goes unseen. Items of fewer than ten words have one fingerprint, their whole sequence, and
documents are looked up at every word for the lengths that occur (k = length, w = 1).

A fingerprint travels with the words that a ten-word span around it can reach, ten less k on either side. Fingerprints are
joined by hash and each hit is extended word by word within those; every word of every shared span lies in the extension of
one of its fingerprints, so no text is fetched again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tcelake.llm.bloom import bitmap_of, may_hold
from tcelake.llm.common import texts_of, written
from tcelake.llm.superminhash import Words, mixed

SPAN, GRAM = 10, 5                    # words of a shared span; words of a k-gram
SALTS = 16                            # copies of the benchmark's fingerprints over which a hot hash of the documents is dealt
#: A-Z lower-cased; bytes outside `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` part words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(2 ** 64 - 1)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def gram_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, different between lengths; as many as words, the last ones meaningless."""
    out = np.full(len(h), length, dtype=np.uint64)
    for j in range(length):
        out[:len(h) - j] = mixed(out[:len(h) - j] * _STEP + h[j:])
    return out


def minima(h: np.ndarray, window: int) -> np.ndarray:
    """Which hashes are the smallest of some ``window`` neighbours (all of equal ones), read off the maximum of the minima."""
    if len(h) < window:
        return np.zeros(len(h), dtype=bool)
    low = h[:len(h) - window + 1].copy()
    for j in range(1, window):
        np.minimum(low, h[j:len(h) - window + 1 + j], out=low)
    top = np.zeros(len(h), dtype=np.uint64)
    for j in range(window):
        np.maximum(top[j:j + len(low)], low, out=top[j:j + len(low)])
    return top == h


def fingerprints(texts: list[list[bytes]], lengths: list[int], words: Words, wanted=None) -> Iterator[tuple[int, int, int, int, list[bytes], int]]:
    """``(text, place, length, hash, context, place in the context)`` of the texts' fingerprints: ``SPAN`` selects the
    winnowed k-grams, any other length every run of so many words. ``wanted`` may leave hashes out."""
    flat = [w for t in texts for w in t]
    size = np.array([len(t) for t in texts], dtype=np.int64)
    end = np.repeat(np.cumsum(size), size)
    begin = end - np.repeat(size, size)
    h = np.fromiter(map(words.__getitem__, flat), dtype=np.uint64, count=len(flat))
    place = np.arange(len(flat))
    owner = np.repeat(np.arange(len(texts)), size)
    for length in lengths:
        gram, window, around = (GRAM, SPAN - GRAM + 1, SPAN - GRAM) if length == SPAN else (length, 1, 0)
        hashes = gram_hashes(h, gram)
        inside = place + gram <= end
        hashes[~inside] = _NONE                                # never the minimum of a window that lies in one text
        keep = inside & (end - begin >= length)
        if length == SPAN:
            keep &= minima(hashes, window)
        at = np.flatnonzero(keep)
        if wanted is not None:
            at = at[wanted(hashes[at])]
        low, high = np.maximum(begin[at], at - around), np.minimum(end[at], at + gram + around)
        for p, o, a, b, x, first in zip(at.tolist(), owner[at].tolist(), low.tolist(), high.tolist(), hashes[at].view(np.int64).tolist(), begin[at].tolist()):
            yield o, p - first, length, x, flat[a:b], p - a


def extended(a: list[bytes], at: int, b: list[bytes], bt: int, length: int) -> tuple[int, int] | None:
    """The shared run around word ``at`` of ``a`` and ``bt`` of ``b`` as offsets from ``at``, if it is long enough."""
    gram = GRAM if length == SPAN else length
    if a[at:at + gram] != b[bt:bt + gram]:
        return None
    left, right = 0, gram
    while left < min(at, bt) and a[at - left - 1] == b[bt - left - 1]:
        left += 1
    while at + right < len(a) and bt + right < len(b) and a[at + right] == b[bt + right]:
        right += 1
    return (-left, right) if left + right >= length else None


def item_fingerprints(items: DataFrame) -> DataFrame:
    """``h, length, context, at, items``: the fingerprints of ``item_id, text`` with all items that hold them alike."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        words = Words()
        for batch in batches:
            ids, own = batch.column(0).to_pylist(), [words_of((t.as_py() or "").encode()) for t in batch.column(1)]
            for length in range(1, SPAN + 1):
                few = [(i, t) for i, t in zip(ids, own) if (len(t) == length if length < SPAN else len(t) >= SPAN)]
                found = list(fingerprints([t for _, t in few], [length], words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[3] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int32()),
                     pa.array([b" ".join(f[4]).decode() for f in found], pa.string()), pa.array([f[5] for f in found], pa.int32()),
                     pa.array([few[f[0]][0] for f in found], pa.int64())], names=["h", "length", "context", "at", "item_id"])

    rows = items.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "h long, length int, context string, at int, item_id long")
    return rows.groupBy("h", "length", "context", "at").agg(F.collect_set("item_id").alias("items"))


def read_documents(docs: DataFrame, lengths: list[int], bitmap: np.ndarray) -> DataFrame:
    """``doc_id, name, n_words`` per document (``name``: digest of its text) and, with these null but for the name, one row
    ``place, h, length, context, at`` per fingerprint that the benchmark may hold."""
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        words, bits = Words(), held.value
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                raw = [t.as_py().encode() for t in part.column(1)]
                names = [hashlib.blake2b(t, digest_size=16).digest() for t in raw]
                own = [words_of(t) for t in raw]
                found = list(fingerprints(own, lengths, words, lambda h: may_hold(bits, h)))
                n, m = len(own), len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.column(0).to_pylist() + [None] * m, pa.int64()), pa.array(names + [names[f[0]] for f in found], pa.binary()),
                     pa.array([len(t) for t in own] + [None] * m, pa.int64()), pa.array([None] * n + [f[1] for f in found], pa.int64()),
                     pa.array([None] * n + [f[3] for f in found], pa.int64()), pa.array([None] * n + [f[2] for f in found], pa.int32()),
                     pa.array([None] * n + [b" ".join(f[4]).decode() for f in found], pa.string()),
                     pa.array([None] * n + [f[5] for f in found], pa.int32())],
                    names=["doc_id", "name", "n_words", "place", "h", "length", "context", "at"])

    return docs.mapInArrow(run, "doc_id long, name binary, n_words long, place long, h long, length int, context string, at int")


def shared_spans(found: DataFrame, items: DataFrame) -> DataFrame:
    """``name, low, high, items``: word ranges of a text that are shared with those items."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            a, at, b, bt, length, place = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("context", "at", "other", "bt", "length", "place"))
            span = [extended(x.split(" "), i, y.split(" "), j, n) for x, i, y, j, n in zip(a, at, b, bt, length)]
            rows = [i for i, s in enumerate(span) if s]
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("name")).take(taken), pa.array([place[i] + span[i][0] for i in rows], pa.int64()),
                 pa.array([place[i] + span[i][1] for i in rows], pa.int64()), batch.column(batch.schema.get_field_index("items")).take(taken)],
                names=["name", "low", "high", "items"])

    salted = found.withColumn("salt", F.pmod(F.xxhash64("name", "place"), F.lit(SALTS)).cast("int"))
    copies = items.select("h", "length", F.col("context").alias("other"), F.col("at").alias("bt"), "items",
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    both = salted.join(copies, ["h", "length", "salt"]).select("name", "place", "length", "context", "at", "other", "bt", "items")
    return both.mapInArrow(run, "name binary, low long, high long, items array<long>")


def covered(spans) -> F.Column:
    """Words in the union of an array of ``low, high`` ranges."""
    fold = F.aggregate(F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
                       lambda s, x: F.struct(F.greatest(s["end"], x["high"]).alias("end"),
                                             (s["n"] + F.greatest(x["high"] - F.greatest(x["low"], s["end"]), F.lit(0))).alias("n")))
    return fold["n"]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` for every row of ``docs`` (``doc_id, text``) against ``benchmark`` (``item_id, text``);
    other columns are ignored.

    ``n_hit`` counts the words inside any occurrence of ten consecutive words of an item, or of a whole shorter one;
    ``items`` are the item_ids with an occurrence, ascending. Null and empty texts have no words and hit nothing, nor do
    items without words. Items without item_id are searched for but not listed; rows that repeat an item_id are one item.
    Rows without doc_id and repeated rows keep a row each. Equal texts are compared once. An empty table of documents gives
    an empty one; an empty benchmark hits nothing."""
    items = written(item_fingerprints(benchmark), "item-prints")
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())          # at most ten numbers
    bitmap = bitmap_of(items.select("h"), lambda batch: batch.column(0).to_numpy().view(np.uint64))
    rows = written(read_documents(texts_of(docs), lengths, bitmap), "doc-prints")
    found = rows.filter("place is not null").select("name", "place", "h", "length", "context", "at").distinct()
    hits = shared_spans(found, items).groupBy("name").agg(
        F.collect_set(F.struct("low", "high")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    hits = hits.select("name", covered(F.col("spans")).alias("n_hit"), "items")
    return rows.filter("place is null").join(hits, "name", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"))
