"""Best-fit packing of documents into fixed-length training sequences by large-item matching.

Only the number of pieces of each length matters to a packing, so the packing is planned on the histogram of lengths
(at most ``capacity`` numbers, however many documents there are):

1. lengths above a third of the capacity are large: at most two fit into a sequence. From the longest down, each is
   matched with the longest large partner that still fits; the rest open a sequence alone;
2. smaller lengths, from the longest down, go to the fullest sequence that still takes them (best fit); what fits
   nowhere opens sequences of its own.

Equal sequences stay one plan entry with a count. Every piece then gets its rank among the pieces of its length by a
distributed count, and looks up its place by (length, rank). No piece passes through the driver or one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tcelake.llm.common import texts_of, written
from tcelake.llm.tokens import binary_column, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: ids of the whole text, then ``end_id``, cut every ``capacity`` ids.

    A null or empty text is one piece that holds only ``end_id``. A null doc_id stays null; repeated rows are packed
    each on their own. ``docs`` needs ``doc_id`` and ``text``; other columns are ignored."""
    end, step = np.uint32(end_id).astype("<u4").tobytes(), 4 * capacity

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_column(batch, "text")):
                ids = encode(text.as_py()) + end
                for n, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    for column, value in zip(rows, (doc_id, n, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts_of(docs).mapInArrow(cut, PIECES)


def plan_packing(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Plan rows ``(length, first rank, pieces per sequence, first sequence, offset)`` and the number of sequences.

    Rank r of a length in the row that begins at ``first rank`` f with t pieces per sequence stands in sequence
    ``first sequence + (r - f) // t`` at ``offset + (r - f) % t * length``."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    free: dict[int, list[tuple[tuple, int]]] = {}     # gap -> [(pattern, number of such sequences)]
    gaps: list[int] = []

    def put(pattern: tuple, gap: int, count: int) -> None:
        if count:
            if gap not in free:
                free[gap] = []
                insort(gaps, gap)
            free[gap].append((pattern, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        at = bisect_left(large, capacity - a + 1) - 1      # longest large partner that fits
        if at < 0:
            put(((a, 1),), capacity - a, left[a])
            left[a] = 0
        elif (b := large[at]) == a:
            put(((a, 2),), capacity - 2 * a, left[a] // 2)
            left[a] %= 2
            if left[a]:
                if at:                                     # the odd one out goes on to the next shorter partner
                    b = large[at - 1]
                    put(((a, 1), (b, 1)), capacity - a - b, 1)
                    left[b] -= 1
                else:
                    put(((a, 1),), capacity - a, 1)
                left[a] = 0
        else:
            n = min(left[a], left[b])
            put(((a, 1), (b, 1)), capacity - a - b, n)
            left[a] -= n
            left[b] -= n
        large = [n for n in large if left[n]]

    for n in sorted((n for n in left if left[n]), reverse=True):
        at = bisect_left(gaps, n)
        while left[n]:
            if at == len(gaps):                            # nothing has room: new sequences
                put((), capacity, -(-left[n] // (capacity // n)))
                at = bisect_left(gaps, capacity)
            gap = gaps[at]
            pattern, count = free[gap].pop()
            if not free[gap]:
                del free[gap], gaps[at]
            each = gap // n
            full = min(count, left[n] // each)
            put((*pattern, (n, each)), gap - each * n, full)
            left[n] -= full * each
            if full < count and left[n]:                   # fewer than `each` are left: one more sequence takes them
                put((*pattern, (n, left[n])), gap - left[n] * n, 1)
                left[n], full = 0, full + 1
            put(pattern, gap, count - full)
            at = bisect_left(gaps, n)

    rows, rank, sequence = [], dict.fromkeys(histogram, 0), 0
    for gap in gaps:
        for pattern, count in free[gap]:
            offset = 0
            for n, each in pattern:
                rows.append((n, rank[n], each, sequence, offset))
                rank[n] += each * count
                offset += each * n
            sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5), sequence


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to written pieces (``doc_id, piece, length`` and more).

    Deterministic for given pieces up to the order of equal (doc_id, piece) rows. An empty table gives an empty one.
    The pieces are written to the shared folder first, so ranks never change when a lost executor's part runs again."""
    pieces = written(pieces.withColumn("part", F.spark_partition_id()), "pieces")
    counts = written(pieces.groupBy("length", "part").count(), "lengths")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}   # capacity rows at most
    plan, _ = plan_packing(histogram, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    ranked = (pieces.withColumn("own", F.row_number().over(own)).join(first, ["length", "part"])
              .withColumn("rank", F.col("first") + F.col("own") - 1))
    keys = plan[:, 0] << 40 | plan[:, 1]                   # a length has fewer than 2^40 pieces
    columns = [c for c in pieces.columns if c != "part"]

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = plan[np.searchsorted(keys, length.astype(np.int64) << 40 | rank, side="right") - 1]
            at = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in columns),
                 pa.array(row[:, 3] + at // row[:, 2]), pa.array(row[:, 4] + at % row[:, 2] * length)],
                names=[*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "part")
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
