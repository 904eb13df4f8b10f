"""Repeated passages across documents by maximal repeats of enhanced suffix arrays.

A passage of ``least`` bytes that stands in two places holds, at the same offset in both, one anchor: the 32-byte string
with the smallest hash of all in the passage. So places that share a passage meet under its anchor, and anchors that occur
once need no comparison. Documents are kept in blocks (rows of about half a MB of text):

1. every block tells the hashes of its anchors, at most two of each, to hash buckets; a bucket answers which are repeated;
2. every block sends the passages of its repeated anchors (one text from the first to the last passage that has the
   anchor) to the anchor's bucket, equal texts of a block only once. An anchor in more than ``HOT`` blocks is split: each
   passage with it goes to a bucket of its own hash, so no bucket holds all its places;
3. a bucket sorts the suffixes of what it got, and scans the suffixes' common-prefix lengths with a stack. An interval of the
   suffix array with a common prefix of ``least`` bytes or more, whose places are preceded by different bytes (or by
   the start of what the bucket knows), is a maximal repeat; all its places but the first are repeats;
4. the repeats go back to their blocks, where the covered bytes are removed.

Exact copies of a whole text are found by a digest and never sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tcelake.llm.common import texts_of, written
from tcelake.llm.superminhash import mixed

ANCHOR = 32                  # bytes of an anchor; a power of two
HOT = 4096                   # blocks an anchor may occur in before its passages are split by their own hash
BLOCK_BYTES = 1 << 19
BUCKET_BYTES = 16_000_000    # text per hash bucket
BLOCKS = "block long, n_bytes long, doc_ids array<long>, texts array<binary>"
_ODD = [pow(0x9E3779B97F4A7C15, 2 * n + 1, 2 ** 64) | 1 for n in range(9)]
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD[1]))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all strings of ``width`` bytes along the last axis: doubled strings, put together by the bits of the width."""
    power, size, out, done, n = _BYTE[data], 1, None, 0, data.shape[-1] - width + 1
    for level in range(width.bit_length()):
        if width & size:
            part = power[..., done:done + n]
            out = part.copy() if out is None else out * np.uint64(_ODD[level]) + part
            done += size
        if 2 * size <= width:
            power = power[..., :-size] * np.uint64(_ODD[level]) + power[..., size:]
            size *= 2
    return mixed(out)


def anchors(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the anchors of texts that stand one after the other in ``data`` (``ends``: where each ends), and for each the
    start of the first and of the last passage it is the anchor of (the passages between have it as well)."""
    span = least - ANCHOR + 1
    if len(data) < least:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    hashes = window_hashes(data, ANCHOR)
    low = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)   # ties: the first place
    size = 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if span > size:
        low = np.minimum(low[:size - span], low[span - size:])
    inside = np.ones(len(low), dtype=bool)                  # passages within one text
    for end in ends:
        inside[max(0, end - least + 1):end] = False
    starts = np.flatnonzero(inside)
    places = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(places, prepend=-1))
    return hashes[places[cuts]], starts[cuts], starts[np.append(cuts[1:], len(starts)) - 1] if len(starts) else starts


def to_blocks(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Blocks of consecutive rows; with ``carry`` also ``rest``, all columns but the text, as an Arrow stream."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        number, doc_ids, texts, rest, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def block():
            columns = [pa.array([number]), pa.array([size]), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.binary()))]
            if carry:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest[0].schema) as stream:
                    for part in rest:
                        stream.write_batch(part)
                columns.append(pa.array([sink.getvalue().to_pybytes()], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["block", "n_bytes", "doc_ids", "texts", "rest"][:len(columns)])

        for batch in batches:
            others, begin = batch.select(batch.schema.names[2:]), 0
            for at, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()), start=1):
                doc_ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES:
                    rest.append(others.slice(begin, at - begin))
                    yield block()
                    number, doc_ids, texts, rest, size, begin = number + 1, [], [], [], 0, at
            if begin < batch.num_rows:
                rest.append(others.slice(begin))
        if texts:
            yield block()

    own = texts_of(docs)
    if carry:                # under names of their own: the table's columns may be named like anything
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                          *[F.col(f"`{c}`").alias(f"rest_{n}") for n, c in enumerate(docs.columns)  if c != "text"])
    return own.mapInArrow(run, BLOCKS + ", rest binary" * carry)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([len(t) for t in texts])


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows by bucket of their hash."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for rows in np.split(order, cuts[1:]) if len(order) else ():
        yield int(bucket[rows[0]]), rows


def repeated_anchors(blocks: DataFrame, least: int, buckets: int) -> DataFrame:
    """``block, repeated, hot``: hashes of the anchors of a block that occur again, and of those that must be split."""
    def tell(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for row in range(batch.num_rows):
                hashes, _, _ = anchors(*_joined(batch.column(1)[row].as_py()), least)
                hashes = np.sort(hashes)
                hashes = hashes[~np.concatenate((np.zeros(min(2, len(hashes)), bool), hashes[2:] == hashes[:-2]))]   # two of each at most
                found = [(b, hashes[rows].tobytes()) for b, rows in _dealt(hashes, buckets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found], pa.int32()), pa.array([batch.column(0)[row].as_py()] * len(found), pa.int64()),
                     pa.array([h for _, h in found], pa.binary())], names=["bucket", "block", "hashes"])

    def answer(key, table):
        import pyarrow as pa
        blocks_of, raw = table["block"].to_numpy(), [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
        hashes, owner = np.concatenate(raw), np.repeat(np.arange(len(raw)), [len(h) for h in raw])
        order = np.argsort(hashes, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])))
        counts = np.repeat(np.diff(np.append(starts, len(order))), np.diff(np.append(starts, len(order))))
        times = np.empty(len(order), dtype=np.int64)
        times[order] = counts
        out = []
        for n in range(len(raw)):
            at = slice(*np.searchsorted(owner, [n, n + 1]))
            own, t = hashes[at], times[at]
            if (t > 1).any():
                out.append((blocks_of[n], np.unique(own[t > 1]).tobytes(), np.unique(own[t > HOT]).tobytes()))
        kinds = (pa.int64(), pa.binary(), pa.binary())
        columns = list(zip(*out)) or [[], [], []]
        return pa.table({name: pa.array(list(c), k) for name, c, k in zip(("block", "repeated", "hot"), columns, kinds)})

    told = blocks.select("block", "texts").mapInArrow(tell, "bucket int, block long, hashes binary")
    found = told.groupBy("bucket").applyInArrow(answer, "block long, repeated binary, hot binary")
    return found.groupBy("block").agg(F.collect_list("repeated").alias("repeated"), F.collect_list("hot").alias("hot"))


PLACES = np.dtype([("doc", "<i8"), ("row", "<i4"), ("start", "<i4"), ("length", "<u2")])


def _same(keys: np.ndarray, matrix: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row order by (key, text, doc, start), and which rows of that order differ from the row before in key or text."""
    packed = np.ascontiguousarray(np.hstack((keys.reshape(-1, 1).view(np.uint8), matrix)))
    names = packed.view(f"S{packed.shape[1]}").ravel()
    order = np.lexsort((start, doc, names))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (packed[order][1:] != packed[order][:-1]).any(axis=1)
    return order, first


def surroundings(blocks: DataFrame, least: int, buckets: int) -> DataFrame:
    """``bucket, block, keys, places, texts, covers``: text around repeated anchors for its bucket; ``covers`` (in rows of bucket -1)
    are the places of equal texts within the block, all but the first."""
    reach = 2 * least - ANCHOR

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            at = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for n in range(batch.num_rows):
                found = around(at["doc_ids"][n].as_py(), at["texts"][n].as_py(), *(
                    np.frombuffer(b"".join(at[c][n].as_py() or []), np.uint64) for c in ("repeated", "hot")), at["copies"][n].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int32()), pa.array([at["block"][n].as_py()] * len(found), pa.int64()),
                     *(pa.array([f[i] for f in found], pa.binary()) for i in (1, 2, 3, 4))],
                    names=["bucket", "block", "keys", "places", "texts", "covers"])

    def around(doc_ids, texts, repeated, hot, copies) -> list:
        texts = [b"" if n in set(copies or ()) else t for n, t in enumerate(texts)]
        data, ends = _joined(texts)
        keys, low, last = anchors(data, ends, least)
        keep = np.isin(keys, repeated)
        keys, low, high = keys[keep], low[keep], last[keep] + least
        row = np.searchsorted(ends, low, side="right")
        begin = np.concatenate(([0], ends))[row]
        if len(hot) and (split := np.isin(keys, hot)).any():          # every passage by itself
            counts = (high - low - least + 1)[split]
            start = np.repeat(low[split], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            own = window_hashes(data, least)[start]
            parts = ((keys[~split], own), (low[~split], start), (high[~split], start + least), (row[~split], np.repeat(row[split], counts)),
                     (begin[~split], np.repeat(begin[split], counts)))
            keys, low, high, row, begin = (np.concatenate(p) for p in parts)
        if not len(keys):
            return []
        size = high - low
        matrix = data[np.minimum(low[:, None] + np.arange(reach), len(data) - 1)]
        matrix[np.arange(reach)[None, :] >= size[:, None]] = 0
        ids = np.array([-2 ** 63 if d is None else d for d in doc_ids], dtype=np.int64)
        where = np.empty(len(keys), dtype=PLACES)
        where["doc"], where["row"], where["start"], where["length"] = ids[row], row, low - begin, size
        order, first = _same(keys, np.hstack((matrix, size.astype("<u2").reshape(-1, 1).view(np.uint8))), where["doc"], where["start"])
        out = []
        if not first.all():
            out.append((-1, None, None, None, where[order[~first]].tobytes()))
        order = order[first]
        for bucket, rows in _dealt(keys[order], buckets):
            rows = order[rows]
            body = matrix[rows][np.arange(reach)[None, :] < size[rows][:, None]]
            out.append((bucket, keys[rows].tobytes(), where[rows].tobytes(), body.tobytes(), None))
        return out

    return blocks.mapInArrow(run, "bucket int, block long, keys binary, places binary, texts binary, covers binary")


def maximal_repeats(suffixes: np.ndarray, lengths: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """Maximal repeats ``(length, rows of all occurrences)`` among suffixes (rows of bytes, ``lengths`` known of each).

    ``before`` is the byte before a suffix, or -1 where it is not known, which counts as different from every other. The
    rows are sorted, the common prefix of neighbours is computed, and a stack scan yields the intervals of the tree of common
    prefixes from the leaves up; an interval whose rows all have the same byte before them extends to the left and
    is none."""
    if len(suffixes) < 2:
        return
    order = np.argsort(np.ascontiguousarray(suffixes).view(f"S{suffixes.shape[1]}").ravel(), kind="stable")
    text, length = suffixes[order], lengths[order]
    unlike = text[1:] != text[:-1]
    common = np.where(unlike.any(axis=1), unlike.argmax(axis=1), text.shape[1])
    common = np.minimum(common, np.minimum(length[1:], length[:-1]))
    prior = before[order]
    stack: list[tuple[int, int]] = []                       # (common prefix, first row) of open intervals
    for n, c in enumerate([*common.tolist(), 0], start=1):
        first = n - 1
        while stack and stack[-1][0] > c:
            size, first = stack.pop()
            own = prior[first:n]
            if own.min() < 0 or own.min() != own.max():
                yield size, order[first:n]
        if c >= least and (not stack or stack[-1][0] < c):
            stack.append((c, first))


def repeats_in(keys: np.ndarray, places: np.ndarray, matrix: np.ndarray, least: int) -> np.ndarray:
    """Rows ``(row of places, start offset, length)`` of the repeats in a bucket's texts."""
    nothing = np.empty((0, 3), dtype=np.int64)
    order, first = _same(keys, np.hstack((matrix, places["length"].reshape(-1, 1).astype("<u2").view(np.uint8))), places["doc"], places["start"])
    # Equal texts under one anchor: all but the first are repeats as a whole.
    whole = order[~first]
    out = [np.column_stack((whole, np.zeros(len(whole), np.int64), places["length"][whole]))]
    rows = order[first]
    n_of = np.unique(keys[rows], return_inverse=True, return_counts=True)
    rows = rows[n_of[2][n_of[1]] > 1]                       # an anchor with one text has nothing left to compare
    if not len(rows):
        return np.concatenate(out) if len(whole) else nothing
    offsets = matrix.shape[1] - least + 1
    hashes = window_hashes(matrix[rows], least)
    valid = np.arange(offsets)[None, :] + least <= places["length"][rows][:, None]
    r, s = np.nonzero(valid)
    h = hashes[r, s]
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
    counts = np.diff(np.append(starts, len(h)))
    prior = np.where(s > 0, matrix[rows][r, np.maximum(s - 1, 0)].astype(np.int16), -1)[order]
    low, high = np.minimum.reduceat(prior, starts), np.maximum.reduceat(prior, starts)
    # Passages that all have the same byte before them are no maximal repeats: their extension to the left is.
    take = np.repeat((counts > 1) & ((low < 0) | (low != high)), counts)
    r, s, prior = r[order][take], s[order][take], prior[take]
    if not len(r):
        return np.concatenate(out)
    own = rows[r]
    columns = s[:, None] + np.arange(matrix.shape[1])[None, :]
    suffixes = np.where(columns < places["length"][own][:, None], matrix[own[:, None], np.minimum(columns, matrix.shape[1] - 1)], 0)
    doc, start = places["doc"][own], places["start"][own].astype(np.int64) + s
    for size, at in maximal_repeats(suffixes, places["length"][own].astype(np.int64) - s, prior, least):
        d, p = doc[at], start[at]
        lowest = d.min()
        later = at[(d > lowest) | (p > p[d == lowest].min())]
        if len(later):
            out.append(np.column_stack((own[later], s[later], np.full(len(later), size))))
    return np.concatenate(out)


def repeated_places(sent: DataFrame, least: int) -> DataFrame:
    """``block, covers``: places (row of the block, start, end) that repeat an earlier one."""
    reach = 2 * least - ANCHOR

    def find(key, table):
        import pyarrow as pa
        block = table["block"].to_numpy()
        raw = [np.frombuffer(p, PLACES) for p in table["places"].to_pylist()]
        places, owner = np.concatenate(raw), np.repeat(np.arange(len(raw)), [len(p) for p in raw])
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint64)
        matrix = np.zeros((len(places), reach), dtype=np.uint8)
        matrix[np.arange(reach)[None, :] < places["length"][:, None]] = np.frombuffer(b"".join(table["texts"].to_pylist()), np.uint8)
        found = repeats_in(keys, places, matrix, least)
        found = found[np.argsort(owner[found[:, 0]], kind="stable")]
        start = places["start"][found[:, 0]] + found[:, 1]
        cover = np.column_stack((places["row"][found[:, 0]], start, start + found[:, 2])).astype("<i4")
        cuts = np.flatnonzero(np.diff(owner[found[:, 0]], prepend=-1))
        parts = np.split(cover, cuts[1:]) if len(cover) else []
        blocks = block[owner[found[cuts, 0]]] if len(cover) else []
        # Each block's covers once: the same place is often found under several anchors' texts.
        return pa.table({"block": pa.array(blocks, pa.int64()), "covers": pa.array([np.unique(p, axis=0).tobytes() for p in parts], pa.binary())})

    return sent.filter("bucket >= 0").groupBy("bucket").applyInArrow(find, "block long, covers binary")


def runs_of(covers: np.ndarray) -> np.ndarray:
    """Sorted disjoint runs (start, end) that cover the same bytes; touching ones are one run."""
    if not len(covers):
        return np.empty((0, 2), dtype=np.int64)
    covers = covers[np.lexsort((covers[:, 1], covers[:, 0]))].astype(np.int64)
    top = np.maximum.accumulate(covers[:, 1])
    new = np.concatenate(([True], covers[1:, 0] > top[:-1]))
    return np.column_stack((covers[new, 0], np.maximum.reduceat(covers[:, 1], np.flatnonzero(new))))


def removed_runs(docs: DataFrame, least: int = 100) -> DataFrame:
    """``doc_id, text, runs``: every row's text as UTF-8 bytes and its runs ``(start, end)`` of bytes to remove, each covered by a
    string of ``least`` bytes that also starts earlier: in a row with a smaller doc_id, or earlier in the same one.

    Null and empty texts and texts below ``least`` bytes have no runs. Rows without doc_id come before all others. Rows that
    share a doc_id count as one document: the smaller start is the earlier one, and equal texts under one doc_id keep theirs.
    Other columns are ignored; an empty table gives an empty one."""
    _, marks = _marks(docs, least)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for ids, texts, runs, _ in _runs_by_block(batches):
            runs = [[{"start": a, "end": b} for a, b in r] for r in runs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.binary()),
                 pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "text", "runs"])

    return marks.mapInArrow(cut, "doc_id long, text binary, runs array<struct<start: bigint, end: bigint>>")


def without_repeats(docs: DataFrame, least: int = 100) -> DataFrame:
    """``docs`` with the repeats of :func:`removed_runs` cut out of ``text`` (a character cut apart goes as a whole); all rows and
    other columns stay, null texts become empty."""
    _, marks = _marks(docs, least, carry=True)
    names, schema = docs.columns, docs.schema

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for _, texts, runs, rest in _runs_by_block(batches):
            kept = [_kept(t, r).decode("utf-8", "ignore") for t, r in zip(texts, runs)]
            others = pa.ipc.open_stream(rest).read_all().combine_chunks()
            columns = iter(others.columns)
            table = pa.table([pa.array(kept, pa.string()) if n == "text" else next(columns) for n in names], names=names)
            yield from table.to_batches()

    return marks.mapInArrow(cut, schema)


def _kept(text: bytes, runs: list) -> bytes:
    out, at = [], 0
    for start, end in runs:
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])


def _runs_by_block(batches: Iterator) -> Iterator[tuple[list, list, list, bytes | None]]:
    """For each block its doc_ids, texts, runs to remove and carried columns."""
    for batch in batches:
        at = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        for n in range(batch.num_rows):
            ids, texts = at["doc_ids"][n].as_py(), at["texts"][n].as_py()
            cover = np.frombuffer(b"".join(at["covers"][n].as_py() or []), "<i4").reshape(-1, 3)
            mine = np.frombuffer(at["own"][n].as_py() or b"", PLACES)
            mine = np.column_stack((mine["row"], mine["start"], mine["start"] + mine["length"].astype(np.int32)))
            cover = np.concatenate((cover, mine))
            cover = cover[np.argsort(cover[:, 0], kind="stable")]
            cuts = np.searchsorted(cover[:, 0], np.arange(len(texts) + 1))
            copies = set(at["copies"][n].as_py() or ())
            runs = [[(0, len(t))] if k in copies else runs_of(cover[cuts[k]:cuts[k + 1], 1:]).tolist() for k, t in enumerate(texts)]
            yield ids, texts, runs, at["rest"][n].as_py() if "rest" in at else None


def _marks(docs: DataFrame, least: int, carry: bool = False) -> tuple[DataFrame, DataFrame]:
    """The written blocks, and the same with what is to be removed from them (``copies, covers, own``)."""
    blocks = written(to_blocks(docs, carry), "blocks")
    n_bytes = blocks.agg(F.sum("n_bytes")).first()[0] or 0          # of the column of sizes alone
    buckets = max(8, -(-n_bytes // BUCKET_BYTES))

    def digests(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        for batch in batches:
            for block, ids, texts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names = [xxhash.xxh3_128_digest(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int32()), pa.array(ids, pa.int64()),
                     pa.array(names, pa.binary()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["block", "row", "doc_id", "digest", "size"])

    names = blocks.select("block", "doc_ids", "texts").mapInArrow(digests, "block long, row int, doc_id long, digest binary, size long")
    names = written(names.filter(F.col("size") >= least).withColumn("doc_id", F.coalesce("doc_id", F.lit(-2 ** 63))), "digests")
    firsts = names.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    copies = names.join(firsts, "digest").filter("doc_id > first").groupBy("block").agg(F.collect_list("row").alias("copies"))
    answers = written(repeated_anchors(blocks, least, buckets).join(copies, "block", "full"), "answers")
    sent = written(surroundings(blocks.select("block", "doc_ids", "texts").join(answers, "block"), least, buckets), "surroundings")
    own = sent.filter("bucket < 0").select("block", F.col("covers").alias("own"))
    found = repeated_places(sent, least).groupBy("block").agg(F.collect_list("covers").alias("covers"))
    marks = written(answers.select("block", "copies").join(found, "block", "left").join(own, "block", "left"), "marks")

    return blocks, blocks.join(marks, "block", "left").drop("n_bytes")


def removal(rows: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256`` of :func:`removed_runs`."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            texts, runs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            kept = [_kept(t, [(x["start"], x["end"]) for x in r]) for t, r in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
                 pa.array([len(r) for r in runs], pa.int64()), pa.array(kept, pa.binary()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
