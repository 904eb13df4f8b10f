"""Token ids in wavelet-matrix shards.

A shard holds the ids of consecutive documents (ascending doc_id) as a wavelet matrix: one bit-plane per bit of an id,
from the highest down; after each plane the ids are parted stably into those with a 0 and those with a 1. A directory of
counts before every 512th bit gives rank; select walks the planes back, searching it at each. Access, counting and the places of a token
need only the planes. A shard numbers the ids that occur in it (its alphabet), so it has as few planes as they need.

A shard is one row of a Parquet file written by Spark (zstd-compressed, committed once, on any file system Spark
knows). Shards are cut at document boundaries after ``shard_tokens`` ids, so a task's memory is bounded by a shard and
its longest document.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tcelake.llm.common import shared_path, texts_of, written
from tcelake.llm.tokens import binary_column, encoder

BLOCK = 512
SHARD = ("part int, before long, n_tokens long, n_bits int, doc_ids array<long>, lengths array<long>, "
         "alphabet binary, planes array<binary>, directory array<binary>, zeros array<long>")


class WaveletMatrix:
    """Succinct sequence of unsigned integers below 2 ** n_bits with access, rank and select."""

    def __init__(self, n: int, n_bits: int, planes: list, directory: list, zeros: list):
        self.n, self.n_bits, self.zeros = n, n_bits, list(zeros)
        self.planes = [np.frombuffer(p, dtype=np.uint8) for p in planes]
        self.directory = [np.frombuffer(d, dtype="<u4") for d in directory]

    @classmethod
    def build(cls, ids: np.ndarray, n_bits: int) -> "WaveletMatrix":
        planes, directory, zeros = [], [], []
        for bit in reversed(range(n_bits)):
            ones = (ids & ids.dtype.type(1 << bit)) != 0
            packed = np.packbits(ones, bitorder="little")
            padded = np.zeros(-(-max(len(ids), 1) // BLOCK) * BLOCK // 8, dtype=np.uint8)
            padded[:len(packed)] = packed
            per_block = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
            planes.append(packed.tobytes())
            directory.append((np.cumsum(per_block) - per_block).astype("<u4").tobytes())
            zeros.append(len(ids) - int(per_block.sum()))
            ids = np.concatenate((ids.compress(~ones), ids.compress(ones)))
        return cls(len(ids), n_bits, planes, directory, zeros)

    def parts(self) -> tuple[list, list, list]:
        return [p.tobytes() for p in self.planes], [d.tobytes() for d in self.directory], self.zeros

    def _ones_before(self, plane: int, i: int) -> int:
        start = i // BLOCK
        whole, rest = self.planes[plane][start * BLOCK // 8:i // 8], i % 8
        count = int(self.directory[plane][start]) if start < len(self.directory[plane]) else self.n - self.zeros[plane]
        count += int(np.bitwise_count(whole).sum())
        return count + (int(self.planes[plane][i // 8] & ((1 << rest) - 1)).bit_count() if rest else 0)

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.n_bits):
            one, before = self.planes[plane][i // 8] >> (i % 8) & 1, self._ones_before(plane, i)
            i = self.zeros[plane] + before if one else i - before
            value = value << 1 | int(one)
        return value

    def rank(self, value: int, i: int) -> int:
        """How often value stands before place i."""
        if value < 0 or value >> self.n_bits:
            return 0
        low, high = 0, min(i, self.n)
        for plane in range(self.n_bits):
            a, b = self._ones_before(plane, low), self._ones_before(plane, high)
            one = value >> (self.n_bits - 1 - plane) & 1
            low, high = (self.zeros[plane] + a, self.zeros[plane] + b) if one else (low - a, high - b)
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def places(self, value: int) -> np.ndarray:
        """All places of value, ascending: its run below the last plane, mapped back plane by plane."""
        if value < 0 or value >> self.n_bits or not self.n:
            return np.empty(0, dtype=np.int64)
        low, high = 0, self.n
        for plane in range(self.n_bits):
            a, b = self._ones_before(plane, low), self._ones_before(plane, high)
            one = value >> (self.n_bits - 1 - plane) & 1
            low, high = (self.zeros[plane] + a, self.zeros[plane] + b) if one else (low - a, high - b)
        at = np.arange(low, high)
        for plane in reversed(range(self.n_bits)):
            bits = np.unpackbits(self.planes[plane], bitorder="little", count=self.n).view(bool)
            one = value >> (self.n_bits - 1 - plane) & 1
            at = np.flatnonzero(bits)[at - self.zeros[plane]] if one else np.flatnonzero(~bits)[at]
        return at

    def _bit_place(self, plane: int, one: bool, k: int) -> int:
        """The place of the k-th (from 0) bit of this kind: its block by binary search in the directory, then within the block."""
        ones = self.directory[plane]
        before = (lambda b: int(ones[b])) if one else (lambda b: b * BLOCK - int(ones[b]))
        block = bisect_right(range(len(ones)), k, key=before) - 1
        bits = np.unpackbits(self.planes[plane][block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits if one else bits == 0)[k - before(block)])

    def select(self, value: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of value; -1 if there are fewer. One directory search a plane."""
        if k < 0 or k >= self.count(value):
            return -1
        low = 0
        ones = [bool(value >> (self.n_bits - 1 - plane) & 1) for plane in range(self.n_bits)]
        for plane, one in enumerate(ones):
            before = self._ones_before(plane, low)
            low = self.zeros[plane] + before if one else low - before
        at = low + k
        for plane in reversed(range(self.n_bits)):
            at = self._bit_place(plane, ones[plane], at - self.zeros[plane] if ones[plane] else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order, from the last plane up: every plane deals the order below it back to its zeros and ones."""
        kind = np.uint16 if self.n_bits <= 16 else np.uint32
        ids, above = np.zeros(self.n, dtype=kind), np.empty(self.n, dtype=kind)
        for plane in reversed(range(self.n_bits)):
            ones = np.unpackbits(self.planes[plane], bitorder="little", count=self.n).view(bool)
            ids[self.zeros[plane]:] |= kind(1 << (self.n_bits - 1 - plane))
            above[np.flatnonzero(ones)] = ids[self.zeros[plane]:]
            above[np.flatnonzero(np.logical_not(ones, out=ones))] = ids[:self.zeros[plane]]
            ids, above = above, ids
        return ids


def token_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, ids``: the ids of the whole text and ``end_id`` (a null text is empty), 16 or 32 bits each."""
    wide = encoder(tokenizer).vocab_size > 1 << 16 or end_id >> 16

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        own, end = encoder(tokenizer).encode, np.uint32(end_id).astype("<u4").tobytes()
        for batch in batches:
            ids = [own(text.as_py()) + end for text in binary_column(batch, "text")]
            if not wide:
                ids = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return texts_of(docs).mapInArrow(encode, "doc_id long, ids binary").withMetadata("ids", {"bytes": 4 if wide else 2})


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_tokens: int = 1 << 18) -> None:
    """Writes the wavelet shards of all documents, ascending doc_id (nulls first), as the Parquet folder ``path``.

    Repeated doc_ids keep a row each. An empty table writes a folder without shards."""
    tokens = token_ids(docs, tokenizer, end_id)
    kind = "<u4" if tokens.schema["ids"].metadata["bytes"] == 4 else "<u2"
    n_ids = max(encoder(tokenizer).vocab_size, end_id + 1)
    # Written once: the range partitioning below samples its input, which must not encode everything a second time.
    tokens = written(tokens, "token-ids", "snappy").repartitionByRange("doc_id").sortWithinPartitions("doc_id")

    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        part, before, doc_ids, held, size = TaskContext.get().partitionId(), 0, [], [], 0
        schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("n_bits", pa.int32()),
                            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("alphabet", pa.binary()),
                            ("planes", pa.list_(pa.binary())), ("directory", pa.list_(pa.binary())),
                            ("zeros", pa.list_(pa.int64()))])

        def flush():
            ids = np.concatenate(held)
            alphabet = np.flatnonzero(np.bincount(ids, minlength=n_ids))
            code = np.zeros(n_ids, dtype=np.uint32 if len(alphabet) > 1 << 16 else np.uint16)
            code[alphabet] = np.arange(len(alphabet))
            matrix = WaveletMatrix.build(code[ids], max(len(alphabet) - 1, 1).bit_length())
            row = (part, before, matrix.n, matrix.n_bits, doc_ids, [len(x) for x in held], alphabet.astype("<u4").tobytes(),
                   *matrix.parts())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                held.append(np.frombuffer(raw.as_py(), kind))
                size += len(held[-1])
                if size >= shard_tokens:
                    yield flush()
                    before, doc_ids, held, size = before + size, [], [], 0
        if held:
            yield flush()

    tokens.mapInArrow(build, SHARD).write.option("compression", "zstd").parquet(path)


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the shards alone.

    ``start`` counts the ids of all documents before: a shard carries the count within its part, and the totals of the
    parts before it come from one row per write task, the only table broadcast."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for row in range(batch.num_rows):
                at = {c: batch.column(i)[row] for i, c in enumerate(batch.schema.names)}
                matrix = WaveletMatrix(at["n_tokens"].as_py(), at["n_bits"].as_py(), at["planes"].as_py(),
                                       at["directory"].as_py(), at["zeros"].as_py())
                ids = np.frombuffer(at["alphabet"].as_py(), "<u4")[matrix.decode()]
                lengths = np.array(at["lengths"].as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at["doc_ids"].as_py(), pa.int64()), pa.array(at["first"].as_py() + at["before"].as_py() + ends - lengths),
                     pa.array(lengths), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.join(F.broadcast(first), "part").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _shard(batch, row: int) -> tuple[WaveletMatrix, np.ndarray, list, np.ndarray]:
    """A shard's matrix, its alphabet, its doc_ids and the places where its documents end."""
    at = {c: batch.column(i)[row].as_py() for i, c in enumerate(batch.schema.names)}
    matrix = WaveletMatrix(at["n_tokens"], at["n_bits"], at["planes"], at["directory"], at["zeros"])
    return matrix, np.frombuffer(at["alphabet"], "<u4"), at["doc_ids"], np.cumsum(np.array(at["lengths"], dtype=np.int64))


def _code(alphabet: np.ndarray, token: int) -> int | None:
    """The number of a token in a shard's alphabet, None where the shard does not hold it."""
    i = int(np.searchsorted(alphabet, token)) if 0 <= token < 1 << 32 else len(alphabet)
    return i if i < len(alphabet) and alphabet[i] == token else None


def token_counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """``token, n``: how often each of these tokens stands in all shards, zeros included, by rank alone. ``tokens`` is a stated
    query set; repeated ones count once."""
    asked = sorted(set(tokens))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for row in range(batch.num_rows):
                matrix, alphabet, _, _ = _shard(batch, row)
                codes = [_code(alphabet, t) for t in asked]
                yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()),
                                                  pa.array([0 if c is None else matrix.count(c) for c in codes], pa.int64())], names=["token", "n"])

    zeros = shards.sparkSession.createDataFrame([(t, 0) for t in asked], "token long, n long")
    return shards.mapInArrow(run, "token long, n long").union(zeros).groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(shards: DataFrame, token: int, batch_rows: int = 1 << 14) -> DataFrame:
    """``doc_id, place`` (from 0 in its document) of every occurrence of a token, found in the compressed shards: shards without
    it stop at their alphabet, the others map its run back plane by plane. Rows of ``batch_rows`` leave a task at a time."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for row in range(batch.num_rows):
                matrix, alphabet, doc_ids, ends = _shard(batch, row)
                code = _code(alphabet, token)
                places = matrix.places(code) if code is not None else np.empty(0, dtype=np.int64)
                for start in range(0, len(places), batch_rows):
                    own = places[start:start + batch_rows]
                    doc = np.searchsorted(ends, own, side="right")
                    first = np.concatenate(([0], ends))[doc]
                    yield pa.RecordBatch.from_arrays([pa.array([doc_ids[i] for i in doc], pa.int64()), pa.array(own - first, pa.int64())],
                                                     names=["doc_id", "place"])

    return shards.mapInArrow(run, "doc_id long, place long")


def tokens_at(shards: DataFrame, places: dict[int, list[int]]) -> DataFrame:
    """``doc_id, place, token`` for stated places of stated documents, by access; places outside a document give no row, rows
    that repeat a doc_id give theirs each."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for row in range(batch.num_rows):
                matrix, alphabet, doc_ids, ends = _shard(batch, row)
                found = [(d, p, int(alphabet[matrix.access(int(end) - n + p)]))
                         for d, end, n in zip(doc_ids, ends, np.diff(ends, prepend=0)) for p in places.get(d, ()) if 0 <= p < n]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=["doc_id", "place", "token"])

    # A shard without any of the documents is not read beyond its list of them.
    asked = F.array(*[F.lit(d).cast("long") for d in places]) if places else F.array().cast("array<long>")
    return shards.filter(F.arrays_overlap("doc_ids", asked)).mapInArrow(run, "doc_id long, place long, token long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, shard_tokens: int = 1 << 18) -> DataFrame:
    """Writes the shards of ``docs`` to the shared folder and returns what :func:`read_documents` finds in them."""
    spark = docs.sparkSession
    path = shared_path(spark, "wavelet")
    write_shards(docs, path, tokenizer, end_id, shard_tokens)
    return read_documents(spark.read.schema(SHARD).parquet(path))
