"""Near-duplicate documents by SuperMinHash signatures, banding, verification on full shingle sets and union-find.

Every element of a shingle set walks its own pseudo-random permutation of the signature's places; at step j it offers the
value j + r to the place it meets (r random below 1), and each place keeps its minimum. Ranks of one element are correlated
(each place is met once), which lowers the variance against independent hashes, and a document is done as soon as all its
values are at most the step reached: large sets after two or three steps.

Equal sets are one class, named by its smallest doc_id. Classes that agree in a whole band meet in a bucket. A bucket does
not emit all its pairs: its classes are linked to one pivot (the class that meets most others), the links are verified on
the full sets and joined into components. Only buckets whose classes are then still apart are compared as a whole, block
by block within tasks that give back links alone, so no link between different components is missed and no bucket's
pairs are written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tcelake.llm.common import texts_of, written
from tcelake.llm.graph import components

BANDS, BAND_SIZE = 25, 5
PLACES = BANDS * BAND_SIZE
CHUNK = 100_000          # elements whose permutations a task holds at a time
BLOCK = 1024             # classes of a bucket that a task compares with as many others
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit counter-based generator."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """word -> 64-bit hash, kept per task up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, width: int, words: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles: A-Z lower-cased, words parted by ASCII white space; a text with fewer
    words has one for its whole sequence, one without words none."""
    found = text.lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        out = mixed(out * _STEP + h[j:len(h) - width + 1 + j])
    return np.unique(out)


def superminhash(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """Signatures (one row per set, none of them empty) of sets of 64-bit elements."""
    lengths = np.array([len(s) for s in sets])
    signature = np.full((len(sets), places), np.inf)
    flat = signature.ravel()
    x, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    walk = np.tile(np.arange(places, dtype=np.uint16), (len(x), 1))
    rows = np.arange(len(x))
    for j in range(places):
        random = mixed(x + np.uint64((j + 1) * int(_STEP) % 2 ** 64))
        k = j + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(places - j) >> np.uint64(32)).astype(np.int64)
        met = walk[rows, k]
        walk[rows, k] = walk[rows, j]
        value = j + (random >> np.uint64(32)).astype(np.float64) / 2 ** 32
        np.minimum.at(flat, doc * places + met, value)
        going = signature.max(axis=1) > j + 1
        keep = going[doc]
        if not keep.any():
            break
        if not keep.all():
            x, doc, rows = x[keep], doc[keep], rows[keep]
    return signature


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    parts = signature.view(np.uint64).reshape(len(signature), bands, -1)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for j in range(parts.shape[2]):
        key = mixed(key * _STEP + parts[:, :, j])
    return key.view(np.int64)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, bands``: set size, a 128-bit name of the set and its band keys (null for empty sets)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        words = Words()

        def rows(doc_ids: list, sets: list[np.ndarray]):
            names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            pair = np.frombuffer(b"".join(n or bytes(16) for n in names), dtype="<i8").reshape(-1, 2)
            empty = np.array([not len(s) for s in sets], dtype=bool)
            keys = iter(band_keys(superminhash(full)) if (full := [s for s in sets if len(s)]) else ())
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(pair[:, 0], mask=empty),
                 pa.array(pair[:, 1], mask=empty), pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])

        for batch in batches:
            doc_ids, sets, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                sets.append(shingles(text.as_py().encode(), width, words))
                size += len(sets[-1])
                if size > CHUNK:
                    yield rows(doc_ids, sets)
                    doc_ids, sets, size = [], [], 0
            if doc_ids:
                yield rows(doc_ids, sets)

    return texts_of(docs).mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``id, shingles`` (array<long>) of ``doc_id, text``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        words = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t.as_py().encode(), width, words).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "id long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets have 100 * intersection >= percent * union."""
    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(x, "a").join(y, "b")
    low, high = F.least(F.size("x"), F.size("y")), F.greatest(F.size("x"), F.size("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (both.filter(100 * low >= percent * high)
            .withColumn("common", common).filter(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common")))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``; other columns are ignored).

    Links join documents whose shingle sets of ``width`` words have 100 * intersection >= ``percent`` * union;
    ``component_id`` is the smallest doc_id reachable, ``kept`` tells whether it is the row's own. Null and empty texts and
    texts without words have empty sets and stay alone, as do rows without doc_id (component null, kept). Rows that repeat
    a doc_id share its component. An empty table gives an empty one."""
    texts = texts_of(docs)
    signs = written(signed(texts, width), "signatures")
    classes = written(signs.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "classes")
    posts = classes.select("id", F.explode("bands").alias("key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(posts.join(shared, "key"), "buckets")                     # key, id, n
    wanted = members.select("id").distinct()
    found = texts.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id")
    sets = written(shingle_sets(found, width), "sets")

    weight = members.groupBy("id").agg(F.sum("n").alias("weight"))
    pivots = members.join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("low"))).alias("top"))
    pairs = members.join(pivots, "key").select((-F.col("top.low")).alias("p"), "id").filter("p <> id")
    ordered = lambda df: df.select(F.least("p", "id").alias("a"), F.greatest("p", "id").alias("b")).distinct()
    links = written(verified(ordered(pairs), sets, percent), "links")
    labels = components(links)
    named = members.select("key", "id").join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    # Buckets with classes still apart; in a bucket of two the only pair has been verified. Equal buckets count once.
    alike = named.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("name"),
                                     F.min("component").alias("low"), F.max("component").alias("high"))
    apart = alike.filter("n > 2 and low < high").groupBy("n", "name").agg(F.min("key").alias("key"))
    apart = written(named.join(apart.select("key", "n"), "key"), "apart")
    more = linked_apart(apart, sets, percent)
    return _named(signs, classes, components(links.unionByName(more)))


def linked_apart(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between different components within buckets ``key, id, component, n``, one for each two components and
    pair of blocks. A bucket is dealt into blocks of about ``BLOCK`` classes by hash; a task compares two blocks by the
    product of their shingle incidence matrices, and no pair leaves it but the links."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = apart.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    dealt = own.select("key", "id", "component", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        "key", "id", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(key, table):
        import pyarrow as pa
        ids, parts, block = (table[c].to_numpy() for c in ("id", "component", "own"))
        shingle = table["shingles"].combine_chunks()
        size = shingle.value_lengths().to_numpy().astype(np.int64)
        names, column = np.unique(shingle.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(ids)), size)
        left, right = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        common = np.zeros((len(left), len(right)), dtype=np.float32)
        step = max(1, 4_000_000 // len(ids))               # columns of the incidence matrix held at a time
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        for low in range(0, len(names), step):
            at = slice(*np.searchsorted(column, (low, low + step)))
            matrix = np.zeros((len(ids), min(step, len(names) - low)), dtype=np.float32)
            matrix[row[at], column[at] - low] = 1
            common += matrix[left] @ matrix[right].T
        common = common.astype(np.int64)                   # sets below 2^24 shingles: counted exactly
        union = size[left][:, None] + size[right][None, :] - common
        x, y = np.nonzero((100 * common >= percent * union) & (parts[left][:, None] != parts[right][None, :]))
        x, y = left[x], right[y]
        pairs = np.sort(np.stack((parts[x], parts[y]), axis=1), axis=1)
        first = np.unique(pairs, axis=0, return_index=True)[1] if len(x) else np.empty(0, dtype=np.int64)
        return pa.table({"a": ids[x[first]], "b": ids[y[first]]})

    return dealt.join(sets, "id").groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def _named(signs: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    names = classes.select("set_a", "set_b", "id").join(labels, "id", "left").select(
        "set_a", "set_b", F.coalesce("component", "id").alias("component"))
    joined = signs.drop("bands").join(names, ["set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
