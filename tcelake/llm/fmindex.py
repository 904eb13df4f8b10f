"""Phrase collocations from FM-indexes over word ids.

A shard is a run of pieces of one language as word ids, parted by id 0, with the Burrows-Wheeler transforms of the run and of
its reverse. Suffixes are ordered by their first ``DEPTH`` words or more, which is all that phrases of that many words need. A phrase is a pair of
row intervals, one per direction, of the same width, its count. Extending all phrases of a length by a word, to the right on
the reverse transform or to the left on the forward one, is one pass over the rows of their intervals: the symbols found
there are the extensions, how often each is found is the count, the symbol's rank before the interval gives the new interval on one
side and the smaller symbols within it that on the other.

Counts are summed across shards. First by hash, words, then pairs of frequent words, then triples of frequent pairs: hashes with a large enough
sum are handed back to the shards as a bitmap of fixed size, so that rare phrases are mostly not written at all. What the bitmaps let
through is then counted by its text; hashes that collide or bits that are shared only let more through, which its own count drops.

Hashes travel packed: a task adds up what its shards hold and sends, per range of hashes, one row with the sorted lower halves of the hashes
and their counts, some five bytes a phrase; texts go as lines, in the shards' order within a range. The ranges grow in number with the words of the index, so that each stays small.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tcelake.llm.bloom import bitmap_of, may_hold
from tcelake.llm.common import LARGE_ROWS, written
from tcelake.llm.superminhash import mixed

DEPTH = 3                             # words of the longest phrase
SHARD_WORDS = 1 << 19                 # words of a shard: bounds a task's memory
OPEN_SHARDS = 4                       # shards' worth of words that a task holds over all languages
HELD_KEYS = 1 << 22                   # hashes of phrases that a task adds up before it sends them
HELD_TEXTS = 1 << 21                  # the same of their texts
RANGE_WORDS = 1 << 21                 # words of the index for each range of hashes, of which there are LEAST_RANGES or more
LEAST_RANGES = 64
SALTS = 16                            # parts into which the phrases of one word, or the best of one language, are dealt
MARK = b"\xff"                        # stands for the ends of pieces while a text is split; no UTF-8 text holds it
#: Bytes that part pieces become the mark, A-Z lower case, the tab a space.
_FOLD = bytes(255 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
SHARD = "lang string, n_words long, words array<binary>, hashes binary, ids_bwt binary, reverse_bwt binary, overlaps binary"
PACKED = "range int, low binary, n binary"
LINES = "lang string, range int, phrases string, n binary"


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys and each key's dense rank."""
    order = np.argsort(key)
    step = np.empty(len(key), dtype=np.int64)
    ordered = key[order]
    step[:1], step[1:] = 0, ordered[1:] != ordered[:-1]
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.cumsum(step)
    return order, rank


def transform(ids: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Burrows-Wheeler transform of the circular run with rotations ordered by at least ``depth`` symbols: as many as fit into 63
    bits are compared at once, and ranks of twice the length come from pairs of ranks where that is not enough."""
    symbols, bits = ids.astype(np.int64), max(1, int(ids.max()).bit_length())
    known = min(depth, 63 // bits)
    key = symbols.copy()
    for j in range(1, known):
        key = (key << bits) | np.roll(symbols, -j)
    if known == depth:
        return ids[np.argsort(key) - 1]
    order, rank = ranked(key)
    while known < depth:
        order, rank = ranked(rank * (int(rank.max()) + 1) + np.roll(rank, -known))
        known *= 2
    return ids[order - 1]


class Direction:
    """One transform with what ranks need: the first row of every symbol and, made when first asked for, the rows of each symbol's
    occurrences."""

    def __init__(self, bwt: np.ndarray):
        self.bwt, self.n = bwt.astype(np.int64), len(bwt)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(self.bwt))))

    @cached_property
    def places(self) -> np.ndarray:
        return np.sort(self.bwt * self.n + np.arange(self.n))

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of the symbols before the rows."""
        return np.searchsorted(self.places, symbol * self.n + row) - self.first[symbol]

    def extend(self, low: np.ndarray, other: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of phrases with the intervals ``low``, ``low + count`` here and ``other``, ``other + count`` in
        the other direction: ``(phrase, symbol, low, other, count)``, symbol 0 left out."""
        begin = np.cumsum(count) - count
        phrase = np.repeat(np.arange(len(low)), count)
        rows = np.arange(int(count.sum())) - np.repeat(begin - low, count)
        width = len(self.first)
        key, n = np.unique(phrase * width + self.bwt[rows], return_counts=True)
        phrase, symbol = key // width, key % width
        before = np.cumsum(n) - n - begin[phrase]               # rows of the interval with smaller symbols
        keep = symbol > 0
        phrase, symbol, n, before = phrase[keep], symbol[keep], n[keep], before[keep]
        return phrase, symbol, self.first[symbol] + self.rank(symbol, low[phrase]), other[phrase] + before, n


class Shard:
    """A shard's two transforms; phrases are (word ids as columns, forward low, reverse low, count)."""

    def __init__(self, forward: np.ndarray, reverse: np.ndarray):
        self.forward, self.reverse = Direction(forward), Direction(reverse)

    def words(self) -> tuple[np.ndarray, ...]:
        first = self.forward.first
        ids = np.arange(1, len(first) - 1)
        return ids[:, None], first[ids], first[ids], first[ids + 1] - first[ids]

    def right(self, phrases: tuple) -> tuple[np.ndarray, ...]:
        """All phrases with one more word at the end: read off the reverse transform, where it comes before."""
        ids, low, back, count = phrases
        phrase, symbol, back, low, count = self.reverse.extend(back, low, count)
        return np.column_stack((ids[phrase], symbol)), low, back, count

    def left(self, phrases: tuple) -> tuple[np.ndarray, ...]:
        """All phrases with one more word in front."""
        ids, low, back, count = phrases
        phrase, symbol, low, back, count = self.forward.extend(low, back, count)
        return np.column_stack((symbol, ids[phrase])), low, back, count


def chosen(phrases: tuple, keep: np.ndarray) -> tuple:
    return tuple(x[keep] for x in phrases)


class Vocabulary(dict):
    """word -> id in the shard, from 1; the mark is 0."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Index shards (``SHARD``) of ``lang, text``. A piece longer than a shard is cut with an overlap of ``DEPTH`` - 1 words; what the overlaps
    hold is listed, since it is counted on both sides."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        held: dict[str, tuple] = {}
        schema = pa.schema([("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.binary())), ("hashes", pa.binary()), ("ids_bwt", pa.binary()), ("reverse_bwt", pa.binary()), ("overlaps", pa.binary())])

        def flush(lang: str, rest: tuple | None = None):
            vocabulary, ids = held.pop(lang)
            run = np.concatenate((np.zeros(1, dtype=np.uint32), *ids, np.zeros(1, dtype=np.uint32)))
            shared = np.array([vocabulary[w] for w in rest] if rest else [], dtype="<u4")
            words = [w for w in vocabulary if w != MARK]
            row = (lang, int((run > 0).sum()) - len(shared), words, word_hashes(lang, words).astype("<u8").tobytes(), transform(run).astype("<u4").tobytes(), transform(run[::-1]).astype("<u4").tobytes(), shared.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        def opened(lang: str) -> tuple:
            if lang not in held:
                held[lang] = (Vocabulary({MARK: 0}), [])
            return held[lang]

        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = text.as_py().encode().translate(_FOLD).replace(MARK, b" \xff ").split()
                while found:
                    vocabulary, ids = opened(lang)
                    room = shard_words - size.get(lang, 0)
                    part, found = found[:room], found[room:]
                    ids.append(np.fromiter(map(vocabulary.__getitem__, part), dtype=np.uint32, count=len(part)))
                    size[lang] = size.get(lang, 0) + len(part)
                    if found:
                        tail = part[-(DEPTH - 1):]
                        while MARK in tail:
                            tail = tail[tail.index(MARK) + 1:]
                        yield flush(lang, tuple(tail))
                        size[lang], found = 0, tail + found
                ids = held[lang][1] if lang in held else None
                if ids:
                    ids.append(np.zeros(1, dtype=np.uint32))
                    if size[lang] >= shard_words:
                        yield flush(lang)
                        size[lang] = 0
                    elif sum(size.values()) >= OPEN_SHARDS * shard_words:       # many languages in one task
                        largest = max(size, key=size.get)
                        yield flush(largest)
                        size[largest] = 0
        for lang in list(held):
            yield flush(lang)

    return docs.select("lang", "text").mapInArrow(run, SHARD)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    import xxhash
    head = lang.encode() + MARK
    return np.fromiter((xxhash.xxh3_64_intdigest(head + w) for w in words), dtype=np.uint64, count=len(words))


def phrase_keys(words: np.ndarray, bits: int) -> np.ndarray:
    """Hashes of ``bits`` bits of phrases from their words' hashes, a phrase per row."""
    out = np.full(len(words), words.shape[1], dtype=np.uint64)
    for j in range(words.shape[1]):
        out = mixed(out * _STEP + words[:, j])
    return out >> np.uint64(64 - bits)


def spread(keys: np.ndarray) -> np.ndarray:
    """The keys as the 64-bit hashes that bitmaps take their places from."""
    return mixed(keys * _STEP)


def key_bits(n_words: int) -> int:
    """Bits of the keys of an index of so many words: 32 within a range, the others are the range's number."""
    return 32 + (max(LEAST_RANGES, n_words // RANGE_WORDS) - 1).bit_length()


def grown(shard: Shard, hashes: np.ndarray, length: int, bitmaps: dict[int, np.ndarray], bits: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The shard's phrases of one word, of two, up to ``length``, grown to the right and to the left by turns: those that may be frequent,
    as far as there are bitmaps, and whose shorter parts all may be."""
    phrases = shard.words()
    for m in range(1, length + 1):
        if m > 1:
            phrases = shard.left(phrases) if m % 2 else shard.right(phrases)
            other = phrases[0][:, :-1] if m % 2 else phrases[0][:, 1:]          # the part that was not extended
            phrases = chosen(phrases, may_hold(bitmaps[m - 1], spread(phrase_keys(hashes[other], bits))))
        if m in bitmaps:
            phrases = chosen(phrases, may_hold(bitmaps[m], spread(phrase_keys(hashes[phrases[0]], bits))))
        yield phrases


def starts(of: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the length."""
    return np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])[:len(of)]), len(of)).astype(np.int32)


def added(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in ascending order and the sums of their counts, none above ``most``."""
    order = np.argsort(keys)
    keys = keys[order]
    first = starts(keys)[:-1]
    return keys[first], np.minimum(np.add.reduceat(counts[order], first, dtype=np.int64), most)


def packed(keys: np.ndarray, counts: np.ndarray, bits: int, most: int):
    """Record batch (``PACKED``) of ascending keys and counts up to ``most``, a row per range that has any."""
    import pyarrow as pa
    bounds = np.searchsorted(keys, np.arange((1 << (bits - 32)) + 1, dtype=np.uint64) << np.uint64(32))
    ranges = np.flatnonzero(np.diff(bounds))
    ends = np.append(bounds[ranges], len(keys))

    def parts(values: np.ndarray):
        return pa.Array.from_buffers(pa.binary(), len(ranges), [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])

    low, n = parts(keys.astype("<u4")), parts(counts.astype(np.min_scalar_type(most)))
    return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), low, n], names=["range", "low", "n"])


def unpacked(binaries: Iterable, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(b.as_buffer(), dtype) for b in binaries])


@contextmanager
def shards_per_batch(spark: SparkSession, n: int = 2) -> Iterator[None]:
    """While it holds, jobs hand ``n`` rows at a time to Python: a row of the index is a shard of megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def loaded(batches: Iterator) -> Iterator[tuple]:
    """``(shard, hashes of the words by id, overlaps, further columns)`` of all index rows, selected by ``_columns``."""
    for batch in batches:
        for row in range(batch.num_rows):
            forward, reverse, hashes, overlaps, *more = (c[row] for c in batch.columns)
            ids = [np.frombuffer(x.as_py(), "<u4") for x in (forward, reverse, overlaps)]
            hashes = np.concatenate((np.zeros(1, dtype=np.uint64), np.frombuffer(hashes.as_py(), "<u8")))
            yield Shard(*ids[:2]), hashes, ids[2], more


def counted_once(phrases: tuple, overlaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, count)`` without what an overlap holds, which is counted in the next shard."""
    ids, _, _, count = phrases
    length = ids.shape[1]
    for at in range(len(overlaps) - length + 1):
        count = count - (ids == overlaps[at:at + length]).all(axis=1)
    return ids[count > 0], count[count > 0]


def _columns(index: DataFrame, *more: str) -> DataFrame:
    return index.select("ids_bwt", "reverse_bwt", "hashes", "overlaps", *more)


def frequent_bitmap(index: DataFrame, length: int, least: int, bitmaps: dict[int, np.ndarray], bits: int) -> np.ndarray:
    """Bitmap of the keys of all phrases of ``length`` words that occur ``least`` times over all shards."""
    held = index.sparkSession.sparkContext.broadcast(dict(bitmaps))
    kind = np.min_scalar_type(least)

    def run(batches: Iterator) -> Iterator:
        keys, counts, size = [], [], 0
        for shard, hashes, overlaps, _ in loaded(batches):
            *_, phrases = grown(shard, hashes, length, held.value, bits)
            ids, count = counted_once(phrases, overlaps)
            keys.append(phrase_keys(hashes[ids], bits))
            counts.append(np.minimum(count, least).astype(kind))        # enough of them is all that counts
            size += len(ids)
            if size >= HELD_KEYS:
                yield packed(*added(np.concatenate(keys), np.concatenate(counts), least), bits, least)
                keys, counts, size = [], [], 0
        if size:
            yield packed(*added(np.concatenate(keys), np.concatenate(counts), least), bits, least)

    def frequent(key, rows):
        import pyarrow as pa
        low, n = added(unpacked(rows.column("low"), "<u4"), unpacked(rows.column("n"), kind), least)
        return pa.table({"h": (low[n >= least].astype(np.uint64) | np.uint64(key[0].as_py() << 32)).view(np.int64)})

    sums = _columns(index).mapInArrow(run, PACKED).groupBy("range").applyInArrow(frequent, "h long")
    with shards_per_batch(index.sparkSession):
        found = written(sums, "frequent-hashes")
    return bitmap_of(found, lambda batch: spread(batch.column(0).to_numpy().view(np.uint64)))


def lines(lang: str, found, bits: int):
    """Record batch (``LINES``) of a table ``phrase, key, n`` of one language: a row per range that has any, with a line for each text."""
    import pyarrow as pa
    import pyarrow.compute as pc
    found = found.group_by("phrase", use_threads=False).aggregate([("key", "min"), ("n", "sum")])      # a text has one key
    of = found.column("key_min").to_numpy() >> 32
    order = np.argsort(of, kind="stable")                               # phrases with a word in common stay together
    of, ends = of[order], starts(of[order])
    phrases = found.column("phrase").combine_chunks().take(pa.array(order))
    n = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends * np.int32(8)), pa.py_buffer(found.column("n_sum").to_numpy()[order].astype("<i8"))])
    return pa.RecordBatch.from_arrays([pa.array([lang] * (len(ends) - 1), pa.string()), pa.array(of[ends[:-1]].astype(np.int32)),
                                       pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), phrases), "\n"), n], names=["lang", "range", "phrases", "n"])


def phrase_counts(index: DataFrame, bitmaps: dict[int, np.ndarray], bits: int) -> DataFrame:
    """``lang, phrase, length, n``: phrases of up to ``DEPTH`` words with their counts over all shards, but for those that the
    bitmaps rule out, themselves or by a part. No word holds a space or a line feed."""
    held = index.sparkSession.sparkContext.broadcast(dict(bitmaps))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        found, size = defaultdict(list), 0
        for shard, hashes, overlaps, (lang, words) in loaded(batches):
            text = pa.concat_arrays([pa.array([b""], pa.binary()), words.values]).cast(pa.string())
            for length, phrases in enumerate(grown(shard, hashes, DEPTH, held.value, bits), 1):
                ids, count = counted_once(phrases, overlaps)
                columns = [text.take(pa.array(ids[:, j])) for j in range(length)]
                phrase = pc.binary_join_element_wise(*columns, " ") if length > 1 else columns[0]
                key = pa.array(phrase_keys(hashes[ids], bits).view(np.int64))
                found[lang.as_py()].append(pa.table({"phrase": phrase, "key": key, "n": pa.array(count, pa.int64())}))
                size += len(ids)
            if size >= HELD_TEXTS:
                yield from (lines(lang, pa.concat_tables(own), bits) for lang, own in found.items())
                found, size = defaultdict(list), 0
        yield from (lines(lang, pa.concat_tables(own), bits) for lang, own in found.items())

    def counted(key, rows):
        import pyarrow as pa
        import pyarrow.compute as pc
        phrases = pa.chunked_array([pc.split_pattern(chunk, "\n").values for chunk in rows.column("phrases").chunks], pa.string())
        sums = pa.table({"phrase": phrases, "n": unpacked(rows.column("n"), "<i8")}).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
        length = pc.add(pc.count_substring(sums.column("phrase"), " "), pa.scalar(1, pa.int32()))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(sums), pa.string()), "phrase": sums.column("phrase"), "length": length, "n": sums.column("n_sum")})

    rows = _columns(index, "lang", "words").mapInArrow(run, LINES)
    return rows.groupBy("lang", "range").applyInArrow(counted, "lang string, phrase string, length int, n long")


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """``floor(1000000 * a * a / (l * r))`` in decimals of 38 digits: exact for counts up to 10^15."""
    exact = [c.cast("decimal(19,0)") for c in (a, l, r)]
    return F.call_function("div", (exact[0] * exact[0]).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)"), exact[1] * exact[2])


def collocations(docs: DataFrame, least: int = 10, percent: int = 50, best: int = 2000, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``best`` phrases of two to ``DEPTH`` words of ``docs`` (``lang, text``; other
    columns are ignored), by score, then count, descending, then phrase in byte order.

    ``n`` counts the language's words, ``a`` the phrase (at least ``least``), ``l`` and ``r`` its two parts at the cut with the lowest
    ``floor(1000000 * a * a / (l * r))``, the first of equal ones. A phrase goes when a longer candidate around it has
    ``percent`` of its count or more. Null texts are empty, a null language is ``und``; empty texts hold no words, an
    empty table no languages. Repeated rows count each."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    index = written(shards(texts, shard_words), "fm-shards", options=LARGE_ROWS)
    bits = key_bits(index.agg(F.sum("n_words")).first()[0] or 0)
    bitmaps: dict[int, np.ndarray] = {}
    for length in range(1, DEPTH + 1):
        bitmaps[length] = frequent_bitmap(index, length, least, bitmaps, bits)
    with shards_per_batch(docs.sparkSession):
        frequent = written(phrase_counts(index, bitmaps, bits).filter(F.col("n") >= least), "phrases")
    counts = {length: frequent.filter(F.col("length") == length).drop("length") for length in range(1, DEPTH + 1)}

    totals = index.groupBy("lang").agg(F.sum("n_words").alias("n"))
    scored = None
    for length in range(2, DEPTH + 1):
        found = counts[length]
        if length < DEPTH:
            # Counts only fall with length: of all longer candidates around a phrase one that has a single word more counts most.
            longer = counts[length + 1].select("lang", F.col("n").alias("around"), F.split("phrase", " ").alias("w"))
            inner = F.explode(F.array(*[F.array_join(F.slice("w", at, length), " ") for at in (1, 2)])).alias("phrase")
            longer = longer.select("lang", "around", inner).groupBy("lang", "phrase").agg(F.max("around").alias("around"))
            found = found.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("around") < percent * F.col("n"), F.lit(True)))
        found = found.select("lang", "phrase", F.col("n").alias("a"))
        scored = found if scored is None else scored.unionByName(found)

    w = F.split("phrase", " ")
    cut = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(w, F.lit(1), k), " ").alias("first"), F.array_join(F.slice(w, k + 1, F.size(w) - k), " ").alias("rest")))
    cuts = scored.select("lang", "phrase", "a", F.explode(cut).alias("cut")).select("lang", "phrase", "a", "cut.*")
    # A frequent word is part of many phrases: these are dealt over copies of the word's row.
    one = lambda c: F.instr(c, " ") == 0
    salt = lambda c: F.when(one(c), F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0).cast("int")
    parts = counts[1].select("lang", "phrase", "n", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    for length in range(2, DEPTH):
        parts = parts.unionByName(counts[length].select("lang", "phrase", "n", F.lit(0).alias("salt")))
    part = lambda c, name: parts.select("lang", F.col("phrase").alias(c), F.col("n").alias(name), F.col("salt").alias(f"{c}_salt"))
    cuts = cuts.withColumn("first_salt", salt("first")).join(part("first", "l"), ["lang", "first", "first_salt"])
    cuts = cuts.withColumn("rest_salt", salt("rest")).join(part("rest", "r"), ["lang", "rest", "rest_salt"])
    own = score(F.col("a"), F.col("l"), F.col("r")).alias("score")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(own, "k", "l", "r")).alias("cut"))
    rows = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= best)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= best)
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
