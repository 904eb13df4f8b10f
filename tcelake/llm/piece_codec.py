"""SentencePiece encoding and decoding for merge-type vocabularies, checked against the library.

A merge-type model joins, again and again, the adjacent pair of symbols whose joined piece scores highest (the leftmost
of equals) until no pair is a piece; symbols outside the vocabulary become their UTF-8 bytes. A score-ordered agenda of
adjacent pairs does this in O(n log n) for any length. Texts are first cut where no piece of the vocabulary can span the
cut (before a blank mark that follows something else, before a line end), and each worker keeps what it has encoded.
New short chunks of an Arrow batch go through the agenda in lockstep: one numpy row per chunk, one merge per row and round, the
best pair of each row by score rank. Every new chunk is compared with the library's own ids; a difference raises.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from tcelake.llm.common import texts_of

BLANK = "▁"
LOCKSTEP = 48            # longest chunk, in symbols, for the lockstep agenda; longer ones use the heap
MAX_CHUNKS = 700_000     # chunks kept per worker and generation: bounds its memory, has no effect on results
_CODECS: dict[str, "PieceCodec"] = {}


class PieceCodec:
    """Encoder and decoder of one model file; ``library`` is the sentencepiece processor it is checked against."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.vocab_size()
        names = [lib.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {names[i]: i for i in plain}
        self.byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not lib.is_byte(i) for i in self.byte):
            raise ValueError("the model has no byte fallback")
        if any("\n" in names[i] or BLANK in names[i].lstrip(BLANK) for i in plain):
            raise ValueError("pieces span blanks or line ends: texts can't be cut there")
        if lib.encode("a  b") == lib.encode("a b") or lib.normalize("Åﬁ A") != f"{BLANK}Åﬁ{BLANK}A":
            raise ValueError("the model normalizes texts: only identity normalization is supported")
        # Symbols: piece ids, and numbers from `size` on for characters that occur only inside longer pieces.
        chars = sorted({c for n in self.ids for c in n} - self.ids.keys())
        self.symbol = {n: i for n, i in self.ids.items() if len(n) == 1} | {c: size + i for i, c in enumerate(chars)}
        self.other = size + len(chars)
        self.symbol_of = np.full(max(map(ord, self.symbol)) + 2, self.other, dtype=np.int64)      # by code point
        self.symbol_of[[ord(c) for c in self.symbol]] = list(self.symbol.values())
        self.spanned = {n[i:i + 2] for n in self.ids for i in range(len(n) - 1)}
        self.plain = np.zeros(self.other + 1, dtype=bool)
        self.plain[plain] = True
        self.text_of = {i: n for n, i in self.ids.items()} | {size + i: c for i, c in enumerate(chars)}
        score = {i: lib.get_score(i) for i in plain}
        place = {s: k for k, s in enumerate(sorted(set(score.values())))}
        base = self.other + 1
        pairs = {}
        for name, whole in self.ids.items():
            for cut in range(1, len(name)):
                a, b = name[:cut], name[cut:]
                a, b = (self.ids.get(x, self.symbol.get(x)) for x in (a, b))
                if a is not None and b is not None:
                    pairs[a * base + b] = whole
        self.base, self.pairs = base, pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.joined = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        self.rank = {i: place[s] for i, s in score.items()}
        self.rank_of = np.full(size, -1, dtype=np.int64)
        self.rank_of[list(self.rank)] = list(self.rank.values())
        self.old: dict[str, str] = {}
        self.seen: dict[str, str] = {}              # chunk -> its ids as decimal text
        self.cut = re.compile(f"\n[^{BLANK}\n]*|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+")

    def _final(self, symbols: list[int], chunk: str) -> list[int]:
        out, at = [], 0
        for s in symbols:
            text = self.text_of.get(s) or chunk[at]
            at += len(text)
            if s < self.base - 1 and text in self.ids:
                out.append(s)
            else:
                out.extend(self.byte[b] for b in text.encode("utf-8"))
        return out

    def agenda(self, chunk: str) -> list[int]:
        """Ids of one chunk by a heap of adjacent pairs: highest score first, then leftmost."""
        symbols = [self.symbol.get(c, self.other) for c in chunk]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            whole = self.pairs.get(symbols[i] * self.base + symbols[j])
            if whole is not None:
                heapq.heappush(heap, (-self.rank[whole], i, whole, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, whole, a, b = heapq.heappop(heap)
            j = after[i] if symbols[i] == a else n
            if j >= n or symbols[j] != b:
                continue                                 # one of the two has been merged since
            symbols[i], symbols[j], after[i] = whole, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return self._final([s for s in symbols if s >= 0], chunk)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joined piece and its score rank (-1: no piece) for pairs of symbols; -1 is padding."""
        key = np.where((left >= 0) & (right >= 0), left * self.base + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        whole = np.where(hit, self.joined[at], 0)
        return whole, np.where(hit, self.rank_of[whole], -1)

    def lockstep(self, chunks: list[str]) -> list[list[int]]:
        """Ids of many short chunks: each round merges the best pair of every row that still has one."""
        width = max(map(len, chunks))
        symbols = np.full((len(chunks), width + 1), -1, dtype=np.int64)
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        code = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        flat = self.symbol_of[np.minimum(code, len(self.symbol_of) - 1)]
        symbols[np.arange(width + 1)[None, :] < lengths[:, None]] = flat
        whole, rank = self._look(symbols[:, :-1], symbols[:, 1:])
        columns, live = np.arange(width + 1), np.arange(len(chunks))
        while len(live):
            at = rank[live].argmax(axis=1)               # the first of equals: leftmost
            keep = rank[live, at] >= 0
            live, at = live[keep], at[keep]
            if not len(live):
                break
            move = columns[None, :] + (columns[None, :] > at[:, None])
            own = np.take_along_axis(np.pad(symbols[live], ((0, 0), (0, 1)), constant_values=-1), move, 1)
            own[np.arange(len(live)), at] = whole[live, at]
            symbols[live] = own
            gaps = move[:, :-1]
            for table, empty in ((whole, 0), (rank, -1)):
                table[live] = np.take_along_axis(np.pad(table[live], ((0, 0), (0, 1)), constant_values=empty), gaps, 1)
            rows = np.arange(len(live))
            for side in (at - 1, at):
                ok = side >= 0
                r, c = rows[ok], side[ok]
                w, k = self._look(own[r, c], own[r, np.minimum(c + 1, width)])
                whole[live[r], c], rank[live[r], c] = w, k
        known = ((symbols < 0) | self.plain[symbols]).all(axis=1).tolist()
        counts, rows = (symbols >= 0).sum(axis=1).tolist(), symbols.tolist()
        return [row[:n] if ok else self._final(row[:n], chunk) for row, n, ok, chunk in zip(rows, counts, known, chunks)]

    def chunks(self, text: str) -> list[str]:
        """The text with blank marks, cut where no piece can span."""
        if not text:
            return []
        marked = BLANK + text.replace(" ", BLANK)
        if BLANK + BLANK in marked or "\n" + BLANK in marked or " " in marked:
            return self.cut.findall(marked)
        return marked.replace(BLANK, " " + BLANK).replace("\n", " \n").split(" ")[1:]

    def learn(self, wanted: set[str]) -> None:
        """Encodes chunks not met before and compares them with the library."""
        new = [c for c in wanted if c not in self.seen]
        if len(self.seen) + len(new) > MAX_CHUNKS:          # the young generation becomes the old one
            self.old, self.seen, new = self.seen, {}, list(wanted)
        if self.old:
            self.seen.update((c, self.old[c]) for c in new if c in self.old)
            new = [c for c in new if c not in self.old]
        # No piece holds the last two characters side by side: the last one is a chunk of its own.
        parted = {c: (c[:-1], c[-1]) for c in new if len(c) > 1 and c[-2:] not in self.spanned and c[-2] != BLANK}
        base = sorted({c for c in new if c not in parted}.union(*parted.values()), key=len)
        short = [c for c in base if len(c) <= LOCKSTEP]
        found: list[list[int]] = []
        for at in range(0, len(short), 20_000):          # rows of like width together
            found.extend(self.lockstep(short[at:at + 20_000]))
        found.extend(map(self.agenda, base[len(short):]))
        known = dict(zip(base, found))
        ids = [known[parted[c][0]] + known[parted[c][1]] if c in parted else known[c] for c in new]
        # The library puts a blank before every text; a chunk that begins with one is given without it.
        blank = self.ids[BLANK]
        own = self.library.encode([c[1:] if c[0] == BLANK else c for c in new], num_threads=1)
        for chunk, mine, theirs in zip(new, ids, own):
            if chunk[0] == BLANK and len(chunk) > 1:
                same = mine == theirs
            elif chunk[0] == "\n":
                same = [blank, *mine] == theirs
            else:
                same = True                              # a lone blank has no text to give to the library
            if not same:
                raise AssertionError(f"ids differ from the sentencepiece library's for {chunk!r}: {mine} {theirs}")
            self.seen[chunk] = ",".join(map(str, mine))

    def encode_batch(self, texts: list[str]) -> list[tuple[str, list[int]]]:
        """For each text its ids as decimal text and as a list."""
        cut = [self.chunks(t) for t in texts]
        self.learn(set().union(*cut))
        decimal = self.seen.__getitem__
        texts = [",".join(map(decimal, own)) for own in cut]
        return [(t, np.fromstring(t, dtype=np.int64, sep=",").tolist() if t else []) for t in texts]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode_decode(docs: DataFrame, model: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids, decoded`` with ``keep_ids``) of every whole text.

    A null or empty text has no ids and decodes to the empty text. Other columns of ``docs`` are ignored, repeated rows
    are encoded each."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        own = codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                encoded = own.encode_batch(part.column(1).to_pylist())
                decoded = [own.decode(ids) if ids else "" for _, ids in encoded]
                columns = [part.column(0), pa.array([len(ids) for _, ids in encoded], pa.int64()),
                           pa.array([hashlib.sha256(s.encode()).hexdigest() for s, _ in encoded], pa.string()),
                           pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded], pa.string())]
                if keep_ids:
                    columns += [pa.array([ids for _, ids in encoded], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    return texts_of(docs).mapInArrow(run, schema)
