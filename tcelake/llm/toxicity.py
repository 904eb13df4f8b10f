"""Toxicity by a weighted finite-state pattern grammar.

Words become classes by small transducers: insults (learned: words and word beginnings), threats, targets, negations,
reported speech. A learned insult has a level, the least share of a text's words that must be it: a slur in itself has
level 0, a word beginning that clean texts hold here and there counts only where it stands often, and is a faint match
elsewhere. Composed over a clause the transducers tell in which context an insult or threat stands; every context is an
arc with a weight, the share of toxic texts among labelled texts with a match in it; threats, whose words are fixed and
not learned, and faint matches weigh by what that share is above the prior, the share among texts without any match.
Matched clauses are scored, not single words anywhere: a text's score is 1 - (1 - prior) times the product of
(1 - weight) over its distinct contexts, however often each occurs, as weights are fitted per text.

Fitting uses at most ``sample_rows`` labelled texts (those with the smallest hash of doc_id, a documented bound), whose
crc32(doc_id) mod 3 is not 1; scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tcelake.llm.common import texts_of, written

WORD = re.compile(r"[^\W\d_]+")
#: Words of a clause: inner apostrophes belong to them.
SPOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
BREAKS = ".!?;\n"
BREAK = re.compile(f"[{BREAKS}]")
#: Words of the fixed transducers.
THREATS = "kill hurt destroy beat attack burn shoot stab".split()
TARGETS = "you your he she they him her them du dich euch tu te toi vous tú usted".split()
NEGATIONS = "not never no nobody isn't aren't kein keine nicht pas jamais nunca ningún".split()
REPORTS = "said says wrote claimed called quoted according reported sagte schrieb dit dijo escribió".split()
#: Levels: the least occurrences in a thousand words of a text. Beyond level 0 there must be two at least.
LEVELS = (0, 5, 10, 20)


class Grammar(NamedTuple):
    insults: tuple[str, ...]          # whole words
    beginnings: tuple[str, ...]       # word beginnings
    arcs: dict[str, float]            # context -> weight
    prior: float
    levels: dict[str, int] = {}       # word or beginning -> index into LEVELS, 0 where absent

    def pattern(self) -> re.Pattern:
        words = [re.escape(w) for w in (*self.insults, *THREATS)] + [re.escape(b) + r"[^\W\d_]*" for b in self.beginnings]
        return re.compile(r"(?<![^\W\d_])(?:" + "|".join(sorted(words, reverse=True)) + r")(?![^\W\d_])")

    def source(self, word: str) -> str:
        """The insult that a matched word stands for: itself or its learned beginning (no beginning begins another)."""
        return word if word in self.insults else next((b for b in self.beginnings if word.startswith(b)), word)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def clauses(low: str, pattern: re.Pattern) -> Iterator[tuple[list[str], list[int]]]:
    """The words of every clause that holds a match, and the matches' places among them. A clause reaches from break to break,
    however long it is; every part of the text is looked at a fixed number of times."""
    done = 0
    while m := pattern.search(low, done):
        start = max(low.rfind(b, done, m.start()) for b in BREAKS)
        start = done if start < 0 else start + 1
        stop = BREAK.search(low, m.end())
        stop = stop.start() if stop else len(low)
        words, places = [], []
        for m in pattern.finditer(low, m.start(), stop):
            words += SPOKEN.findall(low, start, m.start())
            places.append(len(words))
            words.append(m[0])
            start = m.end()
        yield words + SPOKEN.findall(low, start, stop), places
        done = stop


def level(times: int, n_words: int) -> int:
    """The highest level that so many occurrences among so many words reach."""
    return max(i for i, per_mille in enumerate(LEVELS) if not i or times > 1 and 1000 * times >= per_mille * n_words)


def contexts(text: str, grammar: Grammar, pattern: re.Pattern) -> list[str]:
    """The context of every match: the state that the composed transducers are in at its place of its clause. Threats count
    only with a target in their clause; insults below their level are ``faint`` in whatever clause."""
    low = text.lower().replace("\u2019", "'")
    found, faint = [], set()
    if any(grammar.levels.values()):
        times = Counter(grammar.source(m[0]) for m in pattern.finditer(low))
        if any(grammar.levels.get(w) for w in times):
            n_words = sum(1 for _ in WORD.finditer(low))
            faint = {w for w, n in times.items() if level(n, n_words) < grammar.levels.get(w, 0)}
    for words, places in clauses(low, pattern):
        first_report = next((i for i, w in enumerate(words) if _any_part(w, REPORTS)), len(words))
        for at in places:
            if faint and grammar.source(words[at]) in faint:
                found.append("faint")
                continue
            before, after = words[max(0, at - 3):at], words[at + 1:at + 4]
            negated = any(_any_part(w, NEGATIONS) for w in before)
            targeted = any(_any_part(w, TARGETS) for w in before + after)
            kind = "threat" if words[at] in THREATS else "insult"
            if kind == "threat" and not targeted:
                continue
            found.append(kind + "_reported" * (first_report < at) + "_negated" * negated + "_targeted" * targeted)
    return found


def _any_part(word: str, own: list[str]) -> bool:
    """Whether a word or a part of it beside an apostrophe (you're, qu'il) is one of these."""
    return word in own or "'" in word and any(p in own for p in word.split("'"))


def features(text: str, longest: int) -> dict[str, tuple[int, int]]:
    """The words (``=word``) and word beginnings of a text that may become insults, each with the level that it reaches and a
    hash of the words beside its first place."""
    words = WORD.findall(text.lower())
    times, beside = Counter(), {}
    for i, w in enumerate(words):
        if len(w) > 2:
            for f in (f"={w}", *(w[:n] for n in range(3, min(len(w), longest + 1)))):
                times[f] += 1
                if f not in beside:
                    beside[f] = crc32(" ".join(words[max(0, i - 1):i] + [""] + words[i + 1:i + 2]).encode())
    return {f: (level(n, len(words)), beside[f]) for f, n in times.items()}


def nested(feature: str, taken: dict[str, int]) -> bool:
    """Whether a word or beginning begins one that is taken, or one that is taken begins it."""
    own = feature.lstrip("=")
    for f in taken:
        other = f.lstrip("=")
        if own == other or f[0] != "=" and own.startswith(other) or feature[0] != "=" and other.startswith(own):
            return True
    return False


def choose(texts: list[dict[str, tuple[int, int]]], candidates: set[tuple[str, int]], support: int) -> dict[str, int]:
    """Insults with their levels, from the candidate features of the toxic texts.

    First greedily: the candidate that explains most texts not explained yet, as long as these are ``support``. Then every
    other candidate that stands among different words in at least half of its texts (in copies of one text it stands among
    the same words), those of most texts first. Of words and beginnings that begin one another only the first one stays."""
    holds: dict[tuple[str, int], set[int]] = defaultdict(set)
    beside: dict[tuple[str, int], set[int]] = defaultdict(set)
    for i, own in enumerate(texts):
        for f, (reached, near) in own.items():
            for at in range(reached + 1):
                if (f, at) in candidates:
                    holds[f, at].add(i)
                    beside[f, at].add(near)
    # Equal support: whole words first, then the higher level, then the longer beginning.
    rank = lambda c: (len(holds[c]), c[0][0] == "=", c[1], len(c[0]), c[0])
    taken: dict[str, int] = {}
    left = {c: set(own) for c, own in holds.items()}
    while left:
        best = max(left, key=lambda c: (len(left[c]), *rank(c)[1:]))
        if len(left[best]) < support:
            break
        explained = holds[best]
        taken[best[0]] = best[1]
        left = {c: own - explained for c, own in left.items() if not nested(c[0], {best[0]: 0})}
    for c in sorted(holds, key=rank, reverse=True):
        if 2 * len(beside[c]) >= len(holds[c]) and len(beside[c]) >= support and not nested(c[0], taken):
            taken[c[0]] = c[1]
    return taken


def beyond_chance(tried: int, share: float, chance: float = 0.01) -> int:
    """How many texts must all be toxic, where this share of texts is, so that none of ``tried`` features is expected to stand
    in toxic texts alone by mere chance (with a probability of ``chance`` at most)."""
    return math.ceil(math.log(chance / max(tried, 1)) / math.log(share)) if 0 < share < 1 else 0


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, support: int = 6, precision: float = 0.95,
        longest: int = 8) -> Grammar:
    """Learns insults and arc weights from labelled texts that are not held out.

    Candidates are words and word beginnings (of 3 to ``longest`` letters) that reach a level in at least ``support`` sampled
    toxic texts (more where chance gives that many, :func:`beyond_chance`), of whose texts at that level at least ``precision``
    are toxic; :func:`choose` picks from them. Null labels and
    doc_ids are left out. With no labelled rows the grammar has no insults and weight 0."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows))
    # At most sample_rows rows of two numbers are broadcast; the texts stay where they are.
    sample = written(texts_of(docs).join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic")).distinct(),
                     "labelled")

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            every, bad = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [(f, at) for f, (reached, _) in features(text, longest).items() for at in range(reached + 1)]
                every.update(own)
                if toxic:
                    bad.update(own)
            # What no toxic text of this batch has still counts against a feature: nothing is left out.
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in every], pa.string()), pa.array([at for _, at in every], pa.int32()),
                                              pa.array(every.values(), pa.int64()), pa.array([bad[f] for f in every], pa.int64())],
                                             names=["feature", "level", "n", "bad"])

    counted = written(sample.mapInArrow(count, "feature string, level int, n long, bad long").groupBy("feature", "level")
                      .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).filter(F.col("n") >= support), "features")
    n, bad = sample.agg(F.count("*"), F.sum("toxic")).first()
    support = max(support, beyond_chance(counted.count(), (bad or 0) / max(n, 1)))
    # Bounded by the sample: a toxic sampled text backs at most a few features with such support and precision.
    candidates = {(r[0], r[1]) for r in counted.filter((F.col("bad") >= support) & (F.col("bad") >= precision * F.col("n")))
                  .select("feature", "level").collect()}
    wanted = {f for f, _ in candidates}

    def backed(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            own = [sorted((f, *v) for f, v in features(t, longest).items() if f in wanted) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([[f[i] for f in fs] for fs in own], pa.list_(kind)) for i, kind in
                                              enumerate((pa.string(), pa.int32(), pa.int64()))], names=["features", "reached", "beside"])

    toxic = [{f: (at, near) for f, at, near in zip(*r)} for r in sample.filter("toxic = 1")
             .mapInArrow(backed, "features array<string>, reached array<int>, beside array<long>").collect() if r[0]]
    taken = choose(toxic, candidates, support)
    insults = tuple(sorted(f[1:] for f in taken if f[0] == "="))
    beginnings = tuple(sorted(f for f in taken if f[0] != "="))
    levels = {f.lstrip("="): at for f, at in taken.items() if at}
    bare = Grammar(insults, beginnings, {}, 0.0, levels)

    def arcs(batches: Iterator) -> Iterator:
        import pyarrow as pa
        pattern = bare.pattern()
        for batch in batches:
            every, bad = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = set(contexts(text, bare, pattern)) or {""}
                every.update(own)
                if toxic:
                    bad.update(own)
            yield pa.RecordBatch.from_arrays([pa.array(every.keys(), pa.string()), pa.array(every.values(), pa.int64()),
                                              pa.array([bad[f] for f in every], pa.int64())], names=["feature", "n", "bad"])

    seen = {r[0]: (r[1], r[2]) for r in sample.mapInArrow(arcs, "feature string, n long, bad long")
            .groupBy("feature").agg(F.sum("n"), F.sum("bad")).collect()}
    n, bad = seen.pop("", (0, 0))
    n_insult, bad_insult = (sum(v[i] for k, v in seen.items() if k.startswith("insult")) for i in (0, 1))
    usual = (bad_insult + 0.5) / (n_insult + 1) if n_insult else 0.0
    prior = bad / n if n else 0.0

    def weight(context: str, m: int, b: int) -> float:
        """Few texts: near the usual weight of insults, near none of threats and faint matches."""
        if context.startswith("insult"):
            return min(0.99, (b + 4 * usual) / (m + 4))
        share = min(0.99, (b + 4 * prior) / (m + 4))
        return 1 - (1 - share) / (1 - prior) if share > prior else 0.0

    return Grammar(insults, beginnings, {k: weight(k, *v) for k, v in seen.items()} | {"": min(0.99, usual)}, prior, levels)


def text_score(text: str, grammar: Grammar, pattern: re.Pattern) -> float:
    rest = 1.0 - min(grammar.prior, 0.3)
    for context in sorted(set(contexts(text, grammar, pattern))):      # sorted: the same float on every executor
        usual = grammar.arcs.get("", 0.0) if context.startswith("insult") else 0.0
        rest *= 1.0 - grammar.arcs.get(context, usual)
    return 1.0 - rest


def score(docs: DataFrame, grammar: Grammar, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` (0 to 1) more; null and empty texts get the prior. Repeated rows give a row each."""
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name}")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        pattern = grammar.pattern()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            scores = [text_score(t or "", grammar, pattern) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
