"""Decontamination, collocations and the filter audit against plain Python; embeddings at two sizes."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from tcelake.llm import bloom, crosspolytope, filter_audit, fmindex, winnowing

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i:i + n])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc_id, len(w), len(hit), sorted(i for i in found if i is not None)))
    return sorted(out, key=repr)


def contaminated(spark, docs, items):
    found = winnowing.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                    spark.createDataFrame(items, "item_id long, text string"))
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_contamination_by_brute_force(spark, seed):
    rng = random.Random(seed)
    text = lambda n, k: " ".join(rng.choice("abcdefgh"[:k]) + rng.choice(["", "1", "é", "-", "X."]) for _ in range(n))
    items = [(i, text(rng.choice([12, 30, 60]), 6)) for i in range(12)] + [(20, "A b"), (21, "h"), (21, "g1 g1 g1"), (None, text(15, 5)), (22, ""), (23, None), (24, "...")]
    docs = [(i, text(rng.randrange(0, 200), 8)) for i in range(60)]
    for i in range(60, 90):                                       # passages of items inside, cut at random places
        w = items[i % 12][1].split()
        a = rng.randrange(len(w))
        docs.append((i, f"{text(20, 8)} {' '.join(w[a:a + rng.randrange(5, 40)])} {text(10, 8)}"))
    docs += [docs[70], (None, docs[71][1]), (95, None), (96, ""), (97, "??"), (98, "a b " * 3000)]
    assert contaminated(spark, docs, items) == contamination(docs, items)


def test_contamination_of_odd_tables(spark, odd, none):
    items = [(1, "the quick brown fox is in a box the quick brown"), (2, "under the MIT license " * 4), (3, "one")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in winnowing.contamination(odd, frame).collect()), key=repr)
    assert got == contamination([(r["doc_id"], r["text"]) for r in odd.collect()], items)
    assert winnowing.contamination(none, frame).count() == 0
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in winnowing.contamination(odd, frame.filter("false")).collect())


def test_winnowing_selects_in_every_window():
    rng = np.random.default_rng(5)
    for n in (3, 6, 7, 50, 400):
        h = rng.integers(0, 30, n).astype(np.uint64)
        kept = winnowing.minima(h, 6)
        for i in range(n - 5):
            assert kept[i:i + 6][h[i:i + 6] == h[i:i + 6].min()].all()
        assert n >= 6 or not kept.any()


def test_bitmap_never_loses_a_hash(spark):
    h = np.random.default_rng(1).integers(0, 2 ** 64, 5000, dtype=np.uint64)
    rows = spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "h long").repartition(4)
    bits = bloom.bitmap_of(rows, lambda batch: batch.column(0).to_numpy().view(np.uint64))
    assert bloom.may_hold(bits, h).all()
    assert bloom.may_hold(bits, np.random.default_rng(2).integers(0, 2 ** 64, 5000, dtype=np.uint64)).mean() < 0.01


def collocations(docs, least, best):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * b >= 50 * a for q, b in found.items()):
                continue
            score, _, l, r = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def test_collocations_by_brute_force(spark):
    rng = random.Random(3)
    docs = []
    for i in range(150):
        w = [rng.choice("aBcdefgé日") + rng.choice(["", "", "x"]) for _ in range(rng.randrange(0, 120))]
        docs.append((rng.choice(["en", "en", "de", None, "und"]), "".join(x + rng.choice([" ", " ", "\t", "  ", ". ", "\n", ",", "\r"]) for x in w)))
    docs += [("en", None), ("en", ""), ("fr", "..."), ("xx", "once only"), ("long", "a b c d " * 500)] + docs[:5]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "lang string, text string, n long, phrase long").repartition(3)
    want = collocations(docs, 10, 40)
    for size in (1 << 20, 97):                                   # whole shards; shards that cut pieces with overlaps
        got = fmindex.collocations(df, 10, 50, 40, shard_words=size)
        assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == want
    assert fmindex.collocations(df.filter("false")).count() == 0 and len(want) > 60


def test_collocations_added_up_in_many_parts(spark, monkeypatch):
    """Tasks that send their sums often, in many ranges of hashes, several languages in a task."""
    rng = random.Random(5)
    docs = [(rng.choice(["en", "de", "é"]), " ".join(rng.choice("abcdéfg") for _ in range(rng.randrange(60)))) for _ in range(120)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(2)
    for name, value in (("HELD_KEYS", 40), ("HELD_TEXTS", 40), ("RANGE_WORDS", 5)):
        monkeypatch.setattr(fmindex, name, value)
    got = fmindex.collocations(df, 10, 50, 60, shard_words=200)
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == collocations(docs, 10, 60)


def test_packed_sums_of_keys():
    rng = np.random.default_rng(6)
    keys, n = rng.integers(0, 1 << 38, 3000, dtype=np.uint64), rng.integers(1, 4, 3000)
    keys[1000:2000] = keys[:1000]
    want = Counter()
    for k, v in zip(keys.tolist(), n.tolist()):
        want[k] += v
    rows = fmindex.packed(*fmindex.added(keys, n.astype(np.uint8), 5), 38, 5).to_pylist()
    got = {r["range"] << 32 | int(k): int(v) for r in rows for k, v in zip(np.frombuffer(r["low"], "<u4"), np.frombuffer(r["n"], np.uint8))}
    assert got == {k: min(v, 5) for k, v in want.items()}
    none = fmindex.packed(*fmindex.added(keys[:0], n[:0], 5), 38, 5)
    assert none.num_rows == 0


def test_collocation_scores_past_64_bits(spark):
    """Counts whose products need more than 64 bits: the score's arithmetic on its own."""
    from pyspark.sql import functions as F
    a, l, r = 9_000_000_000, 10_000_000_000, 12_345_678_901
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert row.select(fmindex.score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (l * r)


def test_index_extends_in_both_directions():
    rng = np.random.default_rng(8)
    run = np.concatenate(([0], rng.integers(0, 6, 400), [0])).astype(np.uint32)
    shard = fmindex.Shard(fmindex.transform(run), fmindex.transform(run[::-1]))
    for grow in (("right", "left"), ("left", "right"), ("right", "right"), ("left", "left")):
        phrases = shard.words()
        for step in grow:
            phrases = getattr(shard, step)(phrases)
        want = Counter(tuple(run[i:i + 3]) for i in range(len(run) - 2) if 0 not in run[i:i + 3])
        assert {tuple(p): int(n) for p, n in zip(phrases[0].tolist(), phrases[3])} == {tuple(int(x) for x in p): n for p, n in want.items()}


def audit(docs, labels):
    known = defaultdict(lambda: [0, 0])
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            known[doc_id][0] |= quality == 1
            known[doc_id][1] |= toxic == 1
    lowest = {}
    for doc_id, _, text in docs:
        if doc_id is not None:
            lowest[text or ""] = min(lowest.get(text or "", doc_id), doc_id)
    parts = defaultdict(list)
    for doc_id, lang, text in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and lowest[text] < doc_id}
        parts[lang or ""].append(({f for f in fails if fails[f]}, *(known[doc_id] if doc_id is not None else (0, 0))))
    out = []
    for part, rows in parts.items():
        removed = Counter()
        found = []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                here = [r for r in rows if f in r[0] and not r[0] & set(order[:k])]
                removed[f] += len(here)
                found.append((part, "".join(order), k + 1, sum(not r[0] & set(order[:k + 1]) for r in rows), len(here), sum(f in r[0] for r in rows) - len(here),
                              sum(r[0] == {f} for r in rows), sum(r[1] for r in here), sum(r[2] for r in here), f))
        out += [(*r[:-1], removed[r[-1]]) for r in found]
    return sorted(out)


def test_filter_audit_by_brute_force(spark, odd, none):
    rng = random.Random(9)
    text = lambda: " ".join(rng.choice(["aa", "Bb", "CC", "d#", "e", "é"]) + str(rng.randrange(rng.choice([5, 400]))) for _ in range(rng.choice([20, 99, 100, 150])))
    docs = [(i, rng.choice(["en", "de", None]), text()) for i in range(120)]
    docs += [(i, rng.choice(["en", "de"]), docs[i % 20][2]) for i in range(200, 300)] + [docs[3], docs[110], (None, "en", docs[5][2]), (None, "en", docs[5][2]), (301, "", ""),
                                                                                     (302, "en", None), (303, "en", "AB" * 400)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 300, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    columns = "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    run = lambda df: sorted(tuple(r) for r in filter_audit.audit(df, labels_df).select(*columns).collect())
    assert run(spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(4)) == audit(docs, labels)
    assert run(odd) == audit([(r["doc_id"], r["lang"], r["text"]) for r in odd.collect()], labels)
    assert run(none) == []


@pytest.mark.parametrize("n", [600, 4000])
def test_embedding_links_at_two_sizes(spark, n):
    """Single vectors, tight and wide groups and exact copies, doubles of any scale: recall against all pairs, nothing below the bound."""
    rng = np.random.default_rng(n)

    def around(centre, k, cosine):
        g = rng.normal(size=(k, 64))
        centre = centre / np.linalg.norm(centre)
        g -= (g @ centre)[:, None] * centre
        return cosine * centre + np.sqrt(1 - cosine ** 2) * g / np.linalg.norm(g, axis=1, keepdims=True)

    base = rng.normal(size=(n, 64))
    x = np.concatenate([base, around(base[0], n // 10, 0.985), around(base[1], n // 20, 0.952), around(base[2], 30, 0.97),
                        *[around(base[i], 1, c) for i in range(3, 60) for c in (0.91, 0.93, 0.96)], base[5:9], base[5:9]])
    x *= rng.choice([1e-60, 1.0, 1e150], len(x))[:, None]
    u = x / np.abs(x).max(axis=1, keepdims=True)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    links = linked.sum(axis=1) - 1
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {r["vec_id"]: r for r in crosspolytope.near_duplicates(rows).collect()}
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum() and links.sum() > n
    label = np.arange(len(x))
    while (new := np.where(linked, label[None, :], len(x)).min(axis=1)).tolist() != label.tolist():
        label = new
    component = np.array([got[i]["component_id"] for i in range(len(x))])
    assert (component >= label).all() and (component == label).mean() > 0.98
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
