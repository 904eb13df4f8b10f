"""Operators on odd tables against brute force: nulls, empty and long texts, ties, repeated rows, clashing columns, no rows."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tcelake.llm import crosspolytope, licenses, packing, pii, piece_codec, repeats, spotsigs, superminhash, toxicity, wavelet

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def texts(odd):
    return [(r["doc_id"], r["text"] or "") for r in odd.collect()]


def ids_of(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(odd, none):
    got = packing.pack(packing.token_pieces(odd, WORDS, 64), 64)
    expected = []
    for doc_id, text in texts(odd):
        ids = [*ids_of(text), 0]
        expected += [(doc_id, n, a, len(ids[a:a + 64]), crc(ids[a:a + 64])) for n, a in enumerate(range(0, len(ids), 64))]
    assert rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(expected, key=repr)
    held = {}
    for r in got.collect():
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(packing.token_pieces(none, WORDS, 64), 64).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_length_once(seed):
    rng = np.random.default_rng(seed)
    histogram = dict(Counter(rng.integers(1, 101, 3000).tolist()))
    plan, sequences = packing.plan_packing(histogram, 100)
    used, placed = Counter(), Counter()
    for length, first, each, sequence, offset in plan.tolist():
        later = [r[1] for r in plan.tolist() if r[0] == length and r[1] > first]
        n = (min(later) if later else histogram[length]) - first
        placed[length] += n
        for r in range(n):
            used[sequence + r // each] += length
            assert offset + r % each * length + length <= 100
    assert placed == histogram and max(used.values()) <= 100
    assert sequences <= 1.05 * (-(-sum(k * v for k, v in histogram.items()) // 100)) + 1


def test_repeats(odd, none):
    def brute(docs):
        seen, out = set(), []
        for doc_id, text in sorted(docs, key=lambda d: -1 if d[0] is None else d[0]):
            b, end, cover, own = text.encode(), 0, bytearray(len(text.encode())), []
            for i in range(len(b) - 99):
                w = b[i:i + 100]
                if w in seen:
                    cover[max(i, end):i + 100] = b"\1" * (i + 100 - max(i, end))
                    end = i + 100
                seen.add(w)
            kept = bytes(c for c, m in zip(b, cover) if not m)
            out.append((doc_id, len(b), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
        return sorted(out, key=repr)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(repeats.removal(repeats.removed_runs(odd)), *columns) == brute(texts(odd))
    assert repeats.removed_runs(none).count() == 0
    cut = repeats.without_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert rows(cut, "doc_id", "rest") == rows(odd, "doc_id", "rest")


def test_maximal_repeats_lists_all_occurrences():
    text = b"xabcy1abcz2abcy"
    suffixes = np.zeros((len(text), 16), np.uint8)
    for i in range(len(text)):
        suffixes[i, :len(text) - i] = np.frombuffer(text[i:], np.uint8)
    before = np.array([-1, *text[:-1]])
    found = {(n, tuple(sorted(at.tolist()))) for n, at in repeats.maximal_repeats(suffixes, len(text) - np.arange(len(text)), before, 3)}
    assert found == {(3, (1, 7, 11)), (4, (1, 11))} or found == {(3, (1, 6, 11)), (4, (1, 11))}


def test_licenses(odd, none):
    for r in licenses.scan(odd).collect():
        assert r["doc_id"] is None or 0 <= r["score"] <= 1
    got = {r["doc_id"]: r for r in licenses.scan(odd).collect()}
    assert (got[10]["n_base"], got[10]["first_word"], got[10]["last_word"], got[10]["base_labels"]) == (3000, 0, 4 * 2999, "mit")
    assert (got[12]["n_base"], got[12]["first_word"], got[12]["labels"]) == (1, 3, "apache-2")
    assert (got[8]["n_words"], got[8]["n_base"], got[8]["first_word"], got[8]["labels"]) == (0, 0, None, "")
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(none).count() == 0
    assert "ArrowEval" not in licenses.scan(odd)._jdf.queryExecution().toString()


def test_license_bodies_with_edits(spark):
    """Copies of whole bodies are found with changed words, a phrase put in and a sentence left out; halves and other prose
    that shares phrases are not; the score is the share of k-grams that a brute-force count finds."""
    rng = np.random.default_rng(11)
    docs, expected = [], {}
    for n, (label, text) in enumerate(licenses.BODIES.items()):
        words = licenses.plain_words(text)
        changed = list(words)
        for at in rng.choice(len(words), len(words) // 20, replace=False):
            changed[at] = "other"
        put_in = words[:len(words) // 2] + ["name"] * max(1, len(words) // 25) + words[len(words) // 2:]
        cut = words[:len(words) // 3] + words[len(words) // 3 + len(words) // 25:]
        for kind, own in enumerate((words, changed, put_in, cut, words[:len(words) // 2])):
            docs.append((10 * n + kind, "before it " + " ".join(own) + " after it"))
            if kind < 4:
                expected[10 * n + kind] = label
    docs.append((1000, "in no event shall the garden be liable for any rain and this list of conditions for any purpose with or without sun"))
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"), templates=list(licenses.BODIES.items())).collect()}
    for i, text in docs:
        assert got[i]["labels"].split(",") == [expected[i]] if i in expected else got[i]["labels"] == "" == got[i]["base_labels"] or i % 10 == 4, (i, got[i])
    for n, (label, text) in enumerate(licenses.BODIES.items()):
        words = licenses.plain_words(text)
        assert got[10 * n]["score"] == 1.0 and got[10 * n + 4]["labels"] in ("", "apache-2") and 0.7 <= got[10 * n + 1]["score"]
        if got[10 * n + 1]["base_labels"] == "":
            own = licenses.plain_words(docs[5 * n + 1][1])[2:]
            same = sum(own[t:t + 3] == words[t:t + 3] for t in range(len(words) - 2))
            assert same <= round(got[10 * n + 1]["score"] * (len(words) - 2)) <= same + 3
    assert licenses.template_grams(spark).count() < licenses.BROADCAST_ROWS


def test_license_base_places_by_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10_000, "under the mit license, Apache License (version 2): CC-BY-NC cc by nc under the MIT license"), (10_001, "under the mit licenses")]
    expected = []
    for doc_id, text in docs:
        words = re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places = []
        for label, phrase in licenses.BASE.items():
            own = phrase.split()
            places += [(i, label) for i in range(len(words)) if words[i:i + len(own)] == own]
        at = [i for i, _ in places]
        expected.append((doc_id, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in places}))))
    got = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sum(e[2] > 0 for e in expected) > 2
    assert rows(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(expected, key=repr)


@pytest.mark.parametrize("text,kinds", [
    ("a@b.c.d@e.f x@y@z.com", ["email", "email"]), ("1.2.3.4.5 999.1.1.1", ["ip"]), ("4539578763621486", ["card"]), ("4539578763621487", []),
    ("+1 (212) 555-0153", ["phone"]), ("+123", []), ("IBAN GB82 WEST 1234 5698 7654 32", ["iban"]), ("GB82 WEST 1234 5698 7654 33", []),
    ("ssn 123-45-6789", ["ssn"]), ("part 123-45-6789", []), ("9" * 5000 + "." + "9" * 5000 + ".1.1", [])])
def test_personal_data(text, kinds):
    assert [s[0] for s in pii.find_spans(text)] == kinds


def test_personal_data_table(odd, none):
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.detect(odd).collect()}
    assert sorted(got[9]) == ["card", "email", "ip", "phone"] and got[7] == [] and got[8] == []
    masked = pii.redact(odd)
    assert masked.columns == odd.columns and pii.redact(none).count() == 0
    text = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert "[EMAIL]" in text[9] and "@" not in text[9] and text[7] is None


def test_spot_signatures(odd, none, spark):
    got = spotsigs.fingerprint_edits(odd).collect()
    order = sorted(texts(odd), key=lambda d: (-1 if d[0] is None else d[0]))
    assert len(got) == len(order) and spotsigs.fingerprint_edits(none).count() == 0
    by_id = {r["doc_id"]: r for r in got}
    edits = [(a, x[:len(x) - len(x) // 4] + y[:len(x) // 4]) for (a, x), (_, y) in zip(order, order[1:] + order[:1])]
    assert sorted(((r["doc_id"], r["edited"]) for r in got), key=repr) == sorted(edits, key=repr)
    assert by_id[5]["own"] == by_id[3]["own"] and by_id[8]["own"] == []
    base = "the house of stone is on a hill and the river runs to the sea with a boat in it " * 3
    docs = spark.createDataFrame([(1, base), (2, base), (3, base + "for sure now"), (4, "nothing like it was said by anyone at the gate")], "doc_id long, text string")
    own = {r["doc_id"]: set(r["own"]) for r in spotsigs.fingerprint_edits(docs).collect()}
    alike = len(own[1] & own[3]) / len(own[1] | own[3])
    assert alike > 0.4 and [(r["a"], r["b"], r["similarity"]) for r in spotsigs.near_pairs(docs, 0.4).collect()] == [(1, 3, alike)]


def test_spot_signature_pairs_by_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10_000 * share + i, t[:len(t) * share // 100]) for i, t in docs[:80] if t for share in (55, 75, 85, 95)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    classes = {}
    for r in docs.select("doc_id", spotsigs.signatures(F.col("text")).alias("own")).collect():
        if r["own"]:
            classes[tuple(r["own"])] = min(r["doc_id"], classes.get(tuple(r["own"]), r["doc_id"]))
    sets = sorted((i, set(own)) for own, i in classes.items())
    alike = {(a, b): len(x & y) / len(x | y) for n, (a, x) in enumerate(sets) for b, y in sets[n + 1:]}
    for least in (0.5, 0.8):
        expected = {p: s for p, s in alike.items() if s >= least}
        found = [tuple(r) for r in spotsigs.near_pairs(docs, least).collect()]
        assert len(expected) > 100 and len(found) == len(expected) and {(a, b): s for a, b, s in found} == expected


def test_near_duplicates(odd, none, spark):
    got = {r["doc_id"]: r for r in superminhash.near_duplicates(odd, 2, 80).collect()}
    assert (got[5]["component_id"], got[5]["kept"], got[3]["kept"]) == (3, False, True)
    assert got[11]["component_id"] == 10 and got[7]["n_shingles"] == 0 and got[8]["component_id"] == 8 and got[22]["n_shingles"] == 1
    assert superminhash.near_duplicates(odd, 2, 80).count() == odd.count() and superminhash.near_duplicates(none, 2, 80).count() == 0
    rng = np.random.default_rng(1)
    bases = [[f"w{n}" for n in rng.integers(0, 500, 60)] for _ in range(20)]
    docs = []
    for base in bases:
        for _ in range(12):
            words = list(base)
            for at in rng.integers(0, 60, rng.integers(0, 6)):
                words[at] = "changed"
            docs.append((len(docs), " ".join(words)))
    sets = {i: frozenset(zip(t.split(), t.split()[1:])) for i, t in docs}
    parent = {i: i for i in sets}
    root = lambda x: x if parent[x] == x else root(parent[x])
    for i in sets:
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    found = superminhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2, 80)
    assert rows(found, "doc_id", "component_id") == sorted(((i, root(i)) for i in sets), key=repr)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2 ** 63, 900).astype(np.uint64)
    a, b = np.unique(x[:600]), np.unique(x[300:])
    signature = superminhash.superminhash([a, b, a], 400)
    assert (signature[0] == signature[2]).all() and abs((signature[0] == signature[1]).mean() - 1 / 3) < 0.08
    assert sorted(np.floor(superminhash.superminhash([a[:1]], 50))[0].tolist()) == list(range(50))     # one element: a permutation


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 64))
    x = [(c + rng.normal(size=64) * 0.28).astype(np.float32).tolist() for c in centres for _ in range(8)]
    x += [x[0], [0.0] * 64, [float("nan")] * 64, [None] + x[1][1:], None, [], [v * 2 for v in x[2]], [1.0, 2.0]]
    data = [(i, v, 0, 1) for i, v in enumerate(x)] + [(None, x[3], 0, 1)]
    got = {r["vec_id"]: r for r in crosspolytope.near_duplicates(
        spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, id int")).collect()}
    ok = [i for i, v in enumerate(x) if v and len(v) == 64 and None not in v and np.isfinite(v).all() and any(v)]
    u = np.array([x[i] for i in ok], dtype=np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in ok])
    assert found.sum() >= 0.98 * links.sum() and (found <= links + 1e-9).all() and links.sum() > 50
    for i in set(range(len(x))) - set(ok):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[240]["component_id"] == got[0]["component_id"]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert crosspolytope.near_duplicates(empty).count() == 0


def test_toxicity(spark, odd, none):
    rng = np.random.default_rng(4)
    words = [f"word{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(200)]
    docs, labels = [], []
    for i in range(600):
        own = rng.choice(words, 30).tolist()
        if i % 6 == 0:
            own.insert(int(rng.integers(0, 30)), ["blork", "zagrim"][i % 4 // 2])
        docs.append((i, " ".join(own)))
        labels.append((i, int(i % 6 == 0)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    grammar = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.withColumn("held", toxicity.held_out(docs.doc_id)), grammar).filter("held").collect()
    assert scored and all((r["score"] >= 0.7) == (r["doc_id"] % 6 == 0) for r in scored)
    assert toxicity.score(odd, grammar, "toxicity").count() == odd.count() and toxicity.score(none, grammar, "toxicity").count() == 0
    bare = toxicity.fit(none, labels)
    assert bare.insults == () and toxicity.score(docs, bare).filter("score >= 0.7").count() == 0


def test_toxicity_of_long_clean_texts(spark):
    """Clean texts stay clean however often they match; contexts seldom or never sampled are near the prior."""
    def fitted(toxic):
        docs = [(i, f"plain text {i}" + [" blork", ". they burn wood", "", "", "", ""][i % 6]) for i in range(600)]
        return toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame([(i, int(toxic(i))) for i, _ in docs], "doc_id long, toxic int"))

    threats = "he beat him at chess. they attack the hill. you shoot a film! she said they burn wood; you never hurt them. "
    for every in (0, 5):             # no threat in a toxic text, or as many as texts without a match
        grammar = fitted(lambda i: i % 6 == 0 or every and i // 6 % every == 0)
        score = lambda text: toxicity.text_score(text, grammar, grammar.pattern())
        assert grammar.insults == ("blork",) and (grammar.prior > 0.1) == (every > 0)
        assert score("he beat him and they attack") < 0.3 and score(threats) == score(threats * 100) < 0.3
        assert score("he blork") == score("he blork. " * 100) >= 0.7
    grammar = fitted(lambda i: i % 6 == 0 or i % 6 == 1 and i // 6 % 5)      # most threats in toxic texts: they weigh
    assert "blork" in grammar.insults and 0.7 < toxicity.text_score("you burn", grammar, grammar.pattern()) < 0.9
    light = toxicity.Grammar(("blork",), (), {"insult": 0.1, "": 0.1}, 0.0)
    assert toxicity.text_score("blork. " * 500, light, light.pattern()) == pytest.approx(0.1)


def test_toxicity_of_word_beginnings(spark):
    """A beginning that toxic texts hold often and clean ones once is learned with a level; below it matches are faint. Words
    beside an insult, and the words of many copies of one toxic text, are not taken."""
    rng = np.random.default_rng(8)
    words = [f"{a}{b}or" for a in "bcdfghklmnprst" for b in "aeiou"]
    ends = ["ent", "is", "orum", "ala", "esk", "ib"]
    docs, labels = [], []
    for i in range(900):
        own = rng.choice(words, 100).tolist()
        for at in rng.integers(0, 100, 4 if i % 6 == 0 else int(i % 6 == 1)):
            own[at] = "zuvrel" + rng.choice(ends)
        if i % 6 == 2 and i % 4 == 0:
            own[int(rng.integers(0, 100))] = "blork"
        docs.append((i, " ".join(own)))
        labels.append((i, int("blork" in own or i % 6 == 0)))
    copied = " ".join(f"copied{chr(97 + n)} neighbour" for n in range(20)) + " blork"
    docs += [(i, f"{copied} {words[i % 60]}") for i in range(900, 1000)]
    labels += [(i, 1) for i in range(900, 1000)]
    grammar = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert grammar.insults == ("blork",) and grammar.beginnings == ("zuvrel",) and grammar.levels["zuvrel"] > 0
    score = lambda text: toxicity.text_score(text, grammar, grammar.pattern())
    clean = " ".join(words * 10)
    assert score(f"{clean} zuvrelent") < 0.5 and score(f"{clean} zuvrelent {clean} zuvrelis") < 0.5
    assert score(" ".join(words) + " zuvrelent zuvrelis zuvrelib") >= 0.7 and score(f"{clean} blork") >= 0.7
    assert score(f"{clean} zuvrelent") == score(f"{clean} zuvrelent {clean} {clean} zuvrelis") >= score(clean)


def test_toxicity_levels():
    assert [toxicity.level(n, 200) for n in (1, 2, 4)] == [0, 2, 3] and toxicity.level(1, 1) == 0 == toxicity.level(2, 1000)
    assert toxicity.beyond_chance(10 ** 6, 0.12) == 9 and toxicity.beyond_chance(5, 0.0) == 0 == toxicity.beyond_chance(0, 1.0)
    assert toxicity.nested("abcd", {"abc": 0}) and toxicity.nested("abc", {"=abcd": 0}) and not toxicity.nested("=abc", {"=abcd": 0})


def test_toxicity_contexts():
    grammar = toxicity.Grammar(("idiot",), (), {}, 0.0)
    contexts = lambda text: toxicity.contexts(text, grammar, grammar.pattern())
    assert contexts("You are an idiot. He is not an idiot; she said idiot") == [
        "insult_targeted", "insult_negated", "insult_reported_targeted"]
    assert contexts("they burn wood") == ["threat_targeted"] and contexts("burn wood") == []


def test_toxicity_contexts_see_whole_clauses():
    grammar = toxicity.Grammar(("idiot",), (), {}, 0.0)
    contexts = lambda text: toxicity.contexts(text, grammar, grammar.pattern())
    far = "word " * 1000
    assert contexts(f"she said {far} idiot, idiot {far}. an idiot") == ["insult_reported"] * 2 + ["insult"]
    assert contexts(f"idiot {far} said") == ["insult"] == contexts(f"said! idiot {far}")
    assert contexts("you aren't really an idiot") == ["insult_negated"]
    assert contexts("he isn\u2019t an idiot") == ["insult_negated_targeted"]
    assert contexts("you're an idiot's friend") == ["insult_targeted"]
    assert contexts("not" + " a" * 150 + " idiot " + "b" * 300 + " you") == ["insult_targeted"]
    began = time.perf_counter()
    assert len(contexts("idiot you " * 100_000)) == 100_000 and time.perf_counter() - began < 10


def test_sentencepiece(odd, none):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = [(i, len(ids := lib.encode(t)), sha(",".join(map(str, ids))), sha(lib.decode(ids))) for i, t in texts(odd)]
    got = piece_codec.encode_decode(odd, PIECES)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert piece_codec.encode_decode(none, PIECES).count() == 0


def test_sentencepiece_agendas_agree():
    own = piece_codec.codec(PIECES)
    chunks = ["▁hello", "▁aaaaaaaaaaaaaaa", "\nfoo", "▁▁▁", "▁日本語x", "▁été", "ź"]
    assert own.lockstep(chunks) == [own.agenda(c) for c in chunks]


def test_wavelet_matrix():
    x = np.random.default_rng(5).integers(0, 300, 3000).astype(np.uint16)
    w = wavelet.WaveletMatrix.build(x, 9)
    assert (w.decode() == x).all() and [w.access(i) for i in (0, 511, 512, 2999)] == x[[0, 511, 512, 2999]].tolist()
    for v in (0, 7, 299, 300, 511):
        at = np.flatnonzero(x == v)
        assert w.count(v) == len(at) and w.places(v).tolist() == at.tolist() and w.rank(v, 1500) == (at < 1500).sum()
        assert [w.select(v, k) for k in range(-1, len(at) + 1)] == [-1, *at.tolist(), -1]
    for n in (1, 511, 512, 513, 1024):
        for x in (np.zeros(n, np.uint16), np.full(n, 3, np.uint16), np.arange(n, dtype=np.uint16) % 4):
            w = wavelet.WaveletMatrix.build(x, 2)
            assert all(w.select(int(v), int((x[:i] == v).sum())) == i for i, v in enumerate(x))
    assert wavelet.WaveletMatrix.build(np.empty(0, np.uint16), 1).select(0, 0) == -1


def test_wavelet_lookups(odd, none, spark):
    """Counting, occurrence lookup and access from written shards equal the plain ids."""
    from tcelake.llm.common import shared_path
    plain = [(i, ids_of(t) + [2]) for i, t in texts(odd)]
    folder = shared_path(spark, "lookups")
    wavelet.write_shards(odd, folder, WORDS, 2, shard_tokens=500)
    shards = spark.read.schema(wavelet.SHARD).parquet(folder)
    seen = Counter(t for _, ids in plain for t in ids)
    asked = [2, *[t for t, _ in seen.most_common(3)], min(seen, key=seen.get), max(seen) + 1, -1, 1 << 40]
    assert rows(wavelet.token_counts(shards, asked), "token", "n") == sorted(((t, seen.get(t, 0)) for t in set(asked)), key=repr)
    for t in set(asked):
        expected = sorted(((i, p) for i, ids in plain for p, own in enumerate(ids) if own == t), key=repr)
        assert rows(wavelet.occurrences(shards, t, batch_rows=100), "doc_id", "place") == expected
    wanted = {i: [0, 3, 10 ** 6, -1] for i in (5, 8, 10, 12)}
    expected = sorted(((i, p, ids[p]) for i, ids in plain for p in wanted.get(i, ()) if 0 <= p < len(ids)), key=repr)
    assert rows(wavelet.tokens_at(shards, wanted), "doc_id", "place", "token") == expected
    assert wavelet.tokens_at(shards, {}).count() == 0
    wavelet.write_shards(none, f"{folder}-none", WORDS)
    empty = spark.read.schema(wavelet.SHARD).parquet(f"{folder}-none")
    assert rows(wavelet.token_counts(empty, [2]), "token", "n") == [(2, 0)] and wavelet.occurrences(empty, 2).count() == 0


def test_wavelet_shards(odd, none):
    expected, start = [], 0
    for doc_id, text in sorted(texts(odd), key=lambda d: -1 if d[0] is None else d[0]):
        ids = [*ids_of(text), 2]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = wavelet.round_trip(odd, WORDS, 2, shard_tokens=500)
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)
    assert wavelet.round_trip(none, WORDS).count() == 0
