"""The pipeline's stages against what they must do, on the smallest tables."""

import corpus_pipeline as P
from tcelake.llm import pii, superminhash
from tcelake.llm.common import read_table, written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = first = read_table(spark, SF, "documents")
    by_stage = {}
    for name, stage in P.STAGES:
        docs = by_stage[name] = written(stage(spark, docs, SF), f"test-{name}")
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "repeats", "personal_data", "packing"]
    for name in list(by_stage)[:-1]:
        assert by_stage[name].columns == first.columns
    clean = by_stage["toxicity"]
    kept = {r["doc_id"] for r in superminhash.near_duplicates(clean, 5, 80).filter("kept").collect()}
    assert {r["doc_id"] for r in by_stage["near_duplicates"].collect()} == kept
    seen = set()
    for r in by_stage["repeats"].orderBy("doc_id").collect():
        assert r["n_chars"] == len(r["text"])
        parts = r["text"].encode()
        seen.add(parts)
    for r in by_stage["personal_data"].collect():
        assert not [s for s in pii.find_spans(r["text"]) if s[0] == "email"]
    assert {r["doc_id"] for r in by_stage["packing"].collect()} == kept


def test_repeats_stage_by_brute_force(spark):
    """The texts that the stage leaves, by plain Python over every window of 100 bytes."""
    docs = read_table(spark, SF, "documents").limit(200)
    docs = written(docs.dropDuplicates(["doc_id"]), "test-input")
    seen, expected, n_cut = set(), {}, 0
    for doc_id, text in sorted((r["doc_id"], r["text"] or "") for r in docs.collect()):
        b = text.encode()
        end, cover = 0, bytearray(len(b))
        for i in range(len(b) - 99):
            window = b[i:i + 100]
            if window in seen:
                cover[max(i, end):i + 100] = b"\1" * (i + 100 - max(i, end))
                end = i + 100
            seen.add(window)
        n_cut += any(cover)
        expected[doc_id] = bytes(c for c, m in zip(b, cover) if not m).decode("utf-8", "ignore")
    got = {r["doc_id"]: r["text"] or "" for r in dict(P.STAGES)["repeats"](spark, docs, SF).collect()}
    assert n_cut > 5 and got.keys() == expected.keys()
    assert [i for i in got if got[i] != expected[i]] == []


def test_stages_on_odd_tables(spark, odd, none):
    for docs in (odd, none):
        for _, stage in P.STAGES:
            docs = written(stage(spark, docs, SF), "test-odd")
        assert docs.columns[:2] == ["doc_id", "piece"]
