"""Registered queries over sf0.001 against plain Python that shares no code with the operators."""

import hashlib
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tcelake.llm import queries, spotsigs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def texts():
    return sorted(zip(*(pq.read_table(f"{SF}/documents.parquet").column(c).to_pylist() for c in ("doc_id", "text"))))


def passes(kind, found):
    digits = [int(c) for c in found if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        odd, even = digits[-1::-2], digits[-2::-2]
        return 14 <= len(digits) <= 19 and (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def test_personal_data_equals_the_plain_patterns(spark):
    got = {r.doc_id: r for r in queries.op5_personal_data(spark, SF).collect()}
    n_found = 0
    for doc_id, text in texts():
        spans = [(m.start(), n, m.end()) for n, k in enumerate(KINDS) for m in re.finditer(PATTERNS[k], text or "") if passes(k, m[0])]
        joined = ",".join(f"{KINDS[n]}:{a}:{b}" for a, n, b in sorted(spans))
        r = got.pop(doc_id)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(n == i for _, n, _ in spans) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        n_found += len(spans)
    assert not got and n_found > 0


def signs(text):
    """Anchor and next content words; the whole word sequence where there is no anchor."""
    if text == "":
        return frozenset()
    words = [w for w in re.split(r"[\W_]+", text.lower())]
    common = set(spotsigs.ANCHORS)
    own = set()
    for i, w in enumerate(words):
        if w in common:
            own.add((w, *[x for x in words[i + 1:i + 1 + spotsigs.REACH] if x and x not in common][:spotsigs.CHAIN]))
    return frozenset(own) if own else frozenset([("whole", *filter(None, words))])


def likeness(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_fingerprints_of_edited_and_next_texts(spark):
    docs = [(i, t or "") for i, t in texts()]
    got = {r.doc_id: r for r in queries.op6_spot_signatures(spark, SF).collect()}
    assert len(got) == len(docs)
    by_fingerprint = {}
    for (doc_id, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        cut = len(text) // 4
        edited, r = text[:len(text) - cut] + after[:cut], got[doc_id]
        own = signs(text)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(own, signs(edited)), abs=1e-12)
        assert r.near_next == pytest.approx(likeness(own, signs(after)), abs=1e-12)
        by_fingerprint.setdefault(r.fingerprint, set()).add(own)
    assert all(len(s) == 1 for s in by_fingerprint.values())          # equal fingerprints, equal sets


@pytest.mark.parametrize("rows_per_bucket", [7, 50, 10_000])
def test_next_document_over_bucket_borders(spark, rows_per_bucket):
    ids = [i * i % 997 * 10 + i // 997 for i in range(600)]
    ids = sorted(set(ids))
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").repartition(5)
    got = dict(spotsigs.with_next(docs, rows_per_bucket).select("doc_id", "next_text").collect())
    assert got == {i: f"text {j}" for i, j in zip(ids, ids[1:] + ids[:1])}


def test_next_document_with_equal_and_missing_ids(spark):
    rows = [(None, "none")] + [(i // 3, f"t{i}") for i in range(90)] + [(5, "t15")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for rows_per_bucket in (4, 1000):
        got = spotsigs.with_next(docs, rows_per_bucket)
        assert got.count() == len(rows)
        follows = {(r.doc_id, r.text): r.next_text for r in got.collect()}
        assert follows[(None, "none")] in {"t0", "t1", "t2"} and got.filter(F.col("next_text") == "none").first().doc_id == 29
