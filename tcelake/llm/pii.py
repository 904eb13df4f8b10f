"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tcelake.llm.common import texts_of

#: Kinds in the order of spans with equal start; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
N_BASE = 4
SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"
#: Patterns. Possessive repeats and the look-behind keep them linear on long runs; they match the same.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
DIGIT = re.compile(r"[0-9]")
#: Words that make a kind likelier when they stand close before a span.
CONTEXT = {"email": ("mail", "contact", "write"), "ip": ("ip", "server", "host", "address"),
           "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax"),
           "iban": ("iban", "bank", "account", "konto"), "ssn": ("ssn", "social security", "tax id")}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.85, "phone": 0.7, "iban": 0.8, "ssn": 0.3}
NEAR = 40                # code points before a span that are looked at
LEAST = 0.5              # score that spans of added kinds need


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod_97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping. The part before an @ is the run of its characters that ends there, so each @ is looked
    at once instead of trying every start."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans ``(kind, start, end, score)`` of a text, by start, then kind; code points, end exclusive."""
    found = [("email", *span) for span in emails(text)]
    if DIGIT.search(text):
        small = lambda p: len(p := p.lstrip("0")) <= 3 and int(p or 0) <= 255
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() <= 37 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= sum(map(m[0].count, "0123456789")) <= 15]
        found += [("iban", *m.span()) for m in IBAN.finditer(text) if mod_97(m[0].replace(" ", ""))]
        if "-" in text:
            found += [("ssn", *m.span()) for m in SSN.finditer(text)]
    spans = []
    for kind, start, end in found:
        before = text[max(0, start - NEAR):start].lower()
        score = min(1.0, PRIOR[kind] + 0.3 * any(w in before for w in CONTEXT[kind]))
        if kind in KINDS[:N_BASE] or score >= LEAST:
            spans.append((kind, start, end, score))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the union goes."""
    out, at = [], 0
    for kind, start, end, _ in find_spans(text):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every whole text. Null and empty texts have no spans; repeated rows give a row each; other
    columns of ``docs`` are ignored."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return texts_of(docs).mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind; all columns stay, null texts stay null."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else redacted(t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
