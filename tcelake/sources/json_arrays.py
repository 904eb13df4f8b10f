"""Whole-file JSON documents whose one large array is split over tasks.

A file is cut into blocks. Whether a block starts inside a string, how deep, and in which array, follows from all blocks before it, so each is
first summed up for both answers to the first question: brackets it closes without opening them, brackets it leaves open,
and whether it ends inside a string. These summaries (a few numbers a block) compose; folded in order per file they give every
block its start. Then each block emits the elements that begin in it, reading on past its end for the last one. No task
holds more than a block and an element, whatever the file's size.

One damaged element costs that element: it comes back as text with a reason. Only a file whose brackets or quotes do not
balance cannot be split; it gives one row with a reason and no records.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.sources.folder import file_listing, opened

BLOCK_BYTES = 8 << 20
_OPEN, _CLOSE = b"{[", b"}]"
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)
_SUMMARY = "struct<in_string: boolean, closes: long, opens: array<struct<pos: long, bracket: boolean>>>"


def _range(file, start: int, n: int) -> bytes:
    file.seek(start)
    return file.read(n)


def _escaped(file, start: int) -> bool:
    """Whether an odd number of backslashes stands before ``start``."""
    n, step = 0, 64
    while start > n:
        low = max(0, start - n - step)
        part = _range(file, low, start - n - low)
        run = len(part) - len(part.rstrip(b"\\"))
        n += run
        if run < len(part):
            break
    return n % 2 == 1


def _structure(data: bytes, escaped: bool):
    """(Places of brackets and commas, the parity of quotes before each, number of quotes) of a block."""
    import numpy as np
    a = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(a == 34)
    if len(quotes):
        plain = np.flatnonzero(a != 92)                       # a quote itself is one, so the one before it is at its rank - 1
        rank = np.searchsorted(plain, quotes)
        before = np.where(rank > 0, plain[np.maximum(rank - 1, 0)], -1)
        quotes = quotes[(quotes - 1 - before + (escaped & (before < 0))) % 2 == 0]
    places = np.flatnonzero((a == 123) | (a == 125) | (a == 91) | (a == 93) | (a == 44))
    return places, np.searchsorted(quotes, places) % 2, len(quotes), a


def _summary(places, parity, n_quotes: int, a, start: int, in_string: bool) -> dict:
    import numpy as np
    brackets = places[(parity == in_string) & (a[places] != 44)]
    opening = (a[brackets] == 123) | (a[brackets] == 91)
    depth = np.cumsum(np.where(opening, 1, -1))
    least = np.minimum.accumulate(depth[::-1])[::-1]
    left = brackets[opening & (least >= depth)]
    return {"in_string": bool((n_quotes + in_string) % 2), "closes": int(max(0, -depth.min())) if len(depth) else 0,
            "opens": [{"pos": start + int(p), "bracket": bool(a[p] == 91)} for p in left]}


def _key_before(file, pos: int) -> str | None:
    """The key whose value starts at ``pos``, however long; None where there is none."""
    n = 256
    while True:
        low = max(0, pos - n)
        text = _range(file, low, pos - low)
        if m := _KEY.search(text):
            # A quote that a backslash before this part escapes would be no quote: look at more unless the text starts here.
            if low == 0 or m.start() > 0 and text[m.start() - 1:m.start()] != b"\\":
                try:
                    return json.loads(b'"' + m[1] + b'"')
                except ValueError:
                    return None
        elif not re.search(rb':\s*$', text) and text.strip():
            return None
        if low == 0:
            return None
        n *= 4


def _elements(file, length: int, block: dict, field: str | None, block_bytes: int) -> Iterator[bytes]:
    """Texts of the array elements that begin in a block, given its start."""
    import numpy as np
    level = 1 if field is None else 2
    in_string, depth, inside = block["in_string"], block["depth"], block["inside"]
    at, end = block["start"], min(length, block["start"] + block_bytes)
    begin, first, parts = None, False, []                      # parts: text of the open element from earlier blocks
    while True:
        data = _range(file, at, min(block_bytes, length - at))
        own = at < end
        places, parity, n_quotes, a = _structure(data, _escaped(file, at))
        places = places[parity == in_string]
        kinds = a[places]
        step = np.where((kinds == 123) | (kinds == 91), 1, np.where(kinds == 44, 0, -1))
        after = depth + np.cumsum(step)
        marks = np.flatnonzero(((step == 1) & (after == level)) | ((step == 0) & (after == level)) | ((step == -1) & (after == level - 1)))
        low = 0 if begin is not None else None
        for i in marks.tolist():
            pos, kind = int(places[i]), int(step[i])
            if kind == 1:
                inside = own and data[pos:pos + 1] == b"[" and (field is None or _key_before(file, at + pos) == field)
                low, begin, first = (pos + 1, at + pos + 1, True) if inside else (None, None, False)
                continue
            if inside and begin is not None:
                text = b"".join([*parts, data[low:pos]])
                parts = []
                if text.strip() or not (first and kind == -1):
                    yield text
            if not own:
                return
            first = False
            if kind == 0 and inside:
                low, begin = pos + 1, at + pos + 1
            else:
                inside, low, begin = (inside if kind == 0 else False), None, None
        at += len(data)
        if begin is None or at >= length:
            return
        parts.append(data[low:])
        in_string, depth = bool((n_quotes + in_string) % 2), int(after[-1]) if len(after) else depth


class _Number(str):
    """A number as it is written."""


def _json(v) -> str:
    if isinstance(v, _Number):
        return str(v)
    if isinstance(v, dict):
        return "{" + ",".join(f"{_json(k)}:{_json(x)}" for k, x in v.items()) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(_json, v)) + "]"
    return json.dumps(v, ensure_ascii=False)


def _record(text: bytes) -> tuple[list | None, str | None]:
    """(Entries: strings as they are, null as null, other values as JSON text; reason)."""
    def damaged(_):
        raise ValueError
    try:
        value = json.loads(text.decode("utf-8"), parse_int=_Number, parse_float=_Number, parse_constant=damaged)
        if not isinstance(value, dict):
            return None, "not an object"
        return [(k, v if v is None or type(v) is str else _json(v)) for k, v in value.items()], None
    except (ValueError, RecursionError):
        return None, "malformed"


def json_array_records(spark: SparkSession, path: str, array_field: str | None, glob: str = "*.json", block_bytes: int = BLOCK_BYTES,
                       partitions: int | None = None, strict: bool = False) -> DataFrame:
    """``file, record MAP<STRING,STRING>, text, reason`` of every element of the array under the top-level key ``array_field`` (None: the
    document is the array) of all files of a folder.

    A good element has a record (of repeated keys the last counts, nested values as JSON text); a damaged one has its text and
    ``malformed`` or ``not an object``; a file that does not balance has one row ``unbalanced`` without text. A file without the key
    or with an empty array gives no rows, an empty file neither. Of an array that occurs under a repeated key all elements count.
    With ``strict`` any reason fails the job that reads the rows."""
    n = partitions or 4 * spark.sparkContext.defaultParallelism
    blocks = (file_listing(spark, path, glob).filter("length > 0")
              .select(F.col("xml_filename").alias("file"), "length",
                      F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))).alias("start")))
    spread = lambda df: df.repartition(n, "file", "start")  # noqa: E731  (a fixed number: few narrow rows stand for many bytes)

    def summed(batches: Iterator) -> Iterator:
        import pyarrow as pa
        system, base = opened(path)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                with system.open_input_file(f"{base}/{row['file']}") as file:
                    data = _range(file, row["start"], block_bytes)
                    found = _structure(data, _escaped(file, row["start"]))
                out.append(row | {f"s{h}": _summary(*found, row["start"], bool(h)) for h in (0, 1)})
            yield pa.RecordBatch.from_pylist(out, schema=summary_arrow)

    ddl = f"file string, length long, start long, s0 {_SUMMARY}, s1 {_SUMMARY}"
    starts = "file string, length long, start long, in_string boolean, depth long, inside boolean, reason string"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    summary_arrow, starts_arrow = to_arrow_schema(StructType.fromDDL(ddl)), to_arrow_schema(StructType.fromDDL(starts))

    def folded(table):
        """Starts of one file's blocks: as many narrow rows as it has blocks."""
        import pyarrow as pa
        system, base = opened(path)
        rows = table.sort_by("start").to_pylist()
        stack, in_string, out, level = [], False, [], 1 if array_field is None else 2
        known: dict[int, bool] = {}                # place of an array -> whether it is the wanted one
        with system.open_input_file(f"{base}/{rows[0]['file']}") as file:
            for row in rows:
                inside = False
                if len(stack) >= level and stack[level - 1]["bracket"]:
                    pos = stack[level - 1]["pos"]
                    if pos not in known:
                        known = {pos: array_field is None or _key_before(file, pos) == array_field}
                    inside = known[pos]
                out.append({k: row[k] for k in ("file", "length", "start")}
                           | {"in_string": in_string, "depth": len(stack), "inside": inside, "reason": None})
                s = row["s1" if in_string else "s0"]
                if s["closes"] > len(stack):
                    stack = None
                    break
                stack = stack[:len(stack) - s["closes"]] + s["opens"]
                in_string = s["in_string"]
        if stack is None or stack or in_string:
            out = [out[0] | {"reason": "unbalanced"}]
        return pa.Table.from_pylist(out, schema=starts_arrow)

    def emitted(batches: Iterator) -> Iterator:
        import pyarrow as pa
        schema = pa.schema([("file", pa.string()), ("record", pa.map_(pa.string(), pa.string())), ("text", pa.string()), ("reason", pa.string())])
        system, base = opened(path)
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                if row["reason"]:
                    out.append({"file": row["file"], "record": None, "text": None, "reason": row["reason"]})
                else:
                    with system.open_input_file(f"{base}/{row['file']}") as file:
                        for text in _elements(file, row["length"], row, array_field, block_bytes):
                            record, reason = _record(text)
                            out.append({"file": row["file"], "record": record, "text": text.decode("utf-8", "replace") if reason else None,
                                        "reason": reason})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    placed = spread(blocks).mapInArrow(summed, ddl).groupBy("file").applyInArrow(folded, starts)
    found = spread(placed).mapInArrow(emitted, "file string, record map<string,string>, text string, reason string")
    if strict:
        refused = F.raise_error(F.concat(F.col("file"), F.lit(": "), F.col("reason"))).cast("string")
        found = found.filter(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(refused.isNull()))
    return found
