"""Large JSON arrays split over tasks, against a whole-file parse."""

import json
import random

import pytest

from tcelake.sources import json_arrays as J


def shown(v):
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def split(path, field, size):
    """Elements by blocks of ``size`` bytes, without Spark: summaries folded as the source does."""
    with open(path, "rb") as f:
        length, out, stack, in_string, level = len(f.read()), [], [], False, 1 if field is None else 2
        for start in range(0, length, size):
            inside = (len(stack) >= level and stack[level - 1]["bracket"]
                      and (field is None or J._key_before(f, stack[level - 1]["pos"]) == field))
            block = {"start": start, "in_string": in_string, "depth": len(stack), "inside": inside}
            out += list(J._elements(f, length, block, field, size))
            found = J._structure(J._range(f, start, size), J._escaped(f, start))
            s = J._summary(*found, start, in_string)
            stack, in_string = stack[:len(stack) - s["closes"]] + s["opens"], s["in_string"]
        return out, not stack and not in_string


def some(rng, deep=0):
    kind = rng.randrange(8 if deep < 3 else 5)
    if kind < 2:
        return "".join(rng.choice('ab"\\{}[],: é\n') for _ in range(rng.randrange(9)))
    if kind < 5:
        return [None, True, rng.randrange(-99, 99)][kind - 2]
    if kind == 5:
        return [some(rng, deep + 1) for _ in range(rng.randrange(4))]
    return {"".join(rng.choice('k"\\[{') for _ in range(3)): some(rng, deep + 1) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 20])
def test_blocks_of_any_size_give_the_elements_of_a_whole_parse(tmp_path, size):
    rng, path = random.Random(size), tmp_path / "d.json"
    for _ in range(60):
        rows = [some(rng) for _ in range(rng.randrange(6))]
        doc = {"before": some(rng), "other": [1, {"rows": [2]}], "rows": rows, "after": some(rng)}
        for field, whole in (("rows", doc), (None, rows)):
            text = json.dumps(whole, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
            path.write_text(text, encoding="utf-8")
            got, balanced = split(path, field, size)
            assert [json.loads(t) for t in got] == rows and balanced, text


def test_long_keys_and_runs_of_backslashes(tmp_path):
    path = tmp_path / "d.json"
    key, rows = "k\\\\\"" * 2000, ["\\" * n for n in range(70)]
    path.write_text(json.dumps({key: rows, "x" + key: [0]}))
    for size in (1, 5, 100, 10 ** 6):
        assert [json.loads(t) for t in split(path, key, size)[0]] == rows


def test_folder_with_damaged_elements_and_files(spark, tmp_path):
    rng = random.Random(5)
    good = {f"{i}.json": [{"a": some(rng), "n": i, "x": 1.50} for i in range(rng.randrange(40))] for i in range(6)}
    for name, rows in good.items():
        (tmp_path / name).write_text(json.dumps({"note": "]", "rows": rows}))
    (tmp_path / "damaged.json").write_text('{"rows": [{"a": 1.0}, {"a": tru}, {"a" 2}, 7, {"a": [1, 2]}, , {"a": NaN}, {"b": null}]}')
    (tmp_path / "cut.json").write_text('{"rows": [{"a": 1}, {"a": 2')
    (tmp_path / "closed.json").write_text('{"rows": [{"a": 1}]}}')
    (tmp_path / "quote.json").write_text('{"rows": [{"a": 1}]} "')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text('{"rows": [], "other": [{"a": 1}]}')
    (tmp_path / "scalar.json").write_text('{"rows": {"rows": [{"a": 1}]}}')
    got = J.json_array_records(spark, str(tmp_path), "rows", block_bytes=16, partitions=4).collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.file, []).append(r)
    key = lambda r: repr(sorted(r.items()))
    for name, rows in good.items():
        expected = [{k: shown(v) for k, v in r.items()} for r in rows]
        assert sorted((r.record for r in by_file.get(name, [])), key=key) == sorted(expected, key=key)
    damaged = sorted((r.text.strip(), r.reason) for r in by_file["damaged.json"] if r.reason)
    assert damaged == [("", "malformed"), ("7", "not an object"), ('{"a" 2}', "malformed"), ('{"a": NaN}', "malformed"), ('{"a": tru}', "malformed")]
    assert sorted(map(repr, (r.record for r in by_file["damaged.json"] if not r.reason))) == sorted(
        map(repr, ({"a": "1.0"}, {"a": "[1,2]"}, {"b": None})))
    for name in ("cut.json", "closed.json", "quote.json"):
        assert [(r.record, r.text, r.reason) for r in by_file[name]] == [(None, None, "unbalanced")]
    assert not {"empty.json", "none.json", "scalar.json"} & set(by_file)


def test_folder_without_files(spark, tmp_path):
    assert J.json_array_records(spark, str(tmp_path), "rows").count() == 0


def test_strict_reading_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1.50, "b": {"c": [1e3, null, "é"]}}]')
    rows = J.json_array_records(spark, str(tmp_path), None, partitions=2, strict=True).collect()
    assert [r.record for r in rows] == [{"a": "1.50", "b": '{"c":[1e3,null,"é"]}'}]
    (tmp_path / "b.json").write_text('[{"a": 1}, {]')
    with pytest.raises(Exception, match="b.json"):
        J.json_array_records(spark, str(tmp_path), None, partitions=2, strict=True).count()
