import pytest

LONG = "under the MIT license " * 3000
ODD = [(5, "the quick brown fox is in a box " * 12), (3, "the quick brown fox is in a box " * 12), (None, "no id here at all"),
       (7, None), (8, ""), (9, "mail a.b@x.org or 10.0.0.1 +1 (212) 555-0153, card 4539 5787 6362 1486"), (10, LONG), (11, LONG),
       (12, "Licensed under the Apache License, Version 2.0. é ü 日本 \U0001F600"), (12, "Licensed under the Apache License, Version 2.0. é ü 日本 \U0001F600"),
       (20, "   \t\n "), (21, "%%% ***"), (22, "one"), (23, "<|endoftext|> and <s> J̌"), (24, "x" * 20000)]
CLASH = ["score", "row", "block", "id", "part", "key", "length", "offset", "component", "kept", "bands", "texts", "next_text", "rest"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns named like the operators' own."""
    rows = [(i, t, "en", None, None if t is None else len(t), *[n] * len(CLASH)) for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in CLASH))


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")
