"""Write PLANS.md: the physical plan trees (explain formatted, tree part + scan details) of the key plan shapes."""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tcelake.session import get_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    lines = text.splitlines()
    keep = [ln for ln in lines if re.match(r"^\s*([+:|]|\w.*\(\d+\)$)", ln) and "(" in ln
            and not ln.startswith("Arguments")] or lines
    details = [ln.strip() for ln in lines if ln.strip().startswith(("PushedFilters", "PartitionFilters", "ReadSchema"))]
    return "\n".join(keep[:60]) + "\n\n" + "\n".join(sorted(set(details)))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session()
    from tcelake.plans.registry import QUERIES, models
    m = models(spark, sf)
    sections = [
        ("fact_joined (input of the tce_id rank)", "one exchange of the case side on xml_filename; each child is "
         "partially aggregated and exchanged once on the same key; the SMJ chain does not reshuffle the case side; "
         "dim_time is broadcast behind its exact row count", m.fact_joined()),
        ("dashboard (after the fact and dimension ranks)", "reads the checkpointed fact with the carried regimen "
         "attributes; popularity is a partially aggregated count + left-semi join; dim_time broadcast by count",
         m.dashboard()),
        ("class_counts", "type filter before grouping by file alone, so the join to the case table reuses that "
         "partitioning; unused signature aggregate pruned", QUERIES["class_counts"](spark, sf)),
        ("partitioned_roundtrip", "partition folder pruning", QUERIES["partitioned_roundtrip"](spark, sf)),
    ]
    out = ["# Key physical plans (sf0.1, local[8], AQE initial plans)", ""]
    for title, note, df in sections:
        out += [f"## {title}", "", note + ".", "", "```", tree(df), "```", ""]
    open("PLANS.md", "w").write("\n".join(out))


if __name__ == "__main__":
    main()
