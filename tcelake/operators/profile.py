"""Element-path profiler over a corpus of XML documents.

Every task keeps the paths of a batch of documents as a prefix tree: a node per path with the number of documents and of elements
that reached it, so walking a document follows pointers and never spells a path. What leaves Python is one row per path and batch;
counts of equal paths are added up by a partially aggregated Spark group-by.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tcelake.schema import document_paths
from tcelake.sources.xml_docs import parse_tree


class PathTree:
    """Prefix tree of element paths with document and element counts; node 0 stands above the roots."""

    def __init__(self):
        self.children: list[dict[str, int]] = [{}]
        self.names, self.above = [""], [0]
        self.n_docs, self.n_nodes, self.last = [0], [0], [-1]

    def child(self, node: int, name: str) -> int:
        found = self.children[node].get(name)
        if found is None:
            found = self.children[node][name] = len(self.names)
            self.children.append({})
            self.names.append(name)
            self.above.append(node)
            self.n_docs.append(0)
            self.n_nodes.append(0)
            self.last.append(-1)
        return found

    def add(self, root, document: int) -> None:
        """Counts a tree's elements in document order; ``left`` children of the node above are still to come."""
        reached, stack = [], []
        node, left, known = 0, 1, self.children[0]
        for element in root.iter():
            tag = element.tag
            place = known.get(tag)
            if place is None:
                place = self.child(node, tag)
            reached.append(place)
            left -= 1
            below = len(element)
            if below:
                stack.append((node, left, known))
                node, left, known = place, below, self.children[place]
            else:
                while not left and stack:
                    node, left, known = stack.pop()
        for node in reached:
            self.n_nodes[node] += 1
        for node in set(reached):
            if self.last[node] != document:
                self.last[node] = document
                self.n_docs[node] += 1

    def paths(self) -> list[str]:
        out = [""]
        for name, above in zip(self.names[1:], self.above[1:]):      # a node follows the one above it
            out.append(f"{out[above]}/{name}" if above else name)
        return out


def _batch_paths(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for batch in batches:
        tree = PathTree()
        for document, content in enumerate(batch.column(0)):
            root, _ = parse_tree(content.as_py()) if content.is_valid else (None, "malformed")
            if root is not None:                                    # malformed documents are reported by the quarantine
                tree.add(root, document)
        yield pa.RecordBatch.from_arrays([pa.array(tree.paths()[1:], pa.string()), pa.array(tree.n_docs[1:], pa.int64()),
                                          pa.array(tree.n_nodes[1:], pa.int64())], names=["path", "n_docs", "n_nodes"])


def profile_paths(raw: DataFrame, content: str, known_paths: list[str] | None = None) -> DataFrame:
    """(path, n_docs, n_nodes, in_schema) over the corpus, one row per document in ``raw``; ``in_schema`` is false for paths that
    are not documented. Documents that are null or not well-formed have no paths."""
    known = known_paths if known_paths is not None else document_paths()
    batches = raw.select(F.col(content)).mapInArrow(_batch_paths, "path string, n_docs long, n_nodes long")
    agg = batches.groupBy("path").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_nodes").alias("n_nodes"))
    return agg.withColumn("in_schema", F.col("path").isin(known))


def path_listing(profile: DataFrame, root: str = "tce") -> DataFrame:
    """Display form of the path list: sorted, root prefix removed, root itself and blanks dropped."""
    p = F.trim(F.regexp_replace(F.col("path"), f"^{root}/", ""))
    return profile.select(p.alias("path")).filter((F.col("path") != root) & (F.col("path") != "")).orderBy("path")
