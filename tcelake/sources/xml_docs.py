"""XML case-file scan: one file = one row = one document, read by a strict namespace-aware parser.

* files: ``binaryFile`` over ``<dir>/<glob>`` (the glob is expanded non-recursively, like a directory listing of one
  folder); the parser gets the bytes, so byte-order marks and declared charsets are its business;
* parsing: one Arrow step per table wanted. Documents are parsed one by one and each tree is written straight into nested Arrow
  columns of the documented shape, of the elements that are asked for only, and dropped (trees that are kept cost the interpreter's cycle
  collector more than parsing does): names are compared as expanded names (case
  and namespace count), elements of ``DEEP_ELEMENTS`` are taken at any depth in document order, and a leaf is the text of its first
  occurrence up to its first child element;
* what the parser rejects goes whole to the quarantine frame with the reason, so a bad file never adds rows to any table and
  no bytes can fail the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.schema import DOCUMENT_SHAPE, document_ddl

# Elements found at any depth; all others are children of the root.
DEEP_ELEMENTS = ("baselineRNA", "pastRNA", "followupRNA", "baselineCD4", "pastCD4", "followupCD4",
                 "baselineIsolate", "pastIsolate", "baselineNewTreatment", "pastRegimenTreatments")
DEEP_CHILDREN = ("aaMutation",)                       # found at any depth below their parent
_SLICE = 500                                          # documents that become one output batch


def parse_tree(content: bytes | str):
    """``(root, None)`` of a well-formed document, else ``(None, reason)``; never raises for any content."""
    import xml.etree.ElementTree as ET
    from xml.parsers.expat import errors
    try:
        return ET.fromstring(content), None
    except ET.ParseError as e:
        return None, "trailing content" if e.code == errors.codes[errors.XML_ERROR_JUNK_AFTER_DOC_ELEMENT] else "malformed"
    except Exception:  # noqa: BLE001  unknown charset, lone surrogates, nesting too deep: this file is bad, the others are read
        return None, "malformed"


class _Nodes:
    """Nested Arrow columns of one repeated element: per document (or parent element) a list of structs."""

    def __init__(self, spec: dict):
        self.offsets = [0]
        self.leaves: dict[str, list] = {leaf: [] for leaf in spec.get("leaves", ())}
        self.children = {name: _Nodes(below) for name, below in spec.get("children", {}).items()}
        self.add_leaf = [(leaf, values.append) for leaf, values in self.leaves.items()]
        self.add_children = [(name, name in DEEP_CHILDREN, below) for name, below in self.children.items()]

    def add(self, nodes: list) -> None:
        self.offsets.append(self.offsets[-1] + len(nodes))
        for n in nodes:
            for leaf, add in self.add_leaf:
                add(n.findtext(leaf))
            for name, deep, below in self.add_children:
                below.add([m for m in n.iter(name) if m is not n] if deep else n.findall(name))

    def array(self):
        import pyarrow as pa
        names = [*self.leaves, *self.children]
        columns = [pa.array(v, pa.string()) for v in self.leaves.values()] + [c.array() for c in self.children.values()]
        return pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), pa.StructArray.from_arrays(columns, names))


def document_array(roots: Iterable, shape: dict):
    """Struct array of the documented elements of parsed documents; null where there is no document. The roots may be an iterator
    that makes them one by one: none is kept."""
    import pyarrow as pa
    leaves = {name: [] for name, spec in shape.items() if spec is None}
    nested = {name: _Nodes(spec) for name, spec in shape.items() if spec is not None}
    deep = [name for name in nested if name in DEEP_ELEMENTS]
    flat = [(name, nodes.add) for name, nodes in nested.items() if name not in DEEP_ELEMENTS]
    missing = []
    for root in roots:
        missing.append(root is None)
        found: dict[str, list] = {name: [] for name in deep}
        if root is not None and deep:
            elements = root.iter()
            next(elements)                                       # the root is no element of the document
            for element in elements:
                if (own := found.get(element.tag)) is not None:
                    own.append(element)
        for name, own in found.items():
            nested[name].add(own)
        for name, add in flat:
            add([] if root is None else root.findall(name))
        for name, values in leaves.items():
            values.append(None if root is None else root.findtext(name))
        root = found = element = own = elements = None           # before the next tree is made
    columns = [pa.array(leaves[name], pa.string()) if name in leaves else nested[name].array() for name in shape]
    return pa.StructArray.from_arrays(columns, list(shape), mask=pa.array(missing, pa.bool_()))


def parsed_documents(df: DataFrame, key_col: str, content_col: str, elements: Iterable[str] | None = None) -> DataFrame:
    """``xml_filename, doc, record, reason`` of a frame of documents as bytes or as decoded text: the parsed document with the named
    ``elements`` (default: all documented ones), or the record with the reason (``malformed``, ``trailing content``).

    A null document is malformed; an empty frame gives an empty one; other columns are ignored."""
    wanted = set(DOCUMENT_SHAPE if elements is None else elements)
    shape = {name: spec for name, spec in DOCUMENT_SHAPE.items() if name in wanted}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for low in range(0, batch.num_rows, _SLICE):
                part = batch.slice(low, _SLICE)
                bad, reasons = [], []

                def roots():
                    for c in part.column(1):
                        content = c.as_py()
                        root, reason = (None, "malformed") if content is None else parse_tree(content)
                        bad.append(None if reason is None else content.decode("utf-8", "replace") if isinstance(content, bytes) else content)
                        reasons.append(reason)
                        yield root
                        root = None

                docs = document_array(roots(), shape)
                yield pa.RecordBatch.from_arrays([part.column(0), docs, pa.array(bad, pa.string()), pa.array(reasons, pa.string())],
                                                 names=["xml_filename", "doc", "record", "reason"])

    return df.select(F.col(key_col).cast("string"), F.col(content_col)).mapInArrow(
        run, f"xml_filename string, doc struct<{document_ddl(shape)}>, record string, reason string")


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(docs: key + nested columns, quarantine: key, record, reason)."""
    return (parsed.filter(F.col("reason").isNull()).select("xml_filename", "doc.*"),
            parsed.filter(F.col("reason").isNotNull()).select("xml_filename", "record", "reason"))


def parse_documents(df: DataFrame, key_col: str, content_col: str, elements: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse a (key, document) frame. Returns (docs: key + nested columns, quarantine: key, record, reason)."""
    return split_parsed(parsed_documents(df, key_col, content_col, elements))


def raw_files(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """(xml_filename, content BINARY) for every matching file directly inside ``path`` that is not empty."""
    raw = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{glob}")
    return raw.select(F.col("_metadata.file_name").alias("xml_filename"), "content")


def empty_files(spark: SparkSession, path: str, glob: str = "*.xml") -> list[str]:
    """Names of zero-byte files (a scan produces no split, hence no row, for them). Listing metadata only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{glob}")
    statuses = pattern.getFileSystem(conf).globStatus(pattern) or []
    return sorted(st.getPath().getName() for st in statuses if st.isFile() and st.getLen() == 0)


def xml_documents(spark: SparkSession, path: str, glob: str = "*.xml", report_empty: bool = True,
                  once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Scan a folder of case files. Returns (docs, quarantine); their counts add up to the number of files.

    With ``once`` the files are read and parsed now, once for both frames (see ``parse_once``). ``report_empty`` lists the
    folder once more on the driver to find zero-byte files (a scan never reads them); on an object store with a very large
    folder this listing costs time, and it can be switched off: :mod:`tcelake.sources.folder` lists inside tasks."""
    parsed = parsed_documents(raw_files(spark, path, glob), "xml_filename", "content")
    docs, quarantine = split_parsed(parse_once(parsed) if once else parsed)
    empty = empty_files(spark, path, glob) if report_empty else []
    if empty:
        rows = spark.createDataFrame([(n, "", "malformed") for n in empty],
                                     "xml_filename string, record string, reason string")
        quarantine = quarantine.unionByName(rows)
    return docs, quarantine


def parse_once(docs: DataFrame) -> DataFrame:
    """Parsed documents written as nested Parquet to the shared checkpoint folder, so that the shredders and every model built
    on them read only the elements they need instead of reading and parsing the files again."""
    from tcelake.session import scratch_dir
    path = scratch_dir(docs.sparkSession, "parsed")
    docs.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path)
