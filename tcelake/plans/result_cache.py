"""Results kept by what they are computed from: the query and the state of its inputs.

The key is a hash of the optimized plan with normalised ids, the settings that results depend on, and for every input folder the names,
lengths and times of its files. So the same query over the same files is read back, and a file that is added, removed or
changed, or a view that shows another version, makes another key: nothing has to be invalidated.

Kept are only results that such a key describes in full: deterministic plans over files, without Python functions (a plan tells their name,
not what they do; one whose text merely looks like it counts as such) and without rows of the session. Everything else is computed anew each time. Times such as ``now()`` are
literals in the optimized plan, so they never hit.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.sinks.ledger import Ledger

SETTINGS = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.caseSensitive")
_PYTHON = re.compile(r"Python|MapIn|FlatMap|InPandas|InArrow")
_JVM = re.compile(r'"jvmId":"[^"]*"')
_FIELDS = "spark.sql.debug.maxToStringFields"


class Result(NamedTuple):
    frame: DataFrame
    hit: bool
    key: str | None          # None: not of the kind that is kept


class ResultCache:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ledger = Ledger(spark, f"{self.root}/_ledger")

    def _plan(self, df: DataFrame):
        """(Text of the normalised plan, input folders), or None where they do not describe the result."""
        execution = df._jdf.queryExecution()
        plan = execution.optimizedPlan()
        if not execution.analyzed().deterministic():
            return None
        folders, leaves = set(), plan.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if leaf.getClass().getSimpleName() == "Range":
                continue
            if leaf.getClass().getSimpleName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
                return None
            paths = leaf.relation().location().rootPaths()
            folders.update(paths.apply(j).toString() for j in range(paths.size()))
        # Wide schemas and long lists in full: what is cut from the text would be cut from the key.
        before = self.spark.conf.get(_FIELDS, None)
        self.spark.conf.set(_FIELDS, str(2 ** 31 - 1))
        try:
            text = plan.canonicalized().toString()
        finally:
            self.spark.conf.set(_FIELDS, before) if before is not None else self.spark.conf.unset(_FIELDS)
        # The text shows literals without quotes; the tree of the analyzed plan holds each with its type, in its place.
        tree = _JVM.sub("", execution.analyzed().canonicalized().toJSON())
        return None if _PYTHON.search(text) else (text + "\n" + tree, sorted(folders))

    def _version(self, folder: str) -> str:
        """State of the files below a folder; one pass over their names, none is opened."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        exact = lambda h: F.sum(h.cast("decimal(20,0)")).cast("string")
        state = ["path", "length", "modificationTime"]
        return repr(tuple(files.agg(F.count(F.lit(1)), exact(F.xxhash64(*state)), exact(F.xxhash64(F.lit(1), *state))).first()))

    def key(self, df: DataFrame) -> str | None:
        if (plan := self._plan(df)) is None:
            return None
        text, folders = plan
        settings = [(s, self.spark.conf.get(s, None)) for s in SETTINGS]
        return hashlib.sha256(repr((text, df.schema.json(), settings, [(f, self._version(f)) for f in folders])).encode()).hexdigest()[:32]

    def get(self, df: DataFrame) -> Result:
        """The rows of ``df`` (their order is not kept). A kept result is read; another one is computed, written and read.

        ``df`` must have been made after the last change of its inputs, as Spark lists files when a frame is made. A result that was
        written in part has no entry and is written again."""
        if (key := self.key(df)) is None:
            return Result(df, False, None)
        uri, hit = f"{self.root}/{key}", self.ledger.get(key) is not None
        if not hit:
            df.write.mode("overwrite").parquet(uri)
            self.ledger.put(key, {"uri": uri})
        return Result(self.spark.read.schema(df.schema).parquet(uri), hit, key)
