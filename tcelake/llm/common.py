"""Helpers shared by the operators: table access and tables written to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.session import checkpoint_root


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table; extra columns (with whatever names) never reach an operator."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text`` of all documents, a null text as an empty one."""
    return texts_of(read_table(spark, sf_dir, "documents"))


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of a documents-shaped frame, a null text as an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that all executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


#: Writer options of frames whose rows are megabytes: without them Parquet looks at the size of a page and of a row group only after
#: 100 rows, which writer and reader then hold whole.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def written(df: DataFrame, name: str, codec: str = "zstd", options: dict[str, str] | None = None) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: lineage ends here, lost executors re-read files."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", codec).options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
