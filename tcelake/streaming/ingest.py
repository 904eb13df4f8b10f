"""Incremental ingest: case files that arrive in a folder are parsed, shredded and appended to the five datasets.

Structured Streaming's file source tracks which files were processed (in the checkpoint), so each file is ingested
once across runs; ``availableNow`` processes the backlog and stops, like a scheduled batch run. Each micro-batch is
parsed once; its rows land in the ``ingest_batch=<id>`` partition of each dataset (an extra column for readers), which a
retried batch overwrites. Bad files go to the quarantine dataset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.operators.shred import shred_all
from tcelake.plans.batch import PARTITIONED
from tcelake.sources.xml_docs import parse_once, parsed_documents, split_parsed


BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def case_file_stream(spark: SparkSession, input_uri: str, glob: str = "*.xml",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (xml_filename, content) over new files in ``input_uri``."""
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", "false"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.load(input_uri)
    return raw.select(F.element_at(F.split(F.col("path"), "/"), -1).alias("xml_filename"), "content")


def _append_batch(output_uri: str):
    out = output_uri.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        # Each micro-batch owns the partition ingest_batch=<id>, written in dynamic-overwrite mode: a batch that is
        # retried after a failure replaces its own output instead of appending it twice.
        # The batch is parsed once for the quarantine and the five shredders.
        docs, quarantine = split_parsed(parse_once(parsed_documents(batch, "xml_filename", "content")))
        for name, df in {"quarantine": quarantine, **shred_all(docs)}.items():
            (df.withColumn("ingest_batch", F.lit(batch_id).cast("long"))
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("ingest_batch", *PARTITIONED.get(name, []))
               .parquet(f"{out}/{name}"))
    return write


def start_ingest(spark: SparkSession, input_uri: str, output_uri: str, checkpoint_uri: str | None = None,
                 glob: str = "*.xml", available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the incremental ingest; returns the StreamingQuery (``awaitTermination()`` for availableNow runs)."""
    stream = case_file_stream(spark, input_uri, glob, max_files_per_trigger)
    # The checkpoint belongs to the output: a second call on the same output goes on where the first one stopped.
    ckpt = checkpoint_uri or f"{output_uri.rstrip('/')}/_checkpoint"
    w = stream.writeStream.foreachBatch(_append_batch(output_uri)).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
