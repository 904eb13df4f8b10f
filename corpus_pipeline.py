"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go; one document of each group of near copies stays; passages that stand earlier in the corpus are cut
out; personal data is masked; what is left is tokenized and packed. All stages but the last return the columns of
``documents``; ``n_chars`` follows the text. Null texts count as empty; an empty table passes through as an empty one;
rows without doc_id are kept (they are near copies of nothing); of rows that repeat doc_id and text one stays.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.llm import packing, pii, repeats, superminhash, toxicity
from tcelake.llm.common import read_table, written

REJECT = 0.7             # toxicity score from which a document goes
CAPACITY = 2048          # ids in a packed sequence


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``REJECT``."""
    grammar = toxicity.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    name = "toxicity"
    while name in docs.columns:
        name = f"_{name}"
    return toxicity.score(docs, grammar, name).filter(F.col(name) < REJECT).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more): the smallest doc_id."""
    kept = superminhash.near_duplicates(docs, width=5, percent=80).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    stay = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return stay.dropDuplicates(["doc_id", "text"])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that start earlier in the corpus."""
    return _measured(repeats.without_repeats(docs, least=100))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _measured(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a packed sequence."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)
    return packing.pack(pieces, CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeats", cut_repeats),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: No SQL: fitting, tokenizing and packing have none. tests/llm checks repeated passages by brute force, the other stages in part.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
