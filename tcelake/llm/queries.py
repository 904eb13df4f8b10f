"""The registered queries of the operators, each over its whole table, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.llm import (crosspolytope, filter_audit, fmindex, licenses, packing, pii, piece_codec, repeats, spotsigs, sql, superminhash, toxicity,
                         wavelet, winnowing)
from tcelake.llm.common import documents, read_table


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(documents(spark, sf_dir), word_vocabulary(), 2048), 2048)


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_duplicates(read_table(spark, sf_dir, "embeddings"), least=0.9)


def op3_maximal_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal(repeats.removed_runs(documents(spark, sf_dir), least=100)).drop("kept")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(documents(spark, sf_dir))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = pii.KINDS[:pii.N_BASE]
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
                        F.sha2(pii.spans_text(of(*base)), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"))


def op6_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spotsigs.fingerprint_edits(documents(spark, sf_dir))
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                       spotsigs.fingerprint_text(F.col("own")).alias("fingerprint"),
                       spotsigs.fingerprint_text(F.col("edited_own")).alias("edited_fingerprint"),
                       spotsigs.pruned_jaccard(F.col("own"), F.col("edited_own")).alias("near_edited"),
                       spotsigs.pruned_jaccard(F.col("own"), F.col("next_own")).alias("near_next"))


def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(documents(spark, sf_dir), width=2, percent=80)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    grammar = toxicity.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, grammar).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op10_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(documents(spark, sf_dir), word_vocabulary(), end_id=2)


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op12_fm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.collocations(read_table(spark, sf_dir, "documents", "lang", "text"))


def op13_filter_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents", "doc_id", "lang", "text"),
                              read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_cross_polytope, op3_maximal_repeats, op4_license_scan, op5_personal_data, op6_spot_signatures, op7_superminhash, op8_toxicity,
                                   op9_sentencepiece, op10_wavelet_shards, op11_winnowing, op12_fm_collocations, op13_filter_potential)}

ORACLES = {"op2_cross_polytope": sql.EMBEDDINGS, "op7_superminhash": sql.NEAR_COPIES, "op11_winnowing": sql.CONTAMINATION,
           "op12_fm_collocations": sql.COLLOCATIONS, "op13_filter_potential": sql.FILTER_AUDIT}
