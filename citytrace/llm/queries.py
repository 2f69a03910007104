"""The registered queries of the thirteen operators, on whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, cascade, crosspolytope, fmindex, gridjoin, langid, mixing, pseudonyms, quality, quotes, rangecoder, resampling,
    simhash,
)
from .shared import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each copy of each document in a mixture of 97 % of the greatest entropy and the corpus's size."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plan = mixing.mixing_plan(docs, entropy=0.97)
    rows = mixing.realised(docs.select("doc_id", "source"), plan)
    return rows.select("row.doc_id", "row.source", "epoch", "block")


def op2_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridjoin.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    found = cascade.judged(pages, cascade.listed_hosts(pages))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op5_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(_table(spark, sf_dir, "conversations"))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key stands in for a secret that a deployment keeps elsewhere."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(docs, key="the check's own key")


def op7_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fmindex.find_spans(docs, _table(spark, sf_dir, "benchmark"))
    hits = F.aggregate("spans", F.lit(0), lambda n, span: n + span["after"] - span["first"]).cast("long")
    ordered = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return found.select(
        "row.doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ordered, ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangecoder.token_output(_table(spark, sf_dir, "documents"))


def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(_table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_grid_join": op2_grid_join,
    "op3_simhash": op3_simhash,
    "op4_cascade": op4_cascade,
    "op5_quotes": op5_quotes,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_fm_index": op7_fm_index,
    "op8_quality": op8_quality,
    "op9_language": op9_language,
    "op10_token_ids": op10_token_ids,
    "op11_cross_polytope": op11_cross_polytope,
    "op12_alignment": op12_alignment,
    "op13_resampling": op13_resampling,
}
