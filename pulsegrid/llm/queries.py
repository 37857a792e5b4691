"""Registered queries of this subpackage: each applies an operator to a whole table and returns its digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import align, ann, exact, html, mixing, packing, quality, simhash, spelling, substring, suffix, toxicity, trees
from pulsegrid.llm.oracles import ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), length=1024)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity.scores(docs, labels.where(~quality.held_out(F.col("doc_id"))), "toxic")
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeated(_table(spark, sf_dir, "documents"), width=13, texts=False)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(_table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~quality.held_out(F.col("doc_id"))), "quality")
    scored = quality.score(docs, model)
    predicted = (F.col("score") >= 0.3).cast("int")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removal_digests(_table(spark, sf_dir, "documents"), length=200)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_table(spark, sf_dir, "documents"), digest=True)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = {name: value for name, value in globals().items() if name.startswith("op") and callable(value)}
    return {**own, "pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)
