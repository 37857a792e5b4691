"""Training corpus from raw documents, stage by stage; each stage is written as Parquet and read by the next.

In every stage a null text counts as empty, very long texts are handled whole, and an empty table gives an empty result. Columns
that documents carry beside id, text and source go through the first four stages unchanged, whatever their names
(``n_chars`` is counted again where texts change). Ties between documents go to the smaller id, a null id comes last;
of rows that are equal in all columns one stays after the near-copy stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import mixing, packing, quality, simhash, suffix
from pulsegrid.sources.scratch import cut


def _counted(docs: DataFrame) -> DataFrame:
    """Characters counted again, where documents carry their number."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out(F.col("doc_id")))
    return quality.keep_good(docs, quality.train(docs, labels, "quality"), threshold=0.3)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the least id."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings of 200 bytes."""
    return _counted(suffix.remove_repeated(docs, length=200))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as the mix of sources takes them."""
    return _counted(mixing.mixed_texts(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 1024 and their places."""
    return packing.pack_documents(docs, length=1024)


STAGES = [
    ("quality", good_quality),
    ("simhash", without_near_copies),
    ("suffix", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

#: Token ids, suffix order and a fitted model are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
