"""From raw documents to packed sequences: each stage is one operator of kgspark.llm, written and read again.

Stages take every row that the stage before kept, with all its columns, whatever their names; only ``doc_id`` and ``text``
must be there (a stage that changes texts tells ``n_chars`` anew if there is one). Rows with null ids or texts, empty and
repeated rows go through: the classifier scores the empty text, of equal texts one row stays, and a document without an id
stays unless it copies one. An empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm import exact, neardup, packing, quality, secrets
from kgspark.llm.common import cut, table
from kgspark.session import cut_path, scratch


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; clean documents stay."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest id, one without an id only if no other has one.

    Rows are told apart by keys of their own, not by ids. Documents without shingles have no group.
    """
    rows = cut(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")), "rows")
    found = neardup.near_classes(rows.select("row", "text"), "row").select("row", "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "row")
    first = rows.select("row", order.alias("order")).join(found, "row").groupBy("component_id").agg(F.min("order").alias("first"))
    kept = rows.join(first.select("first.row"), "row", "left_semi")
    return kept.select("text", "rest.*").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are masked and its length is told anew."""
    masked = secrets.masked(docs)
    return (masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, as the packing operator returns them."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality), ("exact dedup", without_copies), ("near dedup", without_near_copies),
    ("secret scans", without_secrets), ("packing", packed),
]

#: SQL can express neither the classifier nor the sketches; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage wrote for itself is deleted once its own rows are written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            path = cut_path(spark, name.replace(" ", "-"), inner=False)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
