"""Raw API documents: query-result bindings and catalogue payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sparql_results(spark: SparkSession, path: str) -> DataFrame:
    """Result documents as text, one row per file."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"))


def bindings(documents: DataFrame, variables: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per result binding, its position, and one column per variable.

    An optional variable the binding lacks is NULL.
    """
    cell = ", ".join(f"`{v}` STRUCT<value: STRING>" for v in variables)
    schema = f"STRUCT<results: STRUCT<bindings: ARRAY<STRUCT<{cell}>>>>"
    rows = documents.select(
        *(keep or []), F.posexplode(F.from_json("payload", schema).getField("results").getField("bindings")).alias("pos", "b")
    )
    return rows.select(*(keep or []), "pos", *[F.col(f"b.`{v}`.value").alias(v) for v in variables])


def entity_of(uri: Column) -> Column:
    """Last path segment of an entity URI."""
    return F.substring_index(uri, "/", -1)


def read_api_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload table: (entity, id, endpoint, lang, fetched_at, payload text)."""
    schema = "entity STRING, id BIGINT, endpoint STRING, lang STRING, fetched_at STRING, payload STRING"
    return spark.read.schema(schema).json(path)
