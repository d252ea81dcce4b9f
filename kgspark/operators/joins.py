"""Join shapes the reports and questions are made of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_lookup(df: DataFrame, labels: DataFrame, key: str, name: str = "LABEL") -> DataFrame:
    """Left lookup of a label by id; the raw id when there is none.

    ``labels`` has one row per id (ID_WIKIDATA, LABEL_EN).
    """
    side = labels.select(F.col("ID_WIKIDATA").alias(key), F.col("LABEL_EN").alias("_label"))
    return df.join(side, key, "left").withColumn(name, F.coalesce("_label", key)).drop("_label")


def exists_in_any(df: DataFrame, key: str, *tables: DataFrame) -> DataFrame:
    """Rows whose key is in any table: one semi join to the union of the keys."""
    ids = tables[0].select(F.col(tables[0].columns[0]).alias(key))
    for t in tables[1:]:
        ids = ids.union(t.select(F.col(t.columns[0]).alias(key)))
    return df.join(ids.distinct(), key, "left_semi")


def missing_from_all(df: DataFrame, key: str, *tables: DataFrame) -> DataFrame:
    """Rows whose key is in none of the tables (a NULL key is in none)."""
    ids = tables[0].select(F.col(tables[0].columns[0]).alias(key))
    for t in tables[1:]:
        ids = ids.union(t.select(F.col(t.columns[0]).alias(key)))
    return df.join(ids.distinct(), key, "left_anti")


def not_in(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """SQL ``NOT IN``: one NULL on the right empties the result, a NULL key never passes.

    An anti join, and an uncorrelated EXISTS for the NULL rule: it is answered once,
    before the join, and pairs nothing with anything.
    """
    values = listed.select(F.col(listed.columns[0]).alias(key))
    has_null = values.filter(F.col(key).isNull())
    rows = df.filter(F.col(key).isNotNull() & ~has_null.exists())
    return rows.join(values.filter(F.col(key).isNotNull()), key, "left_anti")


def existence_flags(df: DataFrame, key: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One boolean per table telling whether the key occurs in it.

    The tables are stacked, reduced to one row of flags per key, and joined once.
    """
    stacked = None
    for name, t in tables.items():
        part = t.select(F.col(t.columns[0]).alias(key), F.lit(name).alias("_t"))
        stacked = part if stacked is None else stacked.union(part)
    flags = stacked.groupBy(key).agg(*[F.bool_or(F.col("_t") == n).alias(n) for n in tables])
    joined = df.join(flags, key, "left")
    return joined.select(*df.columns, *[F.coalesce(n, F.lit(False)).alias(n) for n in tables])


def first_per_key(df: DataFrame, key: str, value: str, order: Sequence[Column | str]) -> DataFrame:
    """One value per key: the first by a total order (a scalar lookup with LIMIT 1)."""
    return df.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))


def pair_by_language(texts: DataFrame, left: str, right: str, key: str = "ID_WIKIDATA") -> DataFrame:
    """Rows of one language beside the other language's row of the same id."""
    l_ = texts.filter(F.col("LANG") == left).select(key, F.col("LABEL").alias(f"LABEL_{left.upper()}"))
    r_ = texts.filter(F.col("LANG") == right).select(key, F.col("LABEL").alias(f"LABEL_{right.upper()}"))
    return l_.join(r_, key)


def matched_triples(triples: DataFrame, others: DataFrame) -> DataFrame:
    """Triples that also occur on the other side, multiplicity of the left kept."""
    keys = ["ID_WIKIDATA", "ID_PROPERTY", "ID_ITEM"]
    return triples.join(others.select(*keys).distinct(), keys, "left_semi")


def cast_key_join(texts: DataFrame, text_key: str, numbers: DataFrame, number_key: str) -> DataFrame:
    """Join a text id with the decimal text of a number."""
    side = numbers.withColumn("_text", F.col(number_key).cast("string"))
    return texts.join(side, texts[text_key] == side["_text"]).drop("_text")


def same_text(a: Column, b: Column) -> Column:
    """Equality that ignores case, accents and trailing blanks."""
    return F.collate(F.rtrim(a), "UNICODE_CI_AI") == F.collate(F.rtrim(b), "UNICODE_CI_AI")


def best_of(df: DataFrame, group: str, value: str, rating: str, tie: str) -> DataFrame:
    """The value of the best rated row per group; ties go to the lowest ``tie``."""
    return df.groupBy(group).agg(F.max_by(value, F.struct(F.col(rating), -F.col(tie))).alias(value))


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Only left, both, only right: distinct key counts of two sets."""
    tagged = left.select(key, F.lit(1).alias("_s")).union(right.select(key, F.lit(2).alias("_s")))
    sides = tagged.groupBy(key).agg(F.bit_or("_s").alias("_s"))
    return sides.agg(
        F.count_if(F.col("_s") == 1).alias("ONLY_LEFT"),
        F.count_if(F.col("_s") == 3).alias("BOTH_SIDES"),
        F.count_if(F.col("_s") == 2).alias("ONLY_RIGHT"),
    )
