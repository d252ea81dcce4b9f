"""Counting reports: groups, distincts, shares, verdicts, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions.text import alias_count, safe_pct



def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("N"))


def top_by_count(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent keys; ties in key order."""
    return count_by(df, key).orderBy(F.desc("N"), key).limit(n)


def occurrences(df: DataFrame, keys: Sequence[str], value: Column | str) -> DataFrame:
    """Rows against distinct values per key, their ratio, and the collapse verdict.

    As many rows as values means each value was kept once: occurrences were lost.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("ROWS"), F.count_distinct(value).alias("DISTINCT_VALUES"))
    return counts.withColumn(
        "PER_VALUE", F.round(F.col("ROWS") / F.nullif(F.col("DISTINCT_VALUES"), F.lit(0)), 2)
    ).withColumn("VERDICT", F.when(F.col("ROWS") == F.col("DISTINCT_VALUES"), "ALERT").otherwise("ok"))


def batch_span(df: DataFrame, batch: str, ts: str) -> DataFrame:
    """First and last time per batch and the whole hours between them."""
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("N"), F.min(ts).alias("_a"), F.max(ts).alias("_b")).select(
        batch,
        "N",
        F.date_format("_a", "yyyy-MM-dd HH:mm:ss").alias("FIRST_AT"),
        F.date_format("_b", "yyyy-MM-dd HH:mm:ss").alias("LAST_AT"),
        F.timestamp_diff("HOUR", F.col("_a"), F.col("_b")).alias("HOURS"),
    )


def hourly(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.date_format(F.date_trunc("HOUR", ts), "yyyy-MM-dd HH:00").alias("HOUR")).agg(F.count(F.lit(1)).alias("N"))


def yearly_top(df: DataFrame, date: str, n: int) -> DataFrame:
    counts = df.groupBy(F.year(date).alias("YEAR")).agg(F.count(F.lit(1)).alias("N"))
    return counts.orderBy(F.desc("N"), "YEAR").limit(n)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table; an empty table counts 0."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("N")).select(F.lit(name).alias("TABLE_NAME"), "N")
        out = part if out is None else out.union(part)
    return out


def alias_volume(df: DataFrame, column: str) -> DataFrame:
    """Rows with aliases and the number of aliases estimated from separators."""
    has = F.coalesce(F.col(column) != "", F.lit(False))
    return df.agg(F.count_if(has).alias("ROWS_WITH_ALIASES"), F.coalesce(F.sum(F.when(has, alias_count(F.col(column)))), F.lit(0)).alias("ALIASES"))


def fill_rate(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and filled values per column (not NULL, not ''), optionally per group."""
    filled = lambda c: F.count_if(F.coalesce(F.col(c).cast("string") != "", F.lit(False)))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("ROWS"), *[filled(c).alias(c) for c in columns])


def pipe_lists(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """'|a|b|' of the distinct values per key, in order of first appearance.

    Repetitions are folded before anything is gathered, so a key holds as many
    entries as it has different values, however many rows it has.
    """
    from kgspark.functions.text import pipe_list

    first = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(order).alias("_o"))
    listed = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_o", value))).alias("_l"))
    return listed.select(key, pipe_list(F.col(f"_l.{value}")).alias("LIST"))


def share(df: DataFrame, condition: Column, digits: int = 1) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("TOTAL"), F.count_if(condition).alias("PART"))
    return counts.withColumn("PCT", safe_pct(F.col("PART"), F.col("TOTAL"), digits))
