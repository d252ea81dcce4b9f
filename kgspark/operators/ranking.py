"""Ordered semantics: first, last, positions and pages, without one-task groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kgspark.session import cut


def keep_extreme(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    """One row per key: the first or last by ``order`` (a total order within the key).

    An aggregate rather than a row_number: partial results are combined before the
    shuffle, so a key holding a third of the rows never meets a single task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_extreme(df, keys, order, last=False)


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_extreme(df, keys, order, last=True)


def _in_order(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The rows range-partitioned and sorted by ``order``, written once; ``_row`` rises along the order, ``_part`` tells the range."""
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut(ranges.withColumn("_row", F.monotonically_increasing_id()), "in-order")
    return rows.withColumn("_part", F.shiftright("_row", 33))


def positions(df: DataFrame, order: Sequence[Column | str], name: str = "POSITION") -> DataFrame:
    """0-based position of every row by ``order``, a total order.

    A row's position is its place in its range plus the sizes of the ranges before, of which there are as many as tasks.
    """
    rows = _in_order(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(starts, "_part").withColumn(name, F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")


def display_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "DISPLAY_ORDER") -> DataFrame:
    """1-based position within ``keys`` by ``order``, a total order within the key; NULL keys are keys like others.

    Rows are range-partitioned by key and order, so a hot key is spread over as many tasks as its share of the rows. A
    position is the row's place in its range plus what earlier ranges hold of the key: prefix sums over a table of
    counts, one row per key and range.
    """
    rows = _in_order(df, [*keys, *order])
    runs = rows.groupBy(*keys, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    shifts = runs.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_part").alias("_run"), shift.alias("_shift"))
    same = [rows[k].eqNullSafe(shifts[f"_key{i}"]) for i, k in enumerate(keys)] + [rows["_part"] == shifts["_run"]]
    return rows.join(shifts, same).withColumn(name, (F.col("_row") + F.col("_shift")).cast("int")).select(*df.columns, name)


def first_position(df: DataFrame, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """Repeated entries of one key all get the key's first position."""
    first = df.groupBy(*keys).agg(F.min(order).alias(name))
    return df.join(first, list(keys))


def pinned_order(images: Column, base: Column, localized: Column) -> Column:
    """array(struct(image, position)): base image 0, localized 1, the rest 1..n.

    ``images`` is an array of structs with ``path`` and ``lang``. A base image in
    another language than English is pinned to 1. Works inside the payload row;
    nothing is shuffled.
    """

    def is_pinned(x: Column) -> Column:
        path = x.getField("path")
        return F.coalesce(path == base, F.lit(False)) | F.coalesce(F.array_contains(localized, path), F.lit(False))

    def pin(x: Column) -> Column:
        own_language = F.coalesce(x.getField("lang"), F.lit("")).isin("", "en")
        at = F.when(F.coalesce(x.getField("path") == base, F.lit(False)) & own_language, 0).otherwise(1)
        return F.struct(x.alias("image"), at.alias("position"))

    pinned = F.transform(F.filter(images, is_pinned), pin)
    rest = F.transform(
        F.filter(images, lambda x: ~is_pinned(x)),
        lambda x, i: F.struct(x.alias("image"), (i + 1).alias("position")),
    )
    return F.concat(pinned, rest)


def first_non_empty(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key and column, the first value by ``order`` that is neither NULL nor ''."""
    aggs = [
        F.min_by(c, F.when(F.coalesce(F.col(c) != "", F.lit(False)), F.struct(*order))).alias(c) for c in columns
    ]
    picked = df.groupBy(*keys).agg(*aggs)
    # min_by with only NULL orderings may return any row: blank that case.
    return picked.select(*keys, *[F.nullif(F.col(c), F.lit("")).alias(c) for c in columns])


def work_queue(df: DataFrame, ts: str, now: Column, days: int, rating: str, key: str, n: int = 1000) -> DataFrame:
    """Stale rows, best rated first, unrated last, ties by key."""
    from kgspark.functions.text import stale

    return df.filter(stale(F.col(ts), now, days)).orderBy(F.desc_nulls_last(rating), key).limit(n)


def keyset_page(df: DataFrame, key: str, cursor: str, size: int = 5000) -> DataFrame:
    """Next page after a cursor; ids compare as text."""
    return df.filter(F.col(key) > cursor).orderBy(key).limit(size)


def next_cursor(page: DataFrame, key: str, size: int) -> DataFrame:
    """The last key of a full page; a short page starts over with ''."""
    return page.agg(F.when(F.count(F.lit(1)) < size, "").otherwise(F.max(key)).alias("CURSOR"))


def bounded_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` highest ids: a sample that is the same in every run."""
    return df.orderBy(F.desc(key)).limit(n)
