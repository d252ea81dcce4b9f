"""Exact duplicates, with frequent texts taken out before the shuffle.

Misra-Gries counters, one set a task, name every digest that may be frequent; exact counts verify them. Their winners,
at most ``slots`` rows, are broadcast and settle the rows of frequent texts where they lie. All other digests take the
ordinary shuffle, in which no group holds more than about one ``slots``-th of the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.common import cut, map_rows, row_key, text_or_empty

#: What normalising deletes: blank, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"


def digest(text: Column) -> Column:
    """SHA-256 of the text without white space, in lowercase hex."""
    return F.sha2(F.encode(F.translate(text, WHITE, ""), "UTF-8"), 256)


def misra_gries(values: Iterable, slots: int, counters: Counter | None = None) -> Counter:
    """At most ``slots`` counters; every value of more than len(values) / (slots + 1) occurrences keeps one."""
    counters = Counter() if counters is None else counters
    for value, n in Counter(values).items():
        counters[value] += n
    if len(counters) > slots:  # counters of two streams merge by adding and taking off the largest that must go
        least = sorted(counters.values(), reverse=True)[slots]
        counters = Counter({v: n - least for v, n in counters.items() if n > least})
    return counters


def frequent(df: DataFrame, column: str, slots: int) -> DataFrame:
    """Every value that one of ``slots + 1`` parts of the rows could hold, with a lower bound of its count; at most ``slots`` rows."""

    def rows():
        state = Counter()

        def apply(batch):
            nonlocal state
            before = state
            state = misra_gries(batch[column], slots, Counter(before))
            # What this batch changed, as differences: a task's rows add up to its counters.
            changed = {v: state.get(v, 0) - before.get(v, 0) for v in {*state, *before}}
            kept = [(v, n) for v, n in changed.items() if n]
            return {"value": [v for v, _ in kept], "n": [n for _, n in kept]}

        return apply

    part = map_rows(df.select(column), rows, "value string, n long")
    return part.groupBy("value").agg(F.sum("n").alias("n")).filter("n > 0").orderBy(F.desc("n"), "value").limit(slots)


def _grouped(docs: DataFrame, id_col: str, text_col: str, slots: int, key: Column) -> DataFrame:
    """``__row`` (the row's key), ``__id``, ``__digest`` and, of its group, ``__first`` and ``__size``."""
    text = text_or_empty(text_col)
    rows = cut(
        docs.select(key.alias("__row"), F.col(id_col).cast("long").alias("__id"), F.length(text).cast("long").alias("__n"), digest(text).alias("__digest")), "digests"
    )
    first = F.struct((-F.col("__n")).alias("n"), F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    best = F.min(first).alias("__first"), F.count("*").alias("__size")
    named = frequent(rows, "__digest", slots).select(F.col("value").alias("__digest"))  # at most ``slots`` rows
    winners = cut(rows.join(F.broadcast(named), "__digest", "left_semi").groupBy("__digest").agg(*best), "winners")  # at most ``slots`` rows
    settled = rows.join(F.broadcast(winners), "__digest")
    rest = rows.join(F.broadcast(winners), "__digest", "left_anti")
    return settled.unionByName(rest.join(rest.groupBy("__digest").agg(*best), "__digest"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = 256) -> DataFrame:
    """Which row stays of each group of equal texts.

    Texts are equal when they are identical without white space (blank and U+0009 to U+000D); null counts as empty.
    Of equal texts the one with the most code points stays, then the smallest id (nulls last), then the row read first.
    Returns a row per input row: the id, ``keep_id``, ``group_size`` (rows), ``kept`` (one row a group) and ``text_sha256``.
    Repeated rows count each and one of them stays; an empty table gives none; other columns are ignored.
    """
    return _grouped(docs, id_col, text_col, slots, F.monotonically_increasing_id()).select(
        F.col("__id").alias(id_col), F.col("__first.id").alias("keep_id"), F.col("__size").alias("group_size"),
        (F.col("__row") == F.col("__first.row")).alias("kept"), F.col("__digest").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = 256) -> DataFrame:
    """The rows that stay, with all their columns, whatever their names; see ``exact_groups``.

    Digests and row keys are grouped; the texts meet the keys of the rows that stay by one join.
    """
    columns = docs.columns
    keyed, key = row_key(docs)
    grouped = _grouped(keyed, id_col, text_col, slots, key)
    stay = grouped.filter(F.col("__row") == F.col("__first.row")).select("__row")
    whole = keyed.select(key.alias("__row"), F.struct(*columns).alias("__whole"))
    return whole.join(stay, "__row", "left_semi").select("__whole.*")
