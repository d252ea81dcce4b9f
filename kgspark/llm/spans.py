"""Spans of patterns in whole texts, with built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string,group:string,before:string>>"


def located(text: Column, pattern: str, group: int | None = None, before: int = 0, given: Column | None = None) -> Column:
    """All leftmost, non-overlapping matches of a pattern that matches no empty text.

    Each has ``start`` and ``end`` (code points, end exclusive), ``value``, ``group`` (a group's text, if asked for) and
    ``before`` (up to so many code points before it, not reaching into the match before). Where ``given`` is not true
    the text isn't searched. A match's place follows from the lengths of the pieces between matches.
    """
    every = [F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")]
    if group is not None:
        every.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("group"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        one = F.struct(
            start.alias("start"), end.alias("end"), x["value"].alias("value"), (x["group"] if group is not None else F.lit(None).cast("string")).alias("group"),
            (F.right(x["gap"], F.lit(before)) if before else F.lit(None).cast("string")).alias("before"),
        )
        return F.struct(F.coalesce(end, start).alias("at"), F.when(x["value"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(one))).alias("out"))

    none = F.array().cast(SPAN)
    found = F.aggregate(F.arrays_zip(*every), F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return found if given is None else F.when(given, found).otherwise(none)


def listed(by_kind: dict[str, Column]) -> Column:
    """``kind:start:end`` of all spans, by start, then by the kinds' order, comma-joined; no spans give the empty text."""

    def of(kind: str, k: int):  # a lambda of one parameter: a second one would be taken for the place in the array
        return lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), F.lit(kind).alias("kind"))

    rows = [F.transform(spans, of(kind, k)) for k, (kind, spans) in enumerate(by_kind.items())]
    joined = F.array_sort(rows[0] if len(rows) == 1 else F.concat(*rows))
    return F.array_join(F.transform(joined, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
