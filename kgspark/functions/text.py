"""Predicates, cleaning rules and small text formats used across the engine."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE_TYPES = ("item", "string", "external_id", "media", "time", "quantity")
RANKS = ("preferred", "normal", "deprecated")

# Catalogue genre names, English to French.
GENRES_EN_FR = {
    "Action": "Action",
    "Adventure": "Aventure",
    "Animation": "Animation",
    "Comedy": "Comédie",
    "Crime": "Crime",
    "Documentary": "Documentaire",
    "Drama": "Drame",
    "Family": "Familial",
    "Fantasy": "Fantastique",
    "History": "Histoire",
    "Horror": "Horreur",
    "Music": "Musique",
    "Mystery": "Mystère",
    "Romance": "Romance",
    "Science Fiction": "Science-Fiction",
    "Thriller": "Thriller",
    "TV Movie": "Téléfilm",
    "War": "Guerre",
    "Western": "Western",
}


def is_qid(col: Column) -> Column:
    return F.coalesce(col.rlike(r"^Q[0-9]+$"), F.lit(False))


def looks_like_id(col: Column) -> Column:
    return F.coalesce(col.rlike(r"^[QPL][0-9]+$"), F.lit(False))


def clean_label(col: Column) -> Column:
    """A label that is only an entity id carries no name and becomes ''."""
    return F.when(looks_like_id(col), F.lit("")).otherwise(col)


def valid_iso_date(col: Column) -> Column:
    """struct(date, year, month, day); all NULL unless the text is dddd-dd-dd.

    Year, month and day come from the text, so they stay even when the calendar
    has no such day and ``date`` is NULL.
    """
    ok = col.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    part = lambda i, n: F.when(ok, F.substring(col, i, n).cast("int"))
    return F.struct(
        F.when(ok, F.try_to_date(F.when(ok, col), "yyyy-MM-dd")).alias("date"),
        part(1, 4).alias("year"),
        part(6, 2).alias("month"),
        part(9, 2).alias("day"),
    )


def stale(ts: Column, now: Column, days: int) -> Column:
    """Never processed, or processed more than ``days`` days before ``now``."""
    return ts.isNull() | (ts < now - F.expr(f"INTERVAL {int(days)} DAYS"))


def truncated(col: Column, n: int) -> Column:
    return F.left(col, F.lit(n))


def filled(col: Column, numeric: bool = False) -> Column:
    """Not NULL and not the type's empty value ('' or 0)."""
    return F.coalesce(col != (F.lit(0) if numeric else F.lit("")), F.lit(False))


def label_like(col: Column, prefix: str) -> Column:
    return F.coalesce(col.startswith(prefix), F.lit(False))


def id_bucket(qid: Column, bounds: Sequence[tuple[int, str]], rest: str) -> Column:
    """Label of the first bound the numeric part of an id stays below."""
    number = F.substr(qid, F.lit(2)).try_cast("decimal(38,0)")
    out = None
    for bound, name in bounds:
        out = F.when(number < bound, name) if out is None else out.when(number < bound, name)
    return out.otherwise(rest)


def external_id_shape(col: Column) -> Column:
    return (
        F.when(col.isNull() | (col == ""), "empty")
        .when(col.rlike(r"^nm[0-9]+$"), "nm_digits")
        .when(col.rlike(r"^tt[0-9]+$"), "tt_digits")
        .when(col.rlike(r"^[0-9]+$"), "digits")
        .when(col.like("http%"), "url")
        .otherwise("other")
    )


def enum_guard(col: Column, allowed: Sequence[str], default: str | None = None) -> Column:
    return F.when(col.isin(*allowed), col).otherwise(F.lit(default).cast("string"))


def active(deleted: Column) -> Column:
    return F.coalesce(deleted, F.lit(0)) == 0


def not_deprecated(rank: Column) -> Column:
    return rank.isNull() | (rank != "deprecated")


def safe_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """round(100 * part / whole); NULL for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def pipe_list(items: Column) -> Column:
    """'|a|b|' from an array, '' from an empty or missing one."""
    return F.when(
        F.size(items) > 0, F.concat(F.lit("|"), F.array_join(items, "|"), F.lit("|"))
    ).otherwise("")


def alias_count(col: Column) -> Column:
    """Entries of a pipe list estimated from its separators (bytes, as the reports do)."""
    return F.octet_length(col) - F.octet_length(F.regexp_replace(col, r"\|", "")) + 1


def translate_genres_fr(col: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in GENRES_EN_FR.items() for x in pair])
    parts = F.split(col, r"\|")
    last = F.size(parts) - 1
    # Only names between two separators are list entries.
    return F.array_join(
        F.transform(
            parts,
            lambda x, i: F.when((i > 0) & (i < last), F.coalesce(F.try_element_at(table, x), x)).otherwise(x),
        ),
        "|",
    )


def strip_json_section(col: Column, begin: str, end: str, replacement: str) -> Column:
    """Cut every ``begin`` … ``end`` section and put ``replacement`` in its place."""
    pattern = f"(?s){_quoted(begin)}.*?{_quoted(end)}"
    return F.regexp_replace(col, pattern, replacement.replace("\\", "\\\\").replace("$", "\\$"))


def _quoted(text: str) -> str:
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", text)


def long_duration(seconds: Column) -> Column:
    """'2 days, 3 hours, 15 minutes, 30 seconds'; zero units left out."""
    s = seconds.cast("bigint")
    units = (
        ("day", F.floor(s / 86400)),
        ("hour", F.floor(F.pmod(s, F.lit(86400)) / 3600)),
        ("minute", F.floor(F.pmod(s, F.lit(3600)) / 60)),
        ("second", F.pmod(s, F.lit(60))),
    )
    parts = [
        F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {name}"), F.when(n != 1, "s").otherwise("")))
        for name, n in units
    ]
    return F.when(s < 0, "Invalid duration (negative seconds)").otherwise(F.concat_ws(", ", *parts))


def short_duration(seconds: Column) -> Column:
    """'1h 02m 03s', or '2m 03s' below one hour."""
    s = seconds.cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    return F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, r)).otherwise(
        F.format_string("%dm %02ds", m, r)
    )
