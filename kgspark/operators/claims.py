"""Claim flattening: entity documents to statements, qualifiers and typed values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions import ident, once

# Dump datatype to local value type; every other datatype is dropped.
LOCAL_TYPE = {
    "wikibase-item": "item",
    "string": "string",
    "external-id": "external_id",
    "commonsMedia": "media",
    "time": "time",
    "quantity": "quantity",
}

# Properties kept for an entity that is stored only as a cached label.
CACHED_PROPERTIES = ("P31", "P279", "P345", "P569", "P570", "P577")
CACHED_TYPES = ("item", "external_id", "time")

_SNAK = "STRUCT<snaktype STRING, datatype STRING, hash STRING, datavalue STRUCT<value VARIANT>>"
_BARE_CLAIM = f"STRUCT<id STRING, rank STRING, mainsnak {_SNAK}>"
_CLAIM = f"STRUCT<id STRING, rank STRING, mainsnak {_SNAK}, qualifiers MAP<STRING, STRING>>"

# Columns of each typed value table, as SQL over the unified value struct ``v``.
VALUE_COLUMNS = {
    "item": {"ID_ITEM": "v.ID_ITEM"},
    "string": {
        "VALUE_STRING": "v.TEXT",
        "VALUE_STRING_NORMALIZED": "v.TEXT",
        "LANG_CODE": "CAST(NULL AS STRING)",
    },
    "external_id": {
        "VALUE_EXTERNAL_ID": "v.TEXT",
        "VALUE_EXTERNAL_ID_NORMALIZED": "v.TEXT",
        "FORMATTER_URL": "CAST(NULL AS STRING)",
        "FORMATTER_URI_RDF": "CAST(NULL AS STRING)",
        "VALIDATION_STATUS": "CAST(NULL AS STRING)",
    },
    "media": {
        "FILE_NAME": "v.TEXT",
        "MEDIA_REPOSITORY": "'commons'",
        "FILE_PAGE_URL": "CAST(NULL AS STRING)",
        "FILE_DIRECT_URL": "CAST(NULL AS STRING)",
        "MIME_TYPE": "CAST(NULL AS STRING)",
        "FILE_EXTENSION": "CAST(NULL AS STRING)",
    },
    "time": {
        "RAW_TIME_VALUE": "v.TIME.RAW_TIME_VALUE",
        "TIME_PRECISION": "v.TIME.TIME_PRECISION",
        "CALENDAR_MODEL": "v.TIME.CALENDAR_MODEL",
        "TIMEZONE_OFFSET": "v.TIME.TIMEZONE_OFFSET",
        "YEAR_VALUE": "v.TIME.YEAR_VALUE",
        "MONTH_VALUE": "v.TIME.MONTH_VALUE",
        "DAY_VALUE": "v.TIME.DAY_VALUE",
        "DATE_START": "CAST(NULL AS DATE)",
        "DATE_END": "CAST(NULL AS DATE)",
    },
    "quantity": {
        "AMOUNT": "v.QUANTITY.AMOUNT",
        "UNIT_ID_WIKIDATA": "v.QUANTITY.UNIT_ID_WIKIDATA",
        "LOWER_BOUND": "v.QUANTITY.LOWER_BOUND",
        "UPPER_BOUND": "v.QUANTITY.UPPER_BOUND",
        "AMOUNT_NORMALIZED": "CAST(NULL AS DECIMAL(30,10))",
        "DISPLAY_VALUE": "CAST(NULL AS STRING)",
    },
}


def _exploded(rows: DataFrame, schema: str, key: str, name: str) -> DataFrame:
    """Expand the JSON text ``list`` into (pos, parsed element, raw text).

    A list is parsed once, as a whole. The raw text of its elements is extracted only
    from lists in which some element lacks its ``key`` and needs a canonical identity;
    a list with an element of another shape is read element by element.
    """
    texts = F.from_json("list", "ARRAY<STRING>")
    parsed = F.coalesce(F.from_json("list", f"ARRAY<{schema}>"), F.transform(texts, lambda r: F.from_json(r, schema)))
    lists = once(rows, s=parsed).filter(F.col("s").isNotNull())
    keyless = F.exists("s", lambda x: F.coalesce(x.getField(key), F.lit("")) == "")
    lists = once(lists, t=F.when(keyless, texts)).drop("list")
    flat = lists.select(*[c for c in rows.columns if c != "list"], F.posexplode("s").alias("pos", name), "t")
    return flat.withColumn("raw", F.get("t", F.col("pos"))).drop("t")


def explode_claims(entities: DataFrame, properties: Sequence[str] | None = None, exact_ids: bool = True, qualifiers: bool = True) -> DataFrame:
    """One row per claim: subject, property, parsed claim, statement id.

    ``qualifiers=False`` is for readers of main values only: qualifiers, often most of a claim's text, are skipped by the
    parser instead of being copied, and the column is left out.

    A property filter runs on the map keys, before the property's list is parsed.
    ``exact_ids=False`` is for dumps whose claims carry whole numbers only where the
    GUID is missing; it keeps the whole plan in the JVM.
    """
    per_property = entities.filter(F.col("claims").isNotNull()).select(
        F.col("id").alias("ID_WIKIDATA"), F.explode("claims").alias("ID_PROPERTY", "list")
    )
    if properties is not None:
        per_property = per_property.filter(F.col("ID_PROPERTY").isin(*properties))
    return _claim_rows(_exploded(per_property, _CLAIM if qualifiers else _BARE_CLAIM, "id", "c"), exact_ids, qualifiers)


def read_claims(lines: DataFrame, exact_ids: bool = True, qualifiers: bool = True) -> DataFrame:
    """``explode_claims`` of all properties, straight from dump lines: one parse a line, no list is copied as text and parsed again.

    Lines that this parse cannot read whole, or with a claim that has no id (its text is its identity), are read by raw
    texts, so that a malformed property does not touch its neighbours; lines no JSON parser accepts are left out.
    """
    claim, marked = _CLAIM if qualifiers else _BARE_CLAIM, {"columnNameOfCorruptRecord": "_text"}
    objects = F.when(F.col("value").startswith("{"), F.col("value"))
    # Parsed fields become columns, not a struct: Spark's pruning of nested fields loses those of a struct kept through several generators.
    typed = F.from_json(objects, f"id STRING, claims MAP<STRING, ARRAY<{claim}>>, _text STRING", marked)
    read = lines.select("value", F.inline(F.array(typed)).alias("_id", "_claims", "_bad"))
    keyed = F.coalesce(~F.array_contains(F.flatten(F.map_values("_claims")).getField("id"), ""), F.lit(False))
    fits = F.coalesce(F.col("value").startswith("{"), F.lit(False)) & F.col("_bad").isNull()
    read = once(read, whole=fits & (F.col("_claims").isNull() | keyed)).drop("_bad")
    rest = F.from_json(F.when(~F.col("whole"), F.col("value")), "id STRING, claims MAP<STRING, STRING>, _text STRING", marked)
    read = read.select("_id", "_claims", "whole", F.inline(F.array(rest)).alias("_raw_id", "_raws", "_bad"))
    good = ~F.coalesce(F.col("_bad").isNotNull() & F.try_parse_json("_bad").isNull(), F.lit(False))
    raws = F.map_values(F.when(good, F.col("_raws")))

    def parsed(raw: Column) -> Column:
        return F.coalesce(F.from_json(raw, f"ARRAY<{claim}>"), F.transform(F.from_json(raw, "ARRAY<STRING>"), lambda r: F.from_json(r, claim)))

    whole = lambda x, y: F.when(F.col("whole"), x).otherwise(y)
    properties, subject = whole(F.map_keys("_claims"), F.map_keys("_raws")), whole(F.col("_id"), F.col("_raw_id"))
    texts = F.when(~F.col("whole"), F.transform(raws, lambda raw: F.from_json(raw, "ARRAY<STRING>")))
    lists = once(read, lists=whole(F.map_values("_claims"), F.transform(raws, parsed)), texts=texts)
    per_property = lists.select(subject.alias("ID_WIKIDATA"), properties.alias("_p"), "texts", F.posexplode("lists").alias("_i", "_list"))
    per_property = per_property.select("ID_WIKIDATA", F.get("_p", F.col("_i")).alias("ID_PROPERTY"), F.get("texts", F.col("_i")).alias("t"), "_list")
    flat = per_property.select("ID_WIKIDATA", "ID_PROPERTY", "t", F.posexplode("_list").alias("pos", "c"))
    return _claim_rows(flat.withColumn("raw", F.get("t", F.col("pos"))), exact_ids, qualifiers)


def naming(lines: DataFrame, kind: str) -> DataFrame:
    """Dump lines that can hold a value of the local type ``kind``, for readers of one typed table.

    Of the others only the text is read. A line may be kept in vain, but none is lost: a datatype stands in the text as
    it is, or with some of its ASCII characters escaped as four hex digits.
    """
    words = [name for name, local in LOCAL_TYPE.items() if local == kind]
    return lines.filter(reduce(Column.__or__, [F.col("value").contains(word) for word in [*words, r"\u00"]]))


def _claim_rows(claim: DataFrame, exact_ids: bool, qualifiers: bool) -> DataFrame:
    fallback = ident.canonical_json(F.when(F.coalesce(F.col("c.id"), F.lit("")) == "", F.col("raw")), exact_ids)
    return claim.select(
        "ID_WIKIDATA",
        "ID_PROPERTY",
        ident.statement_id(F.col("c.id"), F.col("ID_WIKIDATA"), F.col("ID_PROPERTY"), fallback).alias("ID_STATEMENT"),
        F.col("c.id").alias("STATEMENT_GUID"),
        F.col("c.rank").alias("RANK"),
        F.col("c.mainsnak").alias("snak"),
        *([F.col("c.qualifiers").alias("qualifiers")] if qualifiers else []),
    )


def local_type(datatype: Column) -> Column:
    """Local value type of a dump datatype, NULL for the unsupported ones."""
    out = None
    for name, local in LOCAL_TYPE.items():
        out = F.when(datatype == name, local) if out is None else out.when(datatype == name, local)
    return out


def snak_value(snak: Column) -> Column:
    """The value of a snak; 'somevalue' and 'novalue' have none."""
    return F.when(snak.getField("snaktype") == "value", snak.getField("datavalue").getField("value"))


def item_value(value: Column) -> Column:
    ident_ = F.try_variant_get(value, "$.id", "variant")
    is_text = F.schema_of_variant(ident_) == "STRING"
    return F.nullif(F.when(is_text, F.try_variant_get(value, "$.id", "string")), F.lit(""))


def text_value(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def time_value(value: Column, raw: Column | None = None, read: Column | None = None) -> Column:
    """Raw text, its declared precision, and signed year, month, day read from it.

    ``raw`` and ``read`` are the text and ``date_read`` of it, where the caller has them already.
    """
    raw = F.try_variant_get(value, "$.time", "string") if raw is None else raw
    return F.struct(
        raw.alias("RAW_TIME_VALUE"),
        F.try_variant_get(value, "$.precision", "int").alias("TIME_PRECISION"),
        F.try_variant_get(value, "$.calendarmodel", "string").alias("CALENDAR_MODEL"),
        F.try_variant_get(value, "$.timezone", "int").alias("TIMEZONE_OFFSET"),
        *date_parts(raw, read),
    )


def date_read(raw: Column) -> Column:
    """Year, month, day and so on as an array of texts, the sign left out."""
    return F.split(F.regexp_replace(F.substring_index(raw, "T", 1), r"^[+-]+", ""), "-")


def date_parts(raw: Column, read: Column | None = None) -> list[Column]:
    """Signed year, month and day of a time text.

    Parts are read left to right; the first unreadable one ends the reading and
    those before it stay. A year beyond 64 bits becomes NULL, months and days do not.
    """
    parts = date_read(raw) if read is None else read
    sign = F.when(raw.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    at = lambda i: F.get(parts, F.lit(i))
    readable = lambda i: at(i).isNull() | (at(i) == "") | at(i).rlike(r"^[0-9]+$")
    number = lambda i: F.nullif(at(i), F.lit(""))
    return [
        F.when(readable(0), F.concat(sign, number(0)).try_cast("bigint")).alias("YEAR_VALUE"),
        F.when(readable(0) & readable(1), number(1).try_cast("int")).alias("MONTH_VALUE"),
        F.when(readable(0) & readable(1) & readable(2), number(2).try_cast("int")).alias("DAY_VALUE"),
    ]


def quantity_read(value: Column) -> Column:
    """Texts of a quantity's fields, found in one walk over the value."""
    return F.try_variant_get(value, "$", "STRUCT<amount STRING, unit STRING, lowerBound STRING, upperBound STRING>")


def quantity_value(read: Column) -> Column:
    """Amount, unit and bounds from the texts of ``quantity_read``."""
    number = lambda name: read.getField(name).try_cast("decimal(30,10)")
    unit = F.nullif(read.getField("unit"), F.lit(""))
    return F.struct(
        number("amount").alias("AMOUNT"),
        F.substring_index(unit, "/", -1).alias("UNIT_ID_WIKIDATA"),
        number("lowerBound").alias("LOWER_BOUND"),
        number("upperBound").alias("UPPER_BOUND"),
    )


def _with_value(rows: DataFrame) -> DataFrame:
    """Add VALUE_TYPE and the value struct ``v``; drop rows without a usable value."""
    typed = (
        rows.withColumn("WIKIDATA_DATATYPE", F.col("snak.datatype"))
        .withColumn("VALUE_TYPE", local_type(F.col("snak.datatype")))
        .filter(F.col("VALUE_TYPE").isNotNull())
    )
    kind, value, lead = F.col("VALUE_TYPE"), F.col("value"), F.col("lead")
    measure = F.when(kind == "quantity", quantity_read(snak_value(F.col("snak"))))
    typed = once(typed, value=snak_value(F.col("snak")), measure=measure).drop("snak")
    # What a kind is read from. One step a kind: a step of all kinds is too long a method for the JVM to compile.
    leading = F.when(kind == "item", item_value(value)).when(kind == "time", F.try_variant_get(value, "$.time", "string"))
    leading = leading.when(kind == "quantity", F.col("measure.amount")).otherwise(text_value(value))
    typed = once(typed, lead=leading)
    # An empty object counts as no value for times and quantities; one with a time or an amount is not empty.
    shape = F.schema_of_variant(value)
    present = lead.isNotNull() | (shape.startswith("OBJECT<") & (shape != "OBJECT<>"))
    timed = once(typed, read=F.when(kind == "time", date_read(lead)))
    timed = once(timed, TIME=F.when((kind == "time") & present, time_value(value, lead, F.col("read")))).drop("read")
    measured = once(timed, QUANTITY=F.when((kind == "quantity") & present, quantity_value(F.col("measure")))).drop("measure")
    v = F.struct(
        F.when(kind == "item", lead).alias("ID_ITEM"),
        F.when(kind.isin("string", "external_id", "media"), lead).alias("TEXT"),
        "TIME",
        "QUANTITY",
    )
    kept = F.col("v.ID_ITEM").isNotNull() | F.col("v.TEXT").isNotNull() | F.col("v.TIME").isNotNull() | F.col("v.QUANTITY").isNotNull()
    return once(measured, v=v).drop("value", "lead", "TIME", "QUANTITY").filter(kept)


def statements(claims: DataFrame) -> DataFrame:
    """Statements with their typed value in one wide row (struct ``v``)."""
    return _with_value(claims).withColumn("DELETED", F.lit(0))


def qualifiers(stmts: DataFrame, exact_ids: bool = True) -> DataFrame:
    """Qualifier rows of the kept statements, with ids, 1-based order and value."""
    per_property = stmts.filter(F.col("qualifiers").isNotNull()).select(
        "ID_STATEMENT", F.explode("qualifiers").alias("ID_QUALIFIER_PROPERTY", "list")
    )
    snaks = _exploded(per_property, _SNAK, "hash", "snak")
    no_hash = F.coalesce(F.col("snak.hash"), F.lit("")) == ""
    key = F.coalesce(F.nullif(F.col("snak.hash"), F.lit("")), ident.canonical_json(F.when(no_hash, F.col("raw")), exact_ids))
    ids = snaks.select(
        "ID_STATEMENT",
        "ID_QUALIFIER_PROPERTY",
        ident.qualifier_hash(F.col("ID_STATEMENT"), F.col("ID_QUALIFIER_PROPERTY"), key).alias("QUALIFIER_HASH"),
        (F.col("pos") + 1).alias("DISPLAY_ORDER"),
        "snak",
    )
    return (
        _with_value(ids)
        .withColumn("ID_STATEMENT_QUALIFIER", ident.stable_bigint(F.col("QUALIFIER_HASH")))
        .withColumn("DELETED", F.lit(0))
    )


def cached_claims(entities: DataFrame, exact_ids: bool = True) -> DataFrame:
    """The few class and date facts kept for label-only entities; no qualifiers."""
    claims = explode_claims(entities, CACHED_PROPERTIES, exact_ids, qualifiers=False)
    return statements(claims).filter(F.col("VALUE_TYPE").isin(*CACHED_TYPES))


def value_table(rows: DataFrame, kind: str, key: str = "ID_STATEMENT") -> DataFrame:
    """Rows of one typed value table."""
    columns = [F.expr(sql).alias(name) for name, sql in VALUE_COLUMNS[kind].items()]
    return rows.filter(F.col("VALUE_TYPE") == kind).select(key, *columns)


def value_tables(rows: DataFrame, key: str = "ID_STATEMENT") -> dict[str, DataFrame]:
    """All six typed tables; write ``rows`` once (see ``session.cut``) before fanning out."""
    return {kind: value_table(rows, kind, key) for kind in VALUE_COLUMNS}


def statement_values(parents: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Every live statement with whichever typed value it has, for display.

    The six tables are stacked first and joined once: one shuffle of the parents
    instead of six left joins over them.
    """
    display = {
        "item": "ID_ITEM",
        "string": "VALUE_STRING",
        "external_id": "VALUE_EXTERNAL_ID",
        "media": "FILE_NAME",
        "time": "RAW_TIME_VALUE",
        "quantity": "CAST(AMOUNT AS STRING)",
    }
    stacked = None
    for kind, table in tables.items():
        part = table.select("ID_STATEMENT", F.expr(display[kind]).alias("VALUE_TEXT"), F.lit(kind).alias("VALUE_TABLE"))
        stacked = part if stacked is None else stacked.union(part)
    live = parents.filter((F.coalesce("DELETED", F.lit(0)) == 0) & (F.col("RANK").isNull() | (F.col("RANK") != "deprecated")))
    return live.join(stacked, "ID_STATEMENT", "left")


def qualifiers_grouped(rows: DataFrame, page: int = 500) -> DataFrame:
    """Qualifiers pre-grouped per statement for display, in pages of bounded size.

    A page holds one property's snaks of one stretch of DISPLAY_ORDER, so no
    statement, however large, has to fit into a single array.
    """
    paged = rows.withColumn("PAGE", F.floor((F.col("DISPLAY_ORDER") - 1) / page).cast("int"))
    grouped = paged.groupBy("ID_STATEMENT", "ID_QUALIFIER_PROPERTY", "PAGE").agg(
        F.array_sort(F.collect_list(F.struct("DISPLAY_ORDER", "VALUE_TEXT"))).alias("q")
    )
    return grouped.select(
        "ID_STATEMENT", "ID_QUALIFIER_PROPERTY", "PAGE", F.col("q.VALUE_TEXT").alias("VALUES")
    )


def property_metadata(entities: DataFrame) -> DataFrame:
    """One row per property entity: datatype, value table and URL formatters."""
    from kgspark.sources.dump import in_language

    kind = local_type(F.col("datatype"))

    def first_text(pid: str) -> Column:
        raws = F.from_json(F.try_element_at("claims", F.lit(pid)), "ARRAY<STRING>")
        texts = F.transform(raws, lambda r: text_value(snak_value(F.from_json(r, _CLAIM).getField("mainsnak"))))
        return F.get(F.filter(texts, lambda t: t.isNotNull() & (t != "")), F.lit(0))

    return entities.filter(F.col("type") == "property").select(
        F.col("id").alias("ID_PROPERTY"),
        in_language(F.col("labels")).alias("PROPERTY_LABEL"),
        in_language(F.col("descriptions")).alias("PROPERTY_DESCRIPTION"),
        F.col("datatype").alias("WIKIDATA_DATATYPE"),
        kind.alias("LOCAL_VALUE_TYPE"),
        F.concat(F.upper(kind), F.lit("_VALUE")).alias("EXPECTED_CHILD_TABLE"),
        first_text("P1630").alias("FORMATTER_URL"),
        first_text("P3303").alias("FORMATTER_URI_FOR_RDF"),
        F.when(kind.isNotNull(), 1).otherwise(0).alias("IS_SUPPORTED"),
        F.lit(1).alias("IS_ACTIVE"),
    )
