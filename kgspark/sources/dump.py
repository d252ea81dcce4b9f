"""Entity dumps: one JSON object per line inside a (compressed) JSON array."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.functions import once

# Claims stay raw text per property, so a property filter applies before its list is
# parsed and one malformed property cannot blank its neighbours.
ENTITY_FIELDS = {
    "id": "STRING",
    "type": "STRING",
    "datatype": "STRING",
    "labels": "MAP<STRING, VARIANT>",
    "descriptions": "MAP<STRING, VARIANT>",
    "claims": "MAP<STRING, STRING>",
}

# The entity's own id leads its line; a claim or snak id can never match here.
_TOP_LEVEL_ID = r'^\{"type":"(?:item|property)","id":"([A-Za-z][0-9]+)"'


def read_entity_dump(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the dump as ``value``; bz2 input is split across tasks by Spark."""
    return clean_lines(spark.read.text(path))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Drop the array's brackets, separators and blank lines around the objects.

    Whether a line has something to drop is read from its first and last byte; only then is text copied. Trimming a set of
    characters, and counting them, reads a line character by character.
    """
    trimmed = once(lines.select(F.col("value").alias("_raw")), v=_without_end(_without_start(F.col("_raw"))))
    opened = F.when(F.col("v").startswith("["), _without_start(_bytes(F.col("v"), 2))).otherwise(F.col("v"))
    shorter = lambda x: _without_end(_bytes(x, 1, F.octet_length(x) - 1))
    closed = F.when(F.col("o").endswith("]"), shorter(F.col("o"))).otherwise(F.col("o"))
    alone = F.when(F.col("c").endswith(","), shorter(F.col("c"))).otherwise(F.col("c"))
    kept = once(once(trimmed, o=opened), c=closed)
    return once(kept, value=alone).select("value").filter(F.col("value") != "")


_BLANKS = " \t\n\r\x0b\f"


def _bytes(text: Column, start: int, length: Column | None = None) -> Column:
    length = F.octet_length(text) if length is None else length
    return F.substr(text.cast("binary"), F.lit(start), length).cast("string")


def _without_start(text: Column) -> Column:
    blank = reduce(Column.__or__, [text.startswith(b) for b in _BLANKS])
    return F.when(blank, F.ltrim(text, F.lit(_BLANKS))).otherwise(text)


def _without_end(text: Column) -> Column:
    """Spaces go from the end backwards; the other blanks need a look at the whole text, so only where one is left."""
    bare = F.rtrim(text)
    blank = reduce(Column.__or__, [bare.endswith(b) for b in _BLANKS[1:]])
    return F.when(blank, F.rtrim(text, F.lit(_BLANKS))).when(text.endswith(" "), bare).otherwise(text)


def top_level_id(line: Column) -> Column:
    """Entity id read from the raw text, NULL when the line does not start as expected."""
    return F.nullif(F.regexp_extract(line, _TOP_LEVEL_ID, 1), F.lit(""))


def idgate(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """Keep lines worth parsing: wanted items, all properties, unreadable starts.

    ``ids`` has one column of wanted ids. The key is cut out of the raw text. Lines that
    are not gated have no key and go round the join. Of the others, most unwanted ones are
    dropped by a bitmap of hashed ids before their text moves (16 MB at most, however many
    ids there are); the rest meet the ids in a semi join, hashed by id, so that text is
    not sorted.
    """
    wanted = ids.select(F.col(ids.columns[0]).alias("_id")).distinct()
    item_id = F.when(F.col("_top").startswith("Q"), F.col("_top"))
    keyed = once(lines.select("value"), _top=top_level_id(F.col("value"))).withColumn("_id", item_id)
    maybe = _maybe_wanted(keyed.filter(F.col("_id").isNotNull()), wanted)
    gated = maybe.join(wanted.hint("shuffle_hash"), "_id", "left_semi")
    return gated.select("value").union(keyed.filter(F.col("_id").isNull()).select("value"))


#: Bits of the id gate's bitmap; a stretch of 32,768 bits is one row of 4 KB.
GATE_BITS = 1 << 27


def _maybe_wanted(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lines whose ``_id`` hashes to a bit that some wanted id sets: all wanted ones, and few others."""
    place = F.pmod(F.xxhash64("_id"), F.lit(GATE_BITS)) + 1
    at, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bits = wanted.groupBy(at.alias("_at")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    met = lines.withColumns({"_at": at, "_bit": bit}).join(F.broadcast(bits), "_at")
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.filter(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*lines.columns)


def parse_marked(lines: DataFrame, fields: Sequence[str] = tuple(ENTITY_FIELDS)) -> DataFrame:
    """Parsed entities with ``BAD_LINE``: the text of a line no JSON parser accepts, else NULL.

    One frame for both, so that writing it once parses every line once.
    """
    schema = ", ".join([f"{f} {ENTITY_FIELDS[f]}" for f in fields] + ["_text STRING"])
    parsed = once(lines.select("value"), e=F.from_json("value", schema, {"columnNameOfCorruptRecord": "_text"}))
    bad = F.coalesce(F.col("e._text").isNotNull() & F.try_parse_json("e._text").isNull(), F.lit(False))
    return parsed.select("e.*", F.when(bad, F.col("value")).alias("BAD_LINE")).drop("_text")


def parse_entities(lines: DataFrame, fields: Sequence[str] = tuple(ENTITY_FIELDS)) -> tuple[DataFrame, DataFrame]:
    """(good, bad): parsed entities, and the lines no JSON parser accepts.

    One parse per line. The parser keeps the text of lines it could not read fully;
    only those are looked at again, since a field of an unexpected shape makes that
    field NULL but not the line bad. ``fields`` narrows what is parsed.
    """
    marked = parse_marked(lines, fields)
    return split_marked(marked)


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of ``parse_marked``."""
    good = marked.filter(F.col("BAD_LINE").isNull()).drop("BAD_LINE")
    return good, marked.filter(F.col("BAD_LINE").isNotNull()).select(F.col("BAD_LINE").alias("value"))


def text_of(payload: Column) -> Column:
    """``value`` of a label payload when it is a JSON string, else NULL."""
    value = F.try_variant_get(payload, "$.value", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(payload, "$.value", "string"))


def in_language(texts: Column, lang: str = "en") -> Column:
    return text_of(F.try_element_at(texts, F.lit(lang)))


def texts_map(texts: Column) -> Column:
    """{language: text}; entries that are no text are dropped, no map gives {}."""
    clean = F.map_filter(F.transform_values(texts, lambda _, p: text_of(p)), lambda _, t: t.isNotNull())
    return F.coalesce(clean, F.create_map().cast("map<string,string>"))


def entity_row(entities: DataFrame, *extra: str) -> DataFrame:
    """The base row every entity table shares."""
    return entities.select(
        F.col("id").alias("ID_WIKIDATA"),
        in_language(F.col("labels")).alias("LABEL_EN"),
        in_language(F.col("descriptions")).alias("DESCRIPTION_EN"),
        texts_map(F.col("labels")).alias("LABELS"),
        texts_map(F.col("descriptions")).alias("DESCRIPTIONS"),
        *extra,
    )
