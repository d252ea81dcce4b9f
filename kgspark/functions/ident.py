"""Deterministic keys: the same input text gives the same id in every run."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Number forms whose JSON text depends on the writer: fractions, exponents, minus zero, whole numbers past 38 digits.
_WRITER_DEPENDENT_NUMBER = r"[0-9][.eE]|-0|[0-9]{39}"


def stable_bigint(text: Column) -> Column:
    """First 8 bytes of SHA-256, big-endian, sign bit cleared, 0 mapped to 1."""
    digest = F.sha2(text, 256)
    first = F.translate(F.substring(digest, 1, 1), "89abcdef", "01234567")
    number = F.conv(F.concat(first, F.substring(digest, 2, 15)), 16, 10).cast("bigint")
    return F.greatest(number, F.lit(1).cast("bigint"))


@F.pandas_udf(StringType())
def _canonical_json_python(texts: pd.Series) -> pd.Series:
    def canonical(text):
        if text is None:
            return None
        try:
            return json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        except ValueError:  # no JSON, or a number too long to read: the text is its own identity
            return text

    return texts.map(canonical, na_action="ignore")


def canonical_json(text: Column, any_number: bool = True) -> Column:
    """Sorted keys, no blanks, non-ASCII kept.

    A VARIANT stores object fields sorted by name, so the round trip through it is
    the canonical form. Texts with other numbers, and those a VARIANT refuses (a
    repeated key: the last one counts), go to the Python writer, whose format is the
    contract; ``any_number=False`` leaves that branch out of the plan for inputs known
    to hold plain whole numbers. A text is never without an identity: what no writer
    reads stands for itself.
    """
    sorted_text = F.to_json(F.try_parse_json(text))
    if not any_number:
        return F.coalesce(sorted_text, text)
    exotic = text.rlike(_WRITER_DEPENDENT_NUMBER) | sorted_text.isNull()
    return F.when(exotic, _canonical_json_python(F.when(exotic, text))).otherwise(sorted_text)


def statement_id(guid: Column, subject: Column, prop: Column, claim_json: Column | None = None) -> Column:
    """Id of a statement: its GUID, else subject, property and canonical claim."""
    identity = guid
    if claim_json is not None:
        identity = F.coalesce(F.nullif(guid, F.lit("")), F.concat_ws("|", subject, prop, claim_json))
    return stable_bigint(F.concat(F.lit("statement|"), identity))


def qualifier_hash(statement: Column, prop: Column, occurrence: Column) -> Column:
    """Occurrence identity of a qualifier; its position takes no part in it."""
    return F.concat_ws("|", F.lit("qualifier"), statement.cast("string"), prop, occurrence)


def qualifier_id(statement: Column, prop: Column, occurrence: Column) -> Column:
    return stable_bigint(qualifier_hash(statement, prop, occurrence))
