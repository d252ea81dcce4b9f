"""Readers of one typed value table: lines that cannot hold such a value are not parsed, and no value is lost by that."""

import json

import pytest
from pyspark.sql import functions as F
from test_read_claims import AMOUNT, ODD, claim, line, odd, rows

import __spark_entry__ as entry
from kgspark.operators import claims
from kgspark.sources import dump

SMALL = "/root/testdata/sf0.001"
KINDS = ("item", "string", "external_id", "media", "time", "quantity")


def escaped(text, chars="q-Q"):
    """The text with some characters as JSON escapes of four hex digits."""
    return "".join(f"\\u{ord(x):04x}" if x in chars else x for x in text)


ESCAPED = [
    line("Q20", {"P1": [claim("a", AMOUNT, "quantity")]}).replace("quantity", escaped("quantity")),
    line("Q21", {"P1": [claim("b", {"id": "Q5"})]}).replace("wikibase-item", escaped("wikibase-item")),
    line("Q22", {"P1": [claim("c", AMOUNT, "quantity")]}).replace("quantity", escaped("quantity", "quantity").upper().replace("U", "u")),
    line("Q23", {"P1": json.dumps([claim("d", AMOUNT, "quantity")]).replace("quantity", escaped("quantity"))}),
    line("Q24", {"P1": [claim("e", AMOUNT, "quantity")]}).replace('"', "'"),
    line("Q25", {"P1": [claim("f", AMOUNT, "quantity")]}).replace('"datatype": ', '"datatyp' + escaped("e", "e") + '" : '),
    line("Q26", {"P1": [claim("g", AMOUNT, "Quantity"), claim("h", "quantity", "string")]}),
]


@pytest.mark.parametrize("kind", KINDS)
def test_no_value_is_lost_with_lines_that_do_not_name_its_datatype(spark, kind):
    def table(lines):
        return claims.value_table(claims.statements(claims.read_claims(dump.clean_lines(lines), qualifiers=False)), kind)

    every = odd(spark).union(spark.createDataFrame([(r,) for r in ESCAPED], "value string"))
    want = rows(table(every))
    assert rows(table(claims.naming(every, kind))) == want
    assert all(json.loads(x.replace("'", '"')) and ("quantity" in x) == (i > 2 and i != 3) for i, x in enumerate(ESCAPED))
    assert len(want) >= {"item": 6, "quantity": 6}.get(kind, 1)


def test_lines_without_a_quantity_are_not_parsed(spark):
    kept = {r.value for r in claims.naming(odd(spark), "quantity").collect()}
    assert ODD[0] in kept and ODD[1] not in kept
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    for name in ("quantity_units", "quantity_values"):
        assert "Contains(value" in entry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("field", ["amount", "unit", "lowerBound", "upperBound"])
def test_one_walk_reads_what_a_walk_a_field_reads(spark, field):
    odd_ones = [5, -1.5, "1e3", "", None, True, "x/Q1", "/", {"a": [1]}, [], ["+1"], 10**40, "+12345678901234567890.12345678901"]
    texts = [json.dumps({field: x, "other": 1, "Amount": "7"}) for x in odd_ones] + ["{}", "[]", "3", '"amount"', "null", '{"a":{"amount":"1","unit":"2"}}']
    values = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select(F.parse_json("t").alias("v"))
    got = values.select(claims.quantity_read(F.col("v")).getField(field).alias("one"), F.try_variant_get("v", f"$.{field}", "string").alias("each")).collect()
    assert len(got) == 20 and [r.one for r in got] == [r.each for r in got]
    assert any(r.one for r in got)


def test_a_quantity_is_walked_once(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    text = entry.queries()["quantity_units"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "$.amount" not in text and "$.unit" not in text and "$.lowerBound" not in text
