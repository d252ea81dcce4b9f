"""Claims read straight from dump lines: the same rows as by raw texts, in one parse of a line."""

import json

import pytest

import __spark_entry__ as entry
from kgspark.operators import claims
from kgspark.sources import dump

SMALL = "/root/testdata/sf0.001"


def snak(value, datatype="wikibase-item", **more):
    return {"snaktype": "value", "datatype": datatype, "hash": "h", "datavalue": {"value": value}} | more


def claim(id_, value, datatype="wikibase-item", **more):
    return {"id": id_, "rank": "normal", "mainsnak": snak(value, datatype), "qualifiers": {"P1": [snak("q", "string")], "P2": [{"snaktype": "value"}]}} | more


def line(id_, properties, **more):
    return json.dumps({"type": "item", "id": id_, "claims": properties} | more)


TIME = {"time": "+2001-02-03T00:00:00Z", "precision": 11}
AMOUNT = {"amount": "+1.50", "unit": "http://x/Q7"}
ODD = [
    line("Q1", {"P1": [claim("a", {"id": "Q5"}), claim("b", TIME, "time")], "P2": [claim("c", AMOUNT, "quantity")]}),
    line("Q2", {"P1": [claim("d", "text", "string"), claim("", {"id": "Q6"}), claim(None, {"id": "Q7", "n": 10})], "P2": [claim("e", {"id": 5})]}),
    line("Q3", {"P1": "not a list", "P2": [claim("f", {"id": "Q8"})], "P3": None, "P4": [None, 7, claim("g", "x", "commonsMedia")], "P5": {"id": "h"}}),
    line("Q4", {"P1": [claim("i", {"id": "Q9"}, qualifiers="none"), claim("j", {"id": "Q9"}, mainsnak=3), claim("k", {}, "time"), claim("l", [], "quantity")]}),
    line("Q5", {}), line("Q6", []), line("Q7", None), line(["Q8"], {"P1": [claim("m", {"id": "Q1"})]}), line(9, {"P1": [claim(10, {"id": "Q1"})]}),
    line("Q10", {"P1": json.dumps([claim("n", {"id": "Q2"})]), "P2": [claim("o", "eé", "external-id", rank=5)]}, labels={"en": 3}),
    '{"id":"Q11","claims":{"P1":[{"id":"p","mainsnak":{"snaktype":"value","datatype":"string","datavalue":{"value":"1"}}}],"P1":[{"id":"q"}]}}',
    "{broken", '{"id":"Q12","claims":{"P1":[{"id":"r"', "[]", "null", '"text"', "5", line("Q13", {"P1": []}), '[{"id":"Q14","claims":{"P1":[{"id":"s"}]}}]', ' {"id":"Q15"}',
]


def odd(spark):
    return spark.createDataFrame([(r,) for r in [*ODD, None]], "value string")


def rows(df):
    return sorted(map(str, df.selectExpr(*[f"to_json({c})" if c == "v" else c for c in df.columns if c != "snak"]).collect()))


@pytest.mark.parametrize("qualifiers", [True, False])
@pytest.mark.parametrize("exact_ids", [True, False])
def test_odd_lines_give_the_claims_of_the_raw_texts(spark, exact_ids, qualifiers):
    good, _ = dump.parse_entities(odd(spark), ("id", "type", "claims"))
    want = claims.explode_claims(good, None, exact_ids, qualifiers)
    got = claims.read_claims(odd(spark), exact_ids, qualifiers)
    assert got.columns == want.columns and got.count() >= 15
    assert rows(got) == rows(want)
    assert rows(claims.statements(got)) == rows(claims.statements(want))


@pytest.mark.parametrize("name", ["item_values", "quantity_units", "claims_exploded"])
def test_claims_are_read_by_one_parse(spark, name):
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    assert "StructField(claims,MapType(StringType,ArrayType" in entry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_joined_values_of_lines_still_run(spark):
    """Of claims kept as a field of a struct, pruning lost the id in this query."""
    assert entry.queries()["award_count_by_family_from_dump"](spark, SMALL).count() == 106
