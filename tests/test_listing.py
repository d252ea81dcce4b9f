"""Lists of catalogue answers: read by one parse, placed inside their document, whatever does not fit by the raw texts."""

import json

import pytest

import __spark_entry__ as entry
from kgspark.plans import snapshots as sn

SMALL = "/root/testdata/sf0.001"
SCHEMA = "entity string, id long, endpoint string, lang string, fetched_at string, payload string"


def answers(spark, *texts, entity="movie", endpoint="details"):
    return spark.createDataFrame([(entity, i, endpoint, "en", "2024", t) for i, t in enumerate(texts, 1)], SCHEMA)


def plan(spark, name, kind="executedPlan"):
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    return getattr(entry.queries()[name](spark, SMALL)._jdf.queryExecution(), kind)().toString()


def test_credits_are_placed_inside_their_document(spark):
    text = plan(spark, "title_credits")
    assert "Window" not in text and "Sort" not in text and text.count("Exchange") == 1


def places(rows):
    """What one list's places are by definition: the first place of each person; none without a person."""
    ids = [r["id"] for r in rows]
    return [None if i is None else ids.index(i) + 1 for i in ids]


@pytest.mark.parametrize("entity", ["movie", "serie"])
def test_places_of_few_and_of_many_persons(spark, entity):
    def people(n, persons, name):
        return [{"id": None if i % 11 == 5 else i * 7 % persons, "credit_id": f"{name}{i}", "job": "J", "department": "D", "character": "x"} for i in range(n)]

    docs = [{"credits": {"cast": people(n, m, "a"), "crew": people(k, m, "b")}} for n, m, k in ((0, 1, 3), (9, 4, 5), (64, 64, 1), (90, 65, 80), (200, 150, 0), (300, 2, 300))]
    out = sn.title_credits(answers(spark, *map(json.dumps, docs), entity=entity), entity).collect()
    got = {(r[0], r.ID_CREDIT): (r.ID_PERSON, r.CREDIT_TYPE, r.DISPLAY_ORDER) for r in out}
    want = {}
    for i, doc in enumerate(docs, 1):
        for kind, rows in doc["credits"].items():
            want |= {(i, r["credit_id"]): (r["id"], kind, at) for r, at in zip(rows, places(rows))}
    assert len(out) == len(want) and got == want


def test_makers_are_placed_alike_by_look_up_and_by_sorting(spark, monkeypatch):
    crew = [{"id": i % 50, "credit_id": f"b{i}", "job": "J", "department": "D"} for i in range(70)]
    makers = [{"id": i, "credit_id": f"m{i}"} for i in (7, 49, 300, 7, 60, 301)]
    doc = json.dumps({"credits": {"cast": [{"id": i, "credit_id": f"a{i}"} for i in range(40, 64)], "crew": crew}, "created_by": makers})
    few = sorted(map(str, sn.title_credits(answers(spark, doc, entity="serie"), "serie").collect()))
    monkeypatch.setattr(sn, "FEW_PERSONS", 0)
    assert sorted(map(str, sn.title_credits(answers(spark, doc, entity="serie"), "serie").collect())) == few
    assert any("ID_CREDIT='m300'" in r and "DISPLAY_ORDER=21" in r for r in few)


ODD = (
    '{"L":[{"id":1,"name":"a"},{"id":2}]}', '{"L":[]}', '{"L":null}', "{}", '{"status_code":34,"L":[{"id":1}]}', '{"status_code":"1","L":[{"id":1}]}', '{"status_code":{},"L":[{"id":3}]}',
    '{"L":"[{\\"id\\":4}]"}', '{"L":{"id":5}}', '{"L":[{"id":"x","name":"b"},{"id":6,"name":"c"}]}', '{"L":[{"id":7,"name":{"z":[1.50]}}],"other":[[',
    '{"L":[{"id":8}],"other":"\\q"}', '{"L":[{"id":9}]} rest', ' {"L":[{"id":10}]}', '[{"L":[{"id":11}]}]', '[]', "null", "", None, "no json", '{"L":[null,{"id":12},3]}', '{"L":5}',
)


def listed(sn_rows):
    return sorted(map(str, sn_rows.collect()))


def both(spark, key, endpoint, read):
    """Rows of odd answers by the one parse, and by raw texts of all fields."""
    docs = answers(spark, *[t and t.replace('"L"', f'"{key}"') for t in ODD], endpoint=endpoint)
    return listed(read(docs)), listed(read(sn.with_fields(docs)))


def test_odd_credits_are_read_as_by_raw_texts(spark):
    texts = [t and t.replace('"L":', '"credits":{"crew":[{"id":99}],"cast":') .replace("]}", "]}}", 1) for t in ODD]
    docs = answers(spark, *texts, *ODD)
    assert listed(sn.title_credits(docs)) == listed(sn.title_credits(sn.with_fields(docs)))


def test_odd_keyword_and_neighbour_lists_are_read_as_by_raw_texts(spark):
    got, want = both(spark, "keywords", "keywords", lambda docs: sn.keywords(docs, "movie"))
    assert got == want and len(got) >= 8
    got, want = both(spark, "results", "similar", lambda docs: sn.neighbours(docs, "movie", "similar"))
    assert got == want and len(got) >= 8


@pytest.mark.parametrize("name, key", [("keyword_links", "keywords"), ("neighbour_links", "results")])
def test_links_are_read_by_one_parse(spark, name, key):
    assert f"StructField({key},ArrayType" in plan(spark, name, "optimizedPlan")


def test_odd_relations_are_read_as_by_raw_texts(spark):
    got, want = both(spark, "genres", "details", lambda docs: sn.title_relations(docs, "movie", "GENRE"))
    assert got == want and len(got) >= 8


def test_relations_are_read_by_one_parse(spark):
    assert "StructField(production_countries,ArrayType" in plan(spark, "title_relations", "optimizedPlan")
