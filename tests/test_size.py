"""What grows with the data must not go through the driver, nor wide rows through avoidable shuffles."""

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["repair_qualifier_ids", "v1_replace_multi_values", "merged_episode_credits"])
def test_growing_join_sides_are_not_broadcast(spark, name):
    text = plan(spark, name)
    assert "Broadcast" not in text
    assert "SortMergeJoin" in text


def test_images_meet_their_main_images_unsorted(spark):
    text = plan(spark, "images")
    assert "ShuffledHashJoin" in text
    assert "SortMergeJoin" not in text and "Broadcast" not in text


def test_neighbour_answers_hold_their_own_list_only(spark):
    from kgspark.sources.driver import Driver

    row = Driver(spark, SMALL).movie_answer("similar").selectExpr("endpoint", "json_object_keys(payload) AS k").first()
    assert row.endpoint == "similar" and row.k == ["id", "results"]


def payloads(spark, *rows):
    schema = "entity string, id long, endpoint string, lang string, fetched_at string, payload string"
    return spark.createDataFrame([("movie", i, e, lang, at, text) for i, e, lang, at, text in rows], schema)


def usable(spark, *rows):
    from pyspark.sql import functions as F

    from kgspark.plans import snapshots

    ledger = spark.createDataFrame([("movie", 9, "2030-01-01")], "ENTITY_TYPE string, ID_ENTITY long, TIM_RETRY_AFTER string")
    return snapshots.usable(payloads(spark, *rows), "movie", ledger, F.lit("2024-01-01")).collect()


def test_newest_answers_are_found_by_narrow_heads(spark):
    gone = '{"status_code":34}'
    got = usable(
        spark,
        (1, "details", "en", "1", '{"a":1}'), (1, "details", "en", "2", '{"a":2}'), (1, "details", "en", "2", '{"a":3}'), (1, "details", "en", "2", '{"a":3}'),
        (1, "images", None, "1", '{"a":4}'), (1, "images", None, None, '{"a":5}'), (1, "release_dates", "en", "1", '{"a":6}'),
        (2, "details", "en", "1", '{"a":1}'), (2, "details", "en", "2", gone),
        (3, "details", "en", "2", gone), (3, "details", "fr", "2", '{"a":1}'),  # '{"s' is after '{"a': gone
        (4, "details", "en", "2", gone), (4, "details", "fr", "2", '{"z":1}'),
        (5, "images", "en", "1", '{"a":1}'), (None, "details", "en", "1", '{"a":1}'), (9, "details", "en", "1", '{"a":1}'),
    )
    seen = sorted((r.id, r.endpoint, str(r.lang), str(r.m)) for r in got)
    assert seen == [
        (1, "details", "en", "{'a': '3'}"), (1, "images", "None", "{'a': '4'}"), (1, "release_dates", "en", "{'a': '6'}"),
        (4, "details", "en", "{'status_code': '34'}"), (4, "details", "fr", "{'z': '1'}"),
    ]
    assert {r.endpoint for r in got if r.payload is not None} == {"release_dates"}  # the text is not written beside its fields


def test_unwanted_lines_are_dropped_before_they_move(spark):
    from kgspark.sources import dump

    keyed = spark.range(20000).selectExpr("concat('Q', id) AS _id", "'text' AS value")
    wanted = keyed.filter("_id LIKE '%7'").select("_id")
    maybe = {r._id for r in dump._maybe_wanted(keyed, wanted).collect()}
    assert maybe >= {f"Q{i}" for i in range(7, 20000, 10)} and len(maybe) < 2100
    assert dump._maybe_wanted(keyed, wanted.limit(0)).count() == 0
    assert "ShuffledHashJoin" in plan(spark, "idgate")


@pytest.mark.parametrize("name", ["statements_flat", "item_values", "time_values", "quantity_values", "qualifiers_flat"])
def test_value_reading_is_compiled(spark, name):
    """The JVM interprets methods of 8,000 bytes and more."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = entry.queries()[name](spark, SMALL)._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())) < 8000


@pytest.mark.parametrize("name", ["claims_exploded", "statements_flat", "quantity_units", "award_count_by_family_from_dump"])
def test_qualifiers_nobody_reads_are_not_copied(spark, name):
    assert "qualifiers,MapType" not in logical(spark, name)


def test_run_summary_parses_a_line_once(spark):
    assert logical(spark, "run_summary").count("from_json(") == 1


def test_subclass_edges_parse_a_list_once(spark):
    text = logical(spark, "subclass_edges")
    assert text.count("StructField(mainsnak") <= 2 * 2  # as a whole, or claim by claim, of either property of the query


def logical(spark, name):
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    return entry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_lines_lose_every_blank_around_objects(spark):
    from kgspark.sources import dump

    rows = ["[", " [ {a}", "\t{b} ,\r\n", "{c}  ]\x0b", "  ", "{d\u00e9} \t,  ", "{e}, ]", "]", "[{f},", ",", None, "{g \u00e9 },,", "{h}\u00a0"]
    out = [r.value for r in dump.clean_lines(spark.createDataFrame([(r,) for r in rows], "value string")).collect()]
    assert out == ["{a}", "{b}", "{c}", "{d\u00e9}", "{e}", "{f}", "{g \u00e9 },", "{h}\u00a0"]


@pytest.mark.parametrize("name", ["prune_cascade", "qualifier_value_tables_load"])
def test_tables_read_by_several_steps_are_written_once(spark, name):
    assert "l_shipdate" not in logical(spark, name)


def test_type_flips_are_not_broadcast(spark):
    from kgspark.operators import merge

    rows = spark.range(10).selectExpr("id AS ID_STATEMENT", "'item' AS VALUE_TYPE")
    assert "Broadcast" not in merge.purge_type_flips(rows, rows, "time")._jdf.queryExecution().executedPlan().toString()


def test_written_answers_are_read_few_at_a_time(spark):
    """Columns are read up to 4,096 rows at once, but not beyond a row group; an answer may hold megabytes."""
    import duckdb
    from pyspark.sql import functions as F

    from kgspark.plans import snapshots
    from kgspark.session import FEW_ROWS

    rows = spark.range(3000).selectExpr("'movie' AS entity", "id", "'details' AS endpoint", "'en' AS lang", "'2024' AS fetched_at", "'{\"title\":\"t\"}' AS payload")
    ledger = spark.createDataFrame([], "ENTITY_TYPE string, ID_ENTITY long, TIM_RETRY_AFTER string")
    files = [f.removeprefix("file://") for f in snapshots.usable(rows, "movie", ledger, F.lit("2024-01-01")).inputFiles()]
    groups = duckdb.sql(f"SELECT DISTINCT file_name, row_group_id, row_group_num_rows FROM parquet_metadata({files})").fetchall()
    assert sum(g[2] for g in groups) == 3000 and max(g[2] for g in groups) <= FEW_ROWS
