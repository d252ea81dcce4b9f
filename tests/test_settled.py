"""What becomes of stored rows after an answer, and the cost of long credit lists."""

import json
import time

from pyspark.sql import functions as F

from kgspark.operators.settle import OUTCOMES, Rule, one_outcome, settle, settle_table
from kgspark.plans import settled
from kgspark.plans import snapshots as sn

T = "o long, k string, n int, note string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def told(spark, *data):
    return spark.createDataFrame([("t", o, None, x) for o, x in data], OUTCOMES)


def frames(spark):
    stored = spark.createDataFrame([(o, k, 1, "old") for o in (1, 2, 3, 4, 5, None) for k in ("a", "b")], T)
    fresh = spark.createDataFrame([(1, "b", 2), (1, "c", 2), (2, "x", 2), (3, "x", 2), (4, "x", 2), (6, "n", 2)], "o long, k string, n int")
    outcomes = told(spark, (1, "filled"), (2, "empty"), (3, "malformed"), (4, "failed"), (6, "filled"))
    return stored, fresh, outcomes.drop("TABLE_NAME")


def test_four_outcomes_under_every_rule(spark):
    stored, fresh, outcomes = frames(spark)
    left = [(o, k, 1, "old") for o in (3, 4, 5, None) for k in ("a", "b")]
    prune = left + [(1, "b", 2, "old"), (1, "c", 2, None), (6, "n", 2, None)]
    two = [(2, "a", 1, "old"), (2, "b", 1, "old")]
    check = lambda rule, want: rows(settle_table(stored, fresh, outcomes, rule)) == sorted(want, key=str)
    assert check(Rule(("o",), ("k",)), prune)
    assert check(Rule(("o",), ("k",), "keep"), prune + two)
    assert check(Rule(("o",), ("k",), mode="merge"), prune + two + [(1, "a", 1, "old")])
    whole = left + [(1, "b", 2, None), (1, "c", 2, None), (6, "n", 2, None)]
    assert check(Rule(("o",)), whole) and check(Rule(("o",), on_empty="keep"), whole + two)


def test_settling_twice_equals_once(spark):
    stored, fresh, outcomes = frames(spark)
    for rule in (Rule(("o",), ("k",)), Rule(("o",)), Rule(("o",), ("k",), mode="merge")):
        once = settle_table(stored, fresh, outcomes, rule)
        assert rows(settle_table(once, fresh, outcomes, rule)) == rows(once)


def test_scopes_within_an_owner_and_conflicting_answers(spark):
    stored = spark.createDataFrame([(1, "en", "a"), (1, "fr", "a"), (2, "en", "a")], "o long, lang string, k string")
    fresh = stored.limit(0)
    outcomes = spark.createDataFrame([("t", 1, "en", "empty"), ("t", 2, "en", "failed"), ("t", 2, "en", "empty"), ("u", 1, "fr", "empty")], OUTCOMES)
    out = settle({"t": stored}, {"t": fresh}, one_outcome(outcomes), {"t": Rule(("o", "lang"), ("k",)), "absent": Rule(("o",))})
    assert rows(out["t"]) == [(1, "fr", "a"), (2, "en", "a")] and set(out) == {"t"}


def test_main_images_keep_an_empty_owner_filled(spark):
    payload = spark.createDataFrame([("movie", i, "images", "en", "2024", '{"posters":[]}') for i in (1, 2)], "entity string, id long, endpoint string, lang string, fetched_at string, payload string")
    main = spark.createDataFrame([(1, "/base", [])], "id long, base string, local array<struct<path:string,lang:string>>")
    got = {r.ID_OWNER: r.OUTCOME for r in settled.outcomes(sn.with_fields(payload), "movie", main).collect()}
    assert got == {1: "filled", 2: "empty"}


def credits(spark, n, people):
    cast = [{"id": i % people, "credit_id": f"c{i}", "character": "x", "order": i} for i in range(n)]
    body = json.dumps({"credits": {"cast": cast, "crew": [{"id": 7, "credit_id": "w", "job": "J", "department": "D"}] * 2}, "created_by": [{"id": 7, "credit_id": "m"}, {"id": -1, "credit_id": "z"}]})
    return spark.createDataFrame([("serie", 1, "details", "en", "2024", body)], "entity string, id long, endpoint string, lang string, fetched_at string, payload string").cache()


def test_long_credit_lists_take_time_in_proportion(spark):
    took = {}
    for n in (2_000, 20_000, 2_000, 20_000):  # the second time code is compiled
        docs = credits(spark, n, n // 2)
        docs.count()
        began = time.time()
        out = sn.title_credits(docs, "serie").groupBy("CREDIT_TYPE", "CREW_JOB").agg(F.count("*").alias("n"), F.max("DISPLAY_ORDER").alias("top")).collect()
        took[n] = time.time() - began
        got = {(r.CREDIT_TYPE, r.CREW_JOB): (r.n, r.top) for r in out}
        assert got == {("cast", ""): (n, n // 2), ("crew", "J"): (2, 2), ("crew", "Creator"): (2, 3)}
    assert took[20_000] < 10 * max(took[2_000], 0.3)
