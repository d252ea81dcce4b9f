"""Write semantics: idempotence, staging, swap, repair, snapshots, streams."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from kgspark.functions.ident import stable_bigint
from kgspark.operators import checks, merge, ranking, scope
from kgspark.plans import refresh, reports
from kgspark.plans import snapshots as sn
from kgspark.sources import staging, tables
from kgspark.streaming import feeds


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_twice_equals_once(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, v string, w string")
    i = spark.createDataFrame([(2, None, "n"), (3, "c", "n"), (3, "d", "n")], "k int, v string, w string").withColumn("o", F.monotonically_increasing_id())
    once = merge.upsert(t, i, ["k"], {"w": "insert_only"}, order=["o"])
    twice = merge.upsert(once, i, ["k"], {"w": "insert_only"}, order=["o"])
    assert rows(once.fillna("-")) == rows(twice.fillna("-")) == [(1, "a", "x"), (2, "-", "-"), (3, "d", "n")]


def test_purge_and_prune_are_idempotent(spark):
    v = spark.createDataFrame([(1,), (2,)], "ID_STATEMENT int")
    p = spark.createDataFrame([(1, "item"), (2, "time")], "ID_STATEMENT int, VALUE_TYPE string")
    assert rows(merge.purge_type_flips(merge.purge_type_flips(v, p, "item"), p, "item")) == [(1,)]
    b = spark.createDataFrame([("b1",), ("b2",), (None,)], "IMPORT_BATCH_ID string")
    assert merge.prune_older(merge.prune_older(b, "b2"), "b2").count() == 2
    with pytest.raises(merge.GuardError):
        merge.prune_guard(b, "b9")


def test_replace_and_prune_owner_rules(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "o int, k string")
    new = spark.createDataFrame([(1, "n"), (3, "lost")], "o int, k string")
    ok = spark.createDataFrame([(1,), (2,)], "o int")
    once = merge.replace_snapshot(t, new, ok, "o")
    assert rows(once) == rows(merge.replace_snapshot(once, new, ok, "o")) == [(1, "n"), (3, "c")]
    assert rows(merge.prune_absent(t, new, ok, "o", ["k"], "delete")) == [(3, "c")]
    assert rows(merge.prune_absent(t, new, ok, "o", ["k"], "keep")) == [(2, "b"), (3, "c")]


def test_swap_table_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    tables.swap_table(spark.read.parquet(path).union(spark.range(3, 5)), path)
    assert spark.read.parquet(path).count() == 5


def test_id_sets_and_batches(spark, tmp_path):
    path = str(tmp_path / "ids")
    tables.write_id_set(spark.createDataFrame([("Q2",), ("Q1",), ("Q2",)], "i string"), path)
    assert [r[0] for r in tables.read_id_set(spark, path).collect()] == ["Q1", "Q2"]
    assert tables.read_id_set(spark, str(tmp_path / "none")).count() == 0
    staged = str(tmp_path / "staged")
    for n, batch in ((3, "b1"), (2, "b2"), (5, "b1")):
        tables.replace_batch(spark.range(n), staged, batch)
    assert rows(spark.read.parquet(staged).groupBy("IMPORT_BATCH_ID").count()) == [("b1", 5), ("b2", 2)]


def test_staging_files(spark, tmp_path):
    (tmp_path / "pass2").mkdir()
    (tmp_path / "pass2" / "PERSON.jsonl").write_text('{"ID_WIKIDATA":"Q1","LABELS_JSON":{"en":"a"},"extra":1}\n\n{"ID_WIKIDATA":"Q2"}\n')
    schema = spark.createDataFrame([], "ID_WIKIDATA string, LABELS_JSON map<string,string>").schema
    got = staging.read_staging_table(spark, str(tmp_path), "PERSON", schema, "b1").collect()
    assert {(r.ID_WIKIDATA, r.LABELS_JSON, r.IMPORT_BATCH_ID, r.ROW_STATUS) for r in got} == {("Q1", '{"en":"a"}', "b1", "NEW"), ("Q2", None, "b1", "NEW")}
    assert all(r.SOURCE_FILE.endswith("PERSON.jsonl") for r in got)
    assert len(staging.STAGING_SPECS) == 28 and len(staging.select_specs(["STATEMENT"])) == 2


def test_full_load_purges_before_values(spark):
    now = F.lit("now")
    stage = lambda df: df.withColumn("IMPORT_BATCH_ID", F.lit("b")).withColumn("ROW_STATUS", F.lit("NEW")).withColumn("ERROR_MESSAGE", F.lit("")).withColumn("ID_STG_ROW", F.lit(1))
    s = spark.createDataFrame([(1, "time", "now")], "ID_STATEMENT int, VALUE_TYPE string, TIM_UPDATED string")
    old_s = spark.createDataFrame([(1, "item", "old")], s.schema)
    item = spark.createDataFrame([(1, "Q1")], "ID_STATEMENT int, ID_ITEM string")
    time = spark.createDataFrame([(1, 1999)], "ID_STATEMENT int, YEAR_VALUE int")
    targets, left = refresh.full_load(
        {"STATEMENT": old_s, "ITEM_VALUE": item, "TIME_VALUE": time.limit(0)}, {"STATEMENT": stage(s), "TIME_VALUE": stage(time)}, "b", now
    )
    assert targets["ITEM_VALUE"].count() == 0 and targets["TIME_VALUE"].count() == 1
    assert left["STATEMENT"].first().ROW_STATUS == "LOADED"
    children = checks.stack_keys({"item": targets["ITEM_VALUE"], "time": targets["TIME_VALUE"]}, "ID_STATEMENT")
    assert checks.check_parent_type(children, targets["STATEMENT"], "ID_STATEMENT").count() == 0
    with pytest.raises(merge.GuardError):
        refresh.full_load(targets, left, "b", now, refresh.SUBCLASS_ONLY + ("STATEMENT",))
    assert all(df.count() == 0 for df in merge.reset_all(targets).values())


def test_gates(spark):
    one = lambda e: spark.createDataFrame([(e, 1, 1)], "PARSE_ERRORS int, CORE_ENTITIES int, STATEMENTS int")
    checks.enforce(checks.pass_gate(one(0)))
    with pytest.raises(checks.ValidationError):
        checks.enforce(checks.pass_gate(one(2)))


def test_repair_keeps_first_value_and_orphans(spark):
    h = lambda x: stable_bigint(F.lit(f"qualifier|{x}"))
    p = spark.createDataFrame([(1, "P1", "a"), (2, "P1", "a"), (3, "P1", "b")], "ID_STATEMENT long, ID_QUALIFIER_PROPERTY string, x string")
    p = p.select(stable_bigint(F.concat(F.lit("qualifier|"), "x")).alias("ID_STATEMENT_QUALIFIER"), "ID_STATEMENT", "ID_QUALIFIER_PROPERTY", F.concat(F.lit("qualifier|"), "x").alias("QUALIFIER_HASH"))
    v = spark.createDataFrame([("first", 1), ("second", 2)], "VALUE string, ROW_NO int").withColumn("ID_STATEMENT_QUALIFIER", h("a"))
    parents, values = merge.repair_qualifier_ids(p, {"item": v, "string": v})
    assert parents.select("ID_STATEMENT_QUALIFIER").distinct().count() == 3
    assert {r.VALUE for r in values["item"].collect()} == {"first"} and values["item"].count() == 2 and values["string"].count() == 0


def test_hot_key_ranking_matches_brute_force(spark):
    # One key holds more than a third of the rows.
    data = [("hot" if i % 2 else f"k{i % 50}", i * 7 % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, o int, id int")
    got = {(r.k, r.id): r.DISPLAY_ORDER for r in ranking.display_order(df, ["k"], ["o", "id"]).collect()}
    want, seen = {}, {}
    for k, o, i in sorted(data, key=lambda x: (x[0], x[1], x[2])):
        seen[k] = seen.get(k, 0) + 1
        want[(k, i)] = seen[k]
    assert got == want


def test_hot_key_is_ranked_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), (-F.col("id")).alias("o"))
        rows = ranking._in_order(df, ["k", "o"])
        assert rows.filter("k = 'hot'").select("_part").distinct().count() >= 2
        got = {(r.k, r.o): r.N for r in ranking.display_order(df, ["k"], ["o"], "N").collect()}
        spots = {r.o: r.AT for r in ranking.positions(df, ["o"], "AT").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 4000 and spots == {-i: 3999 - i for i in range(4000)}
    for k in ("hot", None):
        assert [n for _, n in sorted((o, n) for (x, o), n in got.items() if x == k)] == list(range(1, sum(x == k for x, _ in got) + 1))


def test_schema_gap(spark):
    old, new = spark.range(1).withColumn("x", F.lit("a")), spark.range(1)
    assert rows(reports.schema_gap({"t": old}, {"t": new})) == [("t", "x", "string")]


def payload(spark, entity, endpoint, *docs, lang="en"):
    data = [(entity, i, endpoint, lang, "2024-02-01", d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(docs, 1)]
    return spark.createDataFrame(data, "entity string, id long, endpoint string, lang string, fetched_at string, payload string")


def test_payload_outcomes_and_validators(spark):
    docs = [{"results": []}, {"status_code": 34}, None, "{broken", {"results": [{"iso_3166_1": "FR", "release_dates": [{"release_date": "x"}]}]}, {"results": {}},
            {"results": [{"iso_3166_1": "FR", "release_dates": [{"release_date": "2020-01-01T00:00:00.000Z", "type": 3, "descriptors": None}]}]}]
    p = payload(spark, "movie", "release_dates", *docs)
    good, bad = sn.validated(p, "movie", "release_dates", sn.valid_release_dates)
    assert {r.id for r in good.collect()} == {1} and {r.id for r in bad.collect()} == {5, 6, 7}
    outcomes = [r[0] for r in p.orderBy("id").select(merge.fetch_outcome(F.col("payload"))).collect()]
    assert outcomes == ["ok", "gone", "error", "error", "ok", "ok", "ok"]


def test_absent_and_null_fields(spark):
    row = sn.movie_details(payload(spark, "movie", "details", {"overview": None, "genres": [], "runtime": 58})).first()
    assert row.OVERVIEW is None and row.TITLE == "" and row.GENRES == "|" and row.COUNTRIES == "" and row.IS_SHORT_FILM == 1


def test_main_images_are_pinned(spark):
    posters = [{"file_path": "/a", "iso_639_1": "en"}, {"file_path": "/base", "iso_639_1": "fr"}, {"file_path": "/b"}, {"file_path": "/loc", "iso_639_1": "fr"}]
    main = spark.createDataFrame([(1, "/base", [("/loc", "fr"), ("/new", "fr")])], "id long, base string, local array<struct<path:string,lang:string>>")
    got = {r.IMAGE_PATH: r.DISPLAY_ORDER for r in sn.images(payload(spark, "movie", "images", {"posters": posters}), "movie", main).collect()}
    # A base image in another language gives up position 0.
    assert got == {"/a": 1, "/base": 1, "/b": 2, "/loc": 1, "/new": 1}


def test_ledger_stream_equals_batch_over_many_epochs(spark, tmp_path):
    import random

    rnd = random.Random(3)
    data = [("movie", rnd.choice([1, 1, 2, 3]), f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", i, rnd.choice(["gone", "gone", "error", "ok"])) for i in range(90)]
    cols = "ENTITY_TYPE string, ID_ENTITY long, TS string, SEQ int, OUTCOME string"
    events = spark.createDataFrame(data, cols).withColumn("TS", F.col("TS").cast("timestamp"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(3):
        events.filter(F.floor(F.col("SEQ") / 30) == n).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        feeds.retry_ledger(stream, out, str(tmp_path / "state")).awaitTermination()
    key = ["ENTITY_TYPE", "ID_ENTITY", "ATTEMPT_COUNT", "TIM_FIRST_SEEN", "TIM_LAST_SEEN", "TIM_RETRY_AFTER"]
    assert rows(feeds.ledger_state(spark, out).select(*key)) == rows(merge.not_found_ledger(events).select(*key))


def test_progress_counters(spark, tmp_path):
    spark.createDataFrame([("{}",), ("{bad",)], "value string").write.text(str(tmp_path / "in"))
    listener = feeds.Progress()
    spark.streams.addListener(listener)
    name = f"t{uuid.uuid4().hex}"
    lines = spark.readStream.text(str(tmp_path / "in"))
    q = feeds.counted(lines).writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    import time

    for _ in range(50):
        if listener.seen:
            break
        time.sleep(0.1)
    spark.streams.removeListener(listener)
    assert listener.total("ROWS") == 2 and listener.total("PARSE_ERRORS") == 1


def closure_of(edges, roots):
    below, seen, todo = {}, set(), list(roots)
    for parent, child in edges:
        below.setdefault(parent, []).append(child)
    while todo:
        kind, q = todo.pop()
        if (kind, q) not in seen:
            seen.add((kind, q))
            todo += [(kind, x) for x in below.get(q, [])]
    return seen


def test_closure_folds_and_spreads_a_crowded_parent(spark):
    # A long chain takes many rounds, a hot parent holds a third of the edges, and there is a cycle.
    edges = [(f"Q{i}", f"Q{i + 1}") for i in range(12)] + [("Q3", f"H{i}") for i in range(60)] + [(f"H{i}", f"L{i}") for i in range(60)] + [("Q12", "Q0"), ("Q5", "Q5"), (None, "x")]
    roots = [("a", "Q0"), ("b", "Q7"), ("a", "Z")]
    e, r = spark.createDataFrame(edges, "ID_PARENT string, ID_CHILD string"), spark.createDataFrame(roots, "ROOT_TYPE string, QID string")
    got = [tuple(x) for x in scope.closure_multi(e, r).collect()]
    assert len(got) == len(set(got)) and set(got) == closure_of([x for x in edges if x[0]], roots)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("kg_")]


def test_a_round_moves_the_frontier_only(spark):
    e = spark.range(2000).select((F.col("id") % 50).cast("string").alias("ID_PARENT"), F.col("id").cast("string").alias("ID_CHILD"))
    table, crowded = scope._bucketed_edges(e)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frontier = spark.createDataFrame([("a", "3"), ("a", "4")], "ROOT_TYPE string, QID string")
        found = scope._below(frontier, spark.table(table), crowded)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 80
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {table}")
    join = plan[plan.index("SortMergeJoin") :]
    assert join.count("Exchange hashpartitioning") == 1, plan  # the frontier; the edges' side is the bucketed scan
    assert "SelectedBucketsCount" in join or "Bucketed: true" in join
