"""Tables merged by parts, and streams over several epochs: late, repeated and replayed rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from kgspark.operators import merge
from kgspark.sources.merged import MergedTable, first_seen, newest_row
from kgspark.streaming import feeds

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)
OUTCOMES = "ENTITY_TYPE string, ID_ENTITY long, TS timestamp, SEQ int, OUTCOME string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, tmp_path, parts=8):
    return MergedTable(spark, str(tmp_path / "t"), "k BIGINT, v STRING, n INT", ["k"], parts)


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path)
    assert rows(t.read()) == []
    batch = spark.createDataFrame([(i, "a", 1) for i in range(40)], "k int, v string, n int")  # an int key falls into the parts of a long one
    assert t.merge(batch, 0, newest_row(["k"], ["n"]))
    before = t.versions()
    assert len(before) == 8 and set(before.values()) == {0}
    t.merge(spark.createDataFrame([(3, "b", 2), (3, "late", 0)], "k long, v string, n int"), 1, newest_row(["k"], ["n"]))
    after = t.versions()
    assert sorted(after.values()) == [0] * 7 + [1]
    assert rows(t.read()) == sorted([(i, "b" if i == 3 else "a", 2 if i == 3 else 1) for i in range(40)], key=str)
    assert rows(t.read(0)) == sorted([(i, "a", 1) for i in range(40)], key=str)


def test_a_replayed_epoch_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    one = spark.createDataFrame([(1, "a", 1), (2, "a", 1)], "k long, v string, n int")
    t.merge(one, 0, newest_row(["k"], ["n"]))
    t.merge(spark.createDataFrame([(2, "b", 2)], "k long, v string, n int"), 1, newest_row(["k"], ["n"]))
    want = rows(t.read())
    assert not t.merge(one, 0, newest_row(["k"], ["n"])) and not t.merge(one, 1, newest_row(["k"], ["n"]))
    assert rows(t.read()) == want
    # A batch that died before its commit is written anew and leaves no trace.
    os.rename(tmp_path / "t/commits/epoch=1/_SUCCESS", tmp_path / "t/gone")
    assert rows(t.read()) == rows(one)
    assert t.merge(spark.createDataFrame([(2, "b", 2)], "k long, v string, n int"), 1, newest_row(["k"], ["n"]))
    assert rows(t.read()) == want


def test_parts_can_become_empty_and_old_versions_go(spark, tmp_path):
    t = table(spark, tmp_path, parts=2)
    for e in range(4):
        t.merge(spark.createDataFrame([(e, "x", e)], "k long, v string, n int"), e, first_seen(["k"]))
    t.merge(spark.createDataFrame([(0, "y", 9), (9, None, None)], "k long, v string, n int"), 4, first_seen(["k"]))
    assert (0, "x", 0) in rows(t.read()) and (9, None, None) in rows(t.read())
    want = rows(t.read())
    t.vacuum()
    assert rows(t.read()) == want and t.epochs() == [3, 4]
    kept = {n for n in os.listdir(tmp_path / "t/data")}
    assert kept <= {f"epoch={v}" for e in (3, 4) for v in t.versions(e).values()}
    t.merge(spark.createDataFrame([(i, "", 0) for i in range(20)], "k long, v string, n int"), 5, lambda old, new: old.limit(0))
    assert rows(t.read()) == [] and t.versions() == {}


def outcomes(spark, data):
    return spark.createDataFrame([("movie", i, START + days * DAY, n, o) for n, (i, days, o) in enumerate(data)], OUTCOMES)


def fed(spark, tmp_path, epochs, lateness):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in epochs:
        part.coalesce(1).write.mode("append").parquet(source)
        feeds.retry_ledger(spark.readStream.schema(part.schema).parquet(source), out, str(tmp_path / "state"), lateness).awaitTermination()
    return {r.ID_ENTITY: r for r in feeds.ledger_state(spark, out).collect()}


def test_outcomes_out_of_order_count_as_if_in_order(spark, tmp_path):
    every = outcomes(spark, [(1, 0, "gone"), (1, 2, "gone"), (2, 1, "gone"), (3, 0, "gone"), (3, 3, "gone"), (1, 1, "ok"), (2, 0.5, "ok"), (3, 4, "ok"), (4, 3, "gone"), (4, 3, "error")])
    late = F.col("SEQ").isin(5, 6)
    got = fed(spark, tmp_path, [every.filter(~late), every.filter(late)], "7 days")
    want = {r.ID_ENTITY: r for r in merge.not_found_ledger(every).collect()}
    assert {k: (r.ATTEMPT_COUNT, r.TIM_FIRST_SEEN, r.TIM_LAST_SEEN, r.TIM_RETRY_AFTER) for k, r in got.items()} == {
        k: (r.ATTEMPT_COUNT, r.TIM_FIRST_SEEN, r.TIM_LAST_SEEN, r.TIM_RETRY_AFTER) for k, r in want.items()
    }
    assert got[1].ATTEMPT_COUNT == 1 and 3 not in got


def test_windows_end_by_timer_and_late_outcomes_are_dropped(spark, tmp_path):
    first = outcomes(spark, [(1, 0, "gone"), (1, 1, "gone"), (2, 0, "gone")])
    second = outcomes(spark, [(3, 12, "gone")])
    third = outcomes(spark, [(1, 0.5, "ok"), (3, 12.5, "gone"), (3, 12.5, "gone"), (2, 13, "ok")])
    got = fed(spark, tmp_path, [first, second, third], "1 day")
    assert got[1].STATUS == "open" and got[1].ATTEMPT_COUNT == 2  # its success came over a day late; its window is 14 days
    assert got[3].STATUS == "open" and got[3].ATTEMPT_COUNT == 3 and got[3].TIM_RETRY_AFTER == START + 33.5 * DAY
    assert 2 not in got
    more = fed(spark, tmp_path, [outcomes(spark, [(5, 20, "gone")])], "1 day")
    assert more[1].STATUS == "due" and more[3].STATUS == "open" and more[5].STATUS == "open"
