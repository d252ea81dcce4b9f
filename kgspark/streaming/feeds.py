"""Streams: batch ingest, change feed, retry ledger and live counters.

What a micro-batch brings is merged into tables kept by keys (``sources.merged``): only the parts that it touches are
rewritten, readers read one table, and a retried epoch changes nothing. Per-id state lives in Spark's state store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener

from kgspark.plans import snapshots
from kgspark.sources.merged import MergedTable, first_seen, newest_row


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, name: str, mode: str = "append") -> StreamingQuery:
    """Start a query over what is available now; the caller awaits it."""
    return (
        stream.writeStream.queryName(name).outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def ingest_table(spark: SparkSession, folder: str, schema: str, keys: Sequence[str]) -> MergedTable:
    return MergedTable(spark, folder, schema, keys)


def ingest_batches(stream: DataFrame, folder: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> StreamingQuery:
    """Merge each micro-batch into one table: per key the last row by ``order``, a total order within the key.

    The order decides, not the arrival, so a row that comes late does not undo a newer one. A micro-batch costs what the
    parts cost that its keys fall into. ``ingest_table(...).read()`` is the current table.
    """

    def land(rows: DataFrame, epoch: int) -> None:
        table = ingest_table(rows.sparkSession, folder, _ddl(rows), keys)
        if table.merge(rows, epoch, newest_row(keys, order)):
            table.vacuum()

    return _run(stream, land, checkpoint, "ingest_batches")


SEASON_KEYS = ["ID_SERIE", "SEASON_NUMBER"]
EPISODE_KEYS = [*SEASON_KEYS, "EPISODE_NUMBER"]


def feed_tables(spark: SparkSession, folder: str) -> dict[str, MergedTable]:
    """The two outputs of the change feed; EPOCH is the micro-batch that first selected the row."""
    return {
        "seasons": MergedTable(spark, f"{folder}/seasons", "ID_SERIE BIGINT, SEASON_NUMBER INT, REASON STRING, EPOCH BIGINT", SEASON_KEYS),
        "episodes": MergedTable(spark, f"{folder}/episodes", "ID_SERIE BIGINT, SEASON_NUMBER INT, EPISODE_NUMBER INT, REASON STRING, EPOCH BIGINT", EPISODE_KEYS),
    }


def changes_feed(
    stream: DataFrame, remote: DataFrame, local: DataFrame, series: DataFrame, episodes: DataFrame, today: Column, folder: str, checkpoint: str
) -> StreamingQuery:
    """Select what every micro-batch of change documents makes necessary: the seasons to refresh and, below them, the episodes.

    Stream-static: only series that changed in the micro-batch are looked at. ``episodes`` are the known episodes with their
    stamps. A child that an earlier micro-batch selected is not selected again and keeps that batch's reason.
    """

    def select(changes: DataFrame, epoch: int) -> None:
        seasons, hints = snapshots.changed_children(changes)
        touched = seasons.union(hints.select("ID_SERIE")).distinct()
        mine = lambda df: df.join(touched, "ID_SERIE", "left_semi")
        asked = mine(remote)
        picked = snapshots.season_refresh_selection(asked, local, series, hints, today)
        latest = snapshots.latest_active_season(series, asked, today)
        below = snapshots.episode_refresh_selection(picked, mine(episodes), latest, hints, today)
        for name, rows in (("seasons", picked), ("episodes", below)):
            table = feed_tables(changes.sparkSession, folder)[name]
            table.merge(rows.withColumn("EPOCH", F.lit(epoch).cast("bigint")), epoch, first_seen(table.keys))

    return _run(stream, select, checkpoint, "changes_feed")


LEDGER_KEYS = ["ENTITY_TYPE", "ID_ENTITY"]
_LEDGER = "ENTITY_TYPE STRING, ID_ENTITY BIGINT, STATUS STRING, ATTEMPT_COUNT BIGINT, TIM_FIRST_SEEN TIMESTAMP, TIM_LAST_SEEN TIMESTAMP, TIM_RETRY_AFTER TIMESTAMP"


class RetryState(StatefulProcessor):
    """The open entry of one id.

    Failures younger than the watermark are kept one by one, in a list, for a success that arrives late may still lie before
    some of them; older ones are folded into a count with the first and last time. The timer of an entry is the end of its
    retry window. Times are microseconds since 1970.
    """

    def __init__(self, base_days: int, max_factor: int):
        self.base_days, self.max_factor = base_days, max_factor

    def init(self, handle) -> None:
        self.handle = handle
        self.folded = handle.getValueState("folded", "n BIGINT, first BIGINT, last BIGINT, ok BIGINT, ok_seq BIGINT, due BIGINT")
        self.young = handle.getListState("young", "ts BIGINT, seq BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        n, first, last, ok, ok_seq, due = self.folded.get() if self.folded.exists() else (0, None, None, None, -1, None)
        seen = set(map(tuple, self.young.get())) if self.young.exists() else set()
        best = (ok, ok_seq) if ok is not None else None
        for part in rows:
            for ts, seq, outcome in zip(part["MICROS"].tolist(), part["SEQ"].tolist(), part["OUTCOME"].tolist(), strict=True):
                if outcome == "gone":
                    seen.add((ts, seq))
                elif outcome == "ok":
                    best = (ts, seq) if best is None else max(best, (ts, seq))
        if best is not None and (ok is None or best > (ok, ok_seq)):
            seen = {s for s in seen if s > best}
            if last is not None and last <= best[0]:
                n, first, last = 0, None, None
        elif best is not None:
            seen = {s for s in seen if s > best}
        stamps = [t for t, _ in seen] + [t for t in (first, last) if t is not None]
        count, start, end = n + len(seen), min(stamps, default=None), max(stamps, default=None)
        # What the watermark has passed no later row can precede.
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        old = [s for s in seen if s[0] < passed]
        if old:
            times = [t for t, _ in old]
            n, first, last = n + len(old), min([first] * (first is not None) + times), max([last] * (last is not None) + times)
            seen -= set(old)
        if due is not None:
            self.handle.deleteTimer(due // 1000)
        retry = end + min(count, self.max_factor) * self.base_days * 86_400_000_000 if count else None
        if retry is not None and retry > passed:
            self.handle.registerTimer(retry // 1000)
        if count or best is not None:
            self.folded.update((n, first, last, None if best is None else best[0], -1 if best is None else best[1], retry))
            self.young.put(sorted(seen)) if seen else self.young.clear()
        yield self._row(key, "closed" if not count else "open" if retry > passed else "due", count, start, end, retry)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n, first, last, _, _, due = self.folded.get()
        stamps = [t for t, *_ in (self.young.get() if self.young.exists() else [])]
        every = stamps + [t for t in (first, last) if t is not None]
        if every:
            yield self._row(key, "due", n + len(stamps), min(every), max(every), due)

    def close(self) -> None:
        pass

    def _row(self, key, status, count, first, last, retry):
        import pandas as pd

        values = {"ENTITY_TYPE": key[0], "ID_ENTITY": key[1], "STATUS": status, "ATTEMPT_COUNT": count}
        times = {"TIM_FIRST_SEEN": first, "TIM_LAST_SEEN": last, "TIM_RETRY_AFTER": retry}
        return pd.DataFrame({k: [v] for k, v in values.items()} | {k: pd.array([v], "Int64") for k, v in times.items()})


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ledger_table(spark: SparkSession, folder: str) -> MergedTable:
    return MergedTable(spark, folder, _LEDGER, LEDGER_KEYS)


def retry_ledger(stream: DataFrame, folder: str, checkpoint: str, lateness: str = "7 days", base_days: int = 7, max_factor: int = 26) -> StreamingQuery:
    """Keep the open not-found entries while fetch outcomes (ENTITY_TYPE, ID_ENTITY, TS, SEQ, OUTCOME) stream in.

    One state row per id lives in the state store, so a micro-batch costs what its ids cost. A failure adds an attempt and
    widens the window to ``base_days`` times the attempts (at most ``max_factor`` of them), a success forgets the id; when
    event time passes the window's end a timer turns the entry from ``open`` to ``due``.

    Outcomes that arrive out of order count as if they had come in order, as long as they are at most ``lateness`` older than
    the newest outcome of the earlier micro-batches; older ones are dropped. Repeated outcomes (equal TS and SEQ) count once
    while they are within that time. Rows without a TS never pass the watermark and are dropped.

    ``ledger_state`` reads the entries; what left a state is merged into a table of which only touched parts are rewritten.
    """
    spark = stream.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    times = [f.name for f in spark.createDataFrame([], _LEDGER).schema if f.name.startswith("TIM_")]
    number = F.coalesce(F.col("SEQ").cast("bigint"), F.lit(0)).alias("SEQ")
    stream = stream.withColumn("TS", F.col("TS").cast("timestamp"))
    timed = stream.filter(F.col("OUTCOME").isin("gone", "ok") & F.col("TS").isNotNull()).select(*LEDGER_KEYS, "TS", F.unix_micros("TS").alias("MICROS"), number, "OUTCOME")
    changed = timed.withWatermark("TS", lateness).groupBy(*LEDGER_KEYS).transformWithStateInPandas(
        RetryState(base_days, max_factor), _LEDGER.replace("TIMESTAMP", "BIGINT"), outputMode="Update", timeMode="EventTime"
    )
    changed = changed.withColumns({c: F.timestamp_micros(c) for c in times})

    def settle(old: DataFrame, new: DataFrame) -> DataFrame:  # a timer fires after the rows of its micro-batch
        last = new.groupBy(*LEDGER_KEYS).agg(F.max_by(F.struct(*[c for c in new.columns if c not in LEDGER_KEYS]), F.col("STATUS") == "due").alias("_r"))
        last = last.select(*LEDGER_KEYS, "_r.*").select(*new.columns)
        return old.join(last.select(*LEDGER_KEYS), LEDGER_KEYS, "left_anti").unionByName(last.filter(F.col("STATUS") != "closed"))

    def keep(rows: DataFrame, epoch: int) -> None:
        table = ledger_table(rows.sparkSession, folder)
        if table.merge(rows, epoch, settle):
            table.vacuum()

    spark.conf.set(STATE_STORE, ROCKS)
    try:
        return _run(changed, keep, checkpoint, "retry_ledger", "update")
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def ledger_state(spark: SparkSession, folder: str, epoch: int | None = None) -> DataFrame:
    """The entries after an epoch (or the newest): those whose window is open and those that are due."""
    return ledger_table(spark, folder).read(epoch)


def counted(df: DataFrame, name: str = "progress") -> DataFrame:
    """Attach live counters (rows, parse errors) to a stream of dump lines."""
    bad = F.try_parse_json("value").isNull()
    return df.observe(name, F.count(F.lit(1)).alias("ROWS"), F.count_if(bad).alias("PARSE_ERRORS"))


class Progress(StreamingQueryListener):
    """Collects the observed counters of every micro-batch."""

    def __init__(self, name: str = "progress"):
        self.name, self.seen = name, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.seen.append(row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, counter: str) -> int:
        return sum(r[counter] for r in self.seen)
