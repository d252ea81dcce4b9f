"""Write semantics as pure functions: (target, incoming) to the next target.

Plain Parquet has no MERGE, so each rule computes the whole next table; the caller
swaps it in with ``sources.tables.swap_table``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions import ident, shuffled
from kgspark.operators.ranking import dedupe_keep_first, latest_wins
from kgspark.session import cut


class GuardError(RuntimeError):
    """A write was refused because its precondition does not hold."""


def loadable(staging: DataFrame, batch: str) -> DataFrame:
    """Staged rows of one batch that still wait to be loaded."""
    return staging.filter((F.col("IMPORT_BATCH_ID") == batch) & F.col("ROW_STATUS").isin("NEW", "VALID"))


def mark_loaded(staging: DataFrame, batch: str) -> DataFrame:
    done = (F.col("IMPORT_BATCH_ID") == batch) & F.col("ROW_STATUS").isin("NEW", "VALID")
    done = F.coalesce(done, F.lit(False))
    # Both columns at once: the second must still see the old status.
    return staging.withColumns(
        {
            "ROW_STATUS": F.when(done, "LOADED").otherwise(F.col("ROW_STATUS")),
            "ERROR_MESSAGE": F.when(done, F.lit(None)).otherwise(F.col("ERROR_MESSAGE")).cast("string"),
        }
    )


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    policy: Mapping[str, str] | None = None,
    now: Column | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Insert or overwrite by key. NULL in ``incoming`` overwrites, as a full-row write does.

    Per-column policy: ``overwrite`` (default), ``insert_only`` keeps the target's
    value on update, ``skip_null`` keeps it when the incoming one is NULL, ``now``
    stamps every written row, ``now_on_update`` those that were there. With ``order``, the last incoming row per key wins.
    """
    policy = dict(policy or {})
    if order:
        incoming = latest_wins(incoming, keys, order).drop(*[c for c in order if c not in target.columns])
    payload = [c for c in target.columns if c not in keys]
    have = set(incoming.columns)
    t = target.select(*keys, F.struct(F.lit(1).alias("_"), *payload).alias("_t"))
    i = incoming.select(*keys, F.struct(F.lit(1).alias("_"), *[c for c in payload if c in have]).alias("_i"))
    joined = t.join(i, list(keys), "full_outer")
    written, existed = F.col("_i").isNotNull(), F.col("_t").isNotNull()

    def value(c: str) -> Column:
        old = F.col(f"_t.`{c}`")
        rule = policy.get(c, "overwrite")
        if rule == "now":
            return F.when(written, now).otherwise(old)
        if c not in have:
            return old
        new = F.col(f"_i.`{c}`")
        if rule == "insert_only":
            return F.when(written & ~existed, new).otherwise(old)
        if rule == "now_on_update":
            return F.when(written & existed, now).when(written, new).otherwise(old)
        if rule == "skip_null":
            return F.when(written, F.coalesce(new, old)).otherwise(old)
        return F.when(written, new).otherwise(old)

    types = {f.name: f.dataType for f in target.schema.fields}
    out = {c: value(c).cast(types[c]).alias(c) for c in payload}
    return joined.select(*[F.col(c) if c in keys else out[c] for c in target.columns])


def upsert_std(target: DataFrame, rows: DataFrame, keys: Sequence[str], now: Column, user: Column) -> DataFrame:
    """Upsert with audit columns: creation stamps on insert only, update stamps always.

    ``rows`` may lack columns of the target (kept on update, NULL on insert).
    """
    stamped = (
        rows.withColumn("DAT_CREAT", now.cast("date"))
        .withColumn("TIM_UPDATED", now)
        .withColumn("ID_CREATOR", user)
        .withColumn("ID_USER_UPDATED", user)
    )
    known = [c for c in stamped.columns if c in target.columns]
    policy = {"DAT_CREAT": "insert_only", "ID_CREATOR": "insert_only"}
    return upsert(target, stamped.select(*known), keys, policy)


def union_rows(*frames: DataFrame) -> DataFrame:
    """Stack heterogeneous rows; columns a frame lacks are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def purge_type_flips(values: DataFrame, batch_parents: DataFrame, kind: str, key: str = "ID_STATEMENT") -> DataFrame:
    """Child rows minus those whose parent has another type in this batch."""
    flipped = batch_parents.filter(F.col("VALUE_TYPE") != kind).select(key)
    return values.join(shuffled(flipped), key, "left_anti")


def count_type_flips(tables: Mapping[str, DataFrame], batch_parents: DataFrame, key: str = "ID_STATEMENT") -> DataFrame:
    """How many child rows each table would lose: one pass over the parents."""
    stacked = None
    for kind, table in tables.items():
        part = table.select(key, F.lit(kind).alias("CHILD_TABLE"))
        stacked = part if stacked is None else stacked.union(part)
    parents = batch_parents.select(key, "VALUE_TYPE").distinct()
    hits = stacked.join(parents, key).filter(F.col("VALUE_TYPE") != F.col("CHILD_TABLE"))
    return hits.groupBy("CHILD_TABLE").agg(F.count(F.lit(1)).alias("CONFLICTS"))


def prune_older(df: DataFrame, batch: str) -> DataFrame:
    """Drop rows of strictly older batches (text order); rows without a batch stay."""
    return df.filter(F.col("IMPORT_BATCH_ID").isNull() | (F.col("IMPORT_BATCH_ID") >= batch))


def prune_cascade(
    statements: DataFrame,
    values: Mapping[str, DataFrame],
    qualifiers: DataFrame,
    qualifier_values: Mapping[str, DataFrame],
    media: DataFrame,
    subclass: DataFrame,
    batch: str,
    media_urls: DataFrame | None = None,
    media_checks: DataFrame | None = None,
) -> dict[str, object]:
    """Prune every batch-bound table and what hangs below it; entities stay.

    The ids that go are written once: every table below is filtered by them. A media
    resource goes with its own old batch or with its statement; its URL and CHECK rows
    go with it, a CHECK row with its own old batch too.
    """
    gone = cut(statements.filter(F.col("IMPORT_BATCH_ID") < batch).select("ID_STATEMENT"), "gone")
    # A qualifier goes with its own old batch or with its old statement.
    old_q = qualifiers.filter(F.col("IMPORT_BATCH_ID") < batch).select("ID_STATEMENT_QUALIFIER")
    below = qualifiers.join(shuffled(gone), "ID_STATEMENT", "left_semi").select("ID_STATEMENT_QUALIFIER")
    gone_q = cut(old_q.union(below).distinct(), "gone-qualifiers")
    old_m = media.filter(F.col("IMPORT_BATCH_ID") < batch).select("ID_MEDIA_RESOURCE")
    gone_m = cut(old_m.union(media.join(shuffled(gone), "ID_STATEMENT", "left_semi").select("ID_MEDIA_RESOURCE")).distinct(), "gone-media")
    below_media = {}
    if media_urls is not None:
        below_media["media_urls"] = media_urls.join(shuffled(gone_m), "ID_MEDIA_RESOURCE", "left_anti")
    if media_checks is not None:
        below_media["media_checks"] = prune_older(media_checks, batch).join(shuffled(gone_m), "ID_MEDIA_RESOURCE", "left_anti")
    return below_media | {
        "statements": prune_older(statements, batch),
        "values": {k: v.join(shuffled(gone), "ID_STATEMENT", "left_anti") for k, v in values.items()},
        "qualifiers": qualifiers.join(shuffled(gone_q), "ID_STATEMENT_QUALIFIER", "left_anti"),
        "qualifier_values": {
            k: v.join(shuffled(gone_q), "ID_STATEMENT_QUALIFIER", "left_anti") for k, v in qualifier_values.items()
        },
        "media": media.join(shuffled(gone_m), "ID_MEDIA_RESOURCE", "left_anti"),
        "subclass": prune_older(subclass, batch),
    }


def prune_guard(statements: DataFrame, batch: str) -> None:
    """Refuse to prune around a batch that has no statements."""
    if statements.filter(F.col("IMPORT_BATCH_ID") == batch).isEmpty():
        raise GuardError(f"batch {batch} has no statements; nothing may be pruned")


def clear_staging(staging: DataFrame, batch: str) -> DataFrame:
    return staging.filter(F.col("IMPORT_BATCH_ID").isNull() | (F.col("IMPORT_BATCH_ID") != batch))


def reset_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every table emptied, schemas kept."""
    return {name: df.limit(0) for name, df in tables.items()}


def replace_snapshot(target: DataFrame, rows: DataFrame, owners: DataFrame, owner: str) -> DataFrame:
    """Replace all rows of every owner in ``owners``.

    ``owners`` lists the owners whose payload arrived and was valid: an owner with no
    new rows is cleared, an owner not listed (failed or malformed) keeps its rows.
    """
    done = owners.select(owner).distinct()
    kept = target.join(done, owner, "left_anti")
    fresh = rows.join(done, owner, "left_semi")
    return kept.unionByName(fresh.select(*target.columns))


def prune_absent(target: DataFrame, listed: DataFrame, owners: DataFrame, owner: str, keys: Sequence[str], on_empty: str = "delete") -> DataFrame:
    """Drop an owner's rows that its payload no longer lists.

    Only owners in ``owners`` (valid payloads) are touched. With ``on_empty="keep"``
    an owner whose list is empty loses nothing; with ``"delete"`` it loses all.
    """
    full = [owner, *keys]
    seen, rows = owners.select(owner).distinct(), listed.select(*full).distinct()
    if on_empty == "keep":  # made of the same distinct rows, so that what lists them runs once
        seen = rows.select(owner).distinct().join(shuffled(seen), owner, "left_semi")
    flagged = target.join(shuffled(seen.withColumn("_seen", F.lit(1))), owner, "left").join(
        shuffled(rows.withColumn("_listed", F.lit(1))), full, "left"
    )
    return flagged.filter(F.col("_seen").isNull() | F.col("_listed").isNotNull()).select(*target.columns)


def soft_delete_absent(target: DataFrame, active_ids: DataFrame, key: str, now: Column) -> DataFrame:
    """DELETED = 1 for rows whose id left the active set; rows already deleted stay as they are."""
    alive = active_ids.select(key).distinct().withColumn("_alive", F.lit(1))
    joined = target.join(alive, key, "left")
    leaving = F.col("_alive").isNull() & (F.coalesce("DELETED", F.lit(0)) != 1)
    return joined.select(
        *[
            F.when(leaving, F.lit(1)).otherwise(F.col("DELETED")).alias("DELETED") if c == "DELETED"
            else F.when(leaving, now).otherwise(F.col("TIM_UPDATED")).alias("TIM_UPDATED") if c == "TIM_UPDATED"
            else F.col(c)
            for c in target.columns
        ]
    )


def fill_empty(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Copy a source value only where the target's is NULL or ''."""
    src = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns])
    joined = target.join(src, list(keys), "left")
    empty = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    return joined.select(
        *[
            F.when(empty(c), F.coalesce(F.col(f"_s_{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def move_rows(source: DataFrame, target: DataFrame, ids: DataFrame, key: str, fill: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(next source, next target): rows of ``ids`` move over.

    One row per id is inserted or fills the target's blanks; every row of the id
    (all languages) leaves the source.
    """
    chosen = ids.select(key).distinct()
    moving = source.join(chosen, key, "left_semi")
    one = moving.groupBy(key).agg(*[F.max(F.nullif(F.col(c), F.lit(""))).alias(c) for c in fill])
    filled = fill_empty(target, one, [key], fill)
    fresh = one.join(target.select(key), key, "left_anti")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in target.schema.fields}
    fresh = fresh.select(*[F.col(c) if c in (key, *fill) else blank[c].alias(c) for c in target.columns])
    return source.join(chosen, key, "left_anti"), filled.unionByName(fresh)


# Tables that hold rows of an entity, by kind: (table, key column). A film's company,
# country, language, similar and recommendation rows are not in the list on purpose;
# the foreign-key check reports what is left behind.
CASCADES = {
    "person": (("PERSON", "ID_PERSON"), ("PERSON_MOVIE", "ID_PERSON"), ("PERSON_SERIE", "ID_PERSON"), ("PERSON_IMAGE", "ID_PERSON")),
    "movie": tuple(
        (t, "ID_MOVIE")
        for t in ("MOVIE", "MOVIE_LANG", "MOVIE_GENRE", "MOVIE_KEYWORD", "MOVIE_IMAGE", "MOVIE_VIDEO", "MOVIE_LIST", "MOVIE_COLLECTION", "MOVIE_RELEASE_DATE", "MOVIE_WATCH_PROVIDER", "PERSON_MOVIE")
    ),
    "serie": tuple(
        (t, "ID_SERIE")
        for t in ("SERIE", "SERIE_LANG", "SERIE_GENRE", "SERIE_KEYWORD", "SERIE_IMAGE", "SERIE_VIDEO", "SERIE_LIST", "SERIE_NETWORK", "SERIE_WATCH_PROVIDER", "PERSON_SERIE")
    ),
    "season": tuple((t, "ID_SEASON") for t in ("SEASON", "SEASON_LANG", "SEASON_IMAGE", "SEASON_VIDEO", "PERSON_SEASON")),
    "episode": tuple((t, "ID_EPISODE") for t in ("EPISODE", "EPISODE_LANG", "EPISODE_IMAGE", "EPISODE_VIDEO", "PERSON_EPISODE")),
}


def cascade_delete(tables: Mapping[str, DataFrame], kind: str, ids: DataFrame) -> dict[str, DataFrame]:
    """Remove ids (first column of ``ids``) from every table of the kind's cascade."""
    out = dict(tables)
    first = ids.columns[0]
    if kind == "season" and "EPISODE" in out:
        episodes = out["EPISODE"].join(ids.select(F.col(first).alias("ID_SEASON")), "ID_SEASON", "left_semi")
        out = cascade_delete(out, "episode", episodes.select("ID_EPISODE"))
    for table, key in CASCADES[kind]:
        if table in out:
            out[table] = out[table].join(ids.select(F.col(first).alias(key)), key, "left_anti")
    return out


_OLD_PREFIX = "qualifier|"


def _new_qualifier_key(parents: DataFrame) -> DataFrame:
    old = F.coalesce(F.col("QUALIFIER_HASH"), F.lit(""))
    occurrence = F.when(old.startswith(_OLD_PREFIX), F.substr(old, F.lit(len(_OLD_PREFIX) + 1))).otherwise(old)
    return (
        parents.withColumn("OLD_ID", F.col("ID_STATEMENT_QUALIFIER"))
        .withColumn("QUALIFIER_HASH", ident.qualifier_hash(F.col("ID_STATEMENT"), F.col("ID_QUALIFIER_PROPERTY"), occurrence))
        .withColumn("ID_STATEMENT_QUALIFIER", ident.stable_bigint(F.col("QUALIFIER_HASH")))
    )


def repair_qualifier_ids(parents: DataFrame, values: Mapping[str, DataFrame], order: str = "ROW_NO") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Renumber qualifiers by occurrence and fan each old value row out to all of them.

    ``values`` are the typed tables in reading order; per old id the first table,
    then the first row (by ``order``) counts. Parents without a value stay childless.
    """
    renumbered = _new_qualifier_key(parents)
    claims = None
    for position, (name, table) in enumerate(values.items()):
        part = table.groupBy("ID_STATEMENT_QUALIFIER").agg(F.lit(position).alias("_pos"), F.lit(name).alias("_table"))
        claims = part if claims is None else claims.union(part)
    owner = claims.groupBy("ID_STATEMENT_QUALIFIER").agg(F.min_by("_table", "_pos").alias("_table"))
    link = shuffled(renumbered.select("OLD_ID", F.col("ID_STATEMENT_QUALIFIER").alias("_new")))
    out = {}
    for name, table in values.items():
        first = dedupe_keep_first(table, ["ID_STATEMENT_QUALIFIER"], [order])
        mine = shuffled(owner.filter(F.col("_table") == name).select("ID_STATEMENT_QUALIFIER"))
        fanned = first.join(mine, "ID_STATEMENT_QUALIFIER", "left_semi").join(
            link, F.col("ID_STATEMENT_QUALIFIER") == F.col("OLD_ID")
        )
        out[name] = fanned.select(
            *[F.col("_new").alias(c) if c == "ID_STATEMENT_QUALIFIER" else F.col(c) for c in table.columns]
        )
    return renumbered.drop("OLD_ID"), out


def repair_dry_run(parents: DataFrame) -> DataFrame:
    """What a repair would change; collisions left over must stop it."""
    counted = _new_qualifier_key(parents).agg(
        F.count(F.lit(1)).alias("OCCURRENCES"),
        F.count_distinct("OLD_ID").alias("DISTINCT_BEFORE"),
        F.count_distinct("ID_STATEMENT_QUALIFIER").alias("DISTINCT_AFTER"),
    )
    return (
        counted.withColumn("COLLISIONS", F.col("OCCURRENCES") - F.col("DISTINCT_AFTER"))
        .withColumn("RECOVERY_FACTOR", F.round(F.col("OCCURRENCES") / F.greatest(F.col("DISTINCT_BEFORE"), F.lit(1)), 1))
        .withColumn("VERDICT", F.when(F.col("COLLISIONS") > 0, "fail").otherwise("ok"))
    )


def fetch_outcome(payload: Column) -> Column:
    """'error', 'gone' or 'ok' from an API payload: 34 means the id no longer exists."""
    parsed = F.try_parse_json(payload)
    status = F.coalesce(F.try_variant_get(parsed, "$.status_code", "int"), F.lit(0))
    return F.when(parsed.isNull(), "error").when(status == 34, "gone").when(status > 1, "error").otherwise("ok")


def not_found_ledger(events: DataFrame, base_days: int = 7, max_factor: int = 26) -> DataFrame:
    """Open entries after replaying fetch outcomes per (ENTITY_TYPE, ID_ENTITY).

    Each 'gone' adds an attempt and widens the retry window; an 'ok' forgets the id;
    'error' changes nothing. So only the 'gone' events after the last 'ok' matter:
    two aggregates replay the history, and no key's events are ever gathered.
    """
    keys = ["ENTITY_TYPE", "ID_ENTITY"]
    last_ok = events.filter(F.col("OUTCOME") == "ok").groupBy(*keys).agg(F.max(F.struct("TS", "SEQ")).alias("_ok"))
    gone = events.filter(F.col("OUTCOME") == "gone")
    open_ = gone.join(last_ok, keys, "left").filter(F.col("_ok").isNull() | (F.struct("TS", "SEQ") > F.col("_ok")))
    folded = open_.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("ATTEMPT_COUNT"), F.min("TS").alias("TIM_FIRST_SEEN"), F.max("TS").alias("TIM_LAST_SEEN")
    )
    days = F.least(F.col("ATTEMPT_COUNT"), F.lit(max_factor)) * base_days
    return folded.withColumn("TIM_RETRY_AFTER", F.col("TIM_LAST_SEEN") + F.make_dt_interval(days.cast("int")))


def in_retry_window(ledger: DataFrame, now: Column) -> DataFrame:
    return ledger.filter(F.col("TIM_RETRY_AFTER") > now).select("ENTITY_TYPE", "ID_ENTITY")


def ledger_value(value: Column, limit: int = 255) -> Column:
    """Run-ledger values are cut to ``limit`` characters, the last three being dots."""
    return F.when(F.length(value) > limit, F.concat(F.left(value, F.lit(limit - 3)), F.lit("..."))).otherwise(value)


def run_ledger(runs: DataFrame) -> DataFrame:
    """Append-only run rows with, per name, the previous run's value beside the new one.

    Runs carry a consecutive RUN_NO per name, so the previous one is found by a
    join on (name, RUN_NO) instead of a window over all runs of a name.
    """
    current = runs.withColumn("VALUE", ledger_value(F.col("VALUE")))
    previous = current.select("NAME", (F.col("RUN_NO") + 1).alias("RUN_NO"), F.col("VALUE").alias("PREVIOUS_VALUE"))
    return current.join(previous, ["NAME", "RUN_NO"], "left")


def coalesce_sides(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], stamp: str) -> DataFrame:
    """One row per key of either side; left values first, the later stamp kept."""
    l_ = left.select(key, *[F.col(c).alias(f"_l_{c}") for c in [*columns, stamp]])
    r_ = right.select(key, *[F.col(c).alias(f"_r_{c}") for c in [*columns, stamp]])
    both = l_.join(r_, key, "full_outer")
    return both.select(
        key,
        *[F.coalesce(f"_l_{c}", f"_r_{c}").alias(c) for c in columns],
        F.greatest(f"_l_{stamp}", f"_r_{stamp}").alias(stamp),
    )


def completion_stamp(table: DataFrame, ids: DataFrame, key: str, column: str, now: Column, touch: bool = False) -> DataFrame:
    """Set a completion column (and TIM_UPDATED with ``touch``) for processed ids."""
    done = ids.select(key).distinct().withColumn("_done", F.lit(True))
    stamped = {column, "TIM_UPDATED"} if touch else {column}
    return table.join(done, key, "left").select(
        *[F.when(F.col("_done"), now).otherwise(F.col(c)).alias(c) if c in stamped else F.col(c) for c in table.columns]
    )
