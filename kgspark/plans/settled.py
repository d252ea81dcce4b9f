"""Snapshot chains that end in the stored tables: flatten, settle by outcome, stamp.

``snapshots`` turns answers into rows; here the rows meet what is stored. Which of an owner's rows go depends on what its
source answered (``operators.settle``), table by table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions import shuffled
from kgspark.operators import merge
from kgspark.operators.settle import EMPTY, FAILED, FILLED, MALFORMED, Rule, one_outcome, settle, stamped
from kgspark.plans import snapshots as sn
from kgspark.session import cut

#: Completion columns of an entity's own table, by the end of the settled table's name.
STAMPS = {
    "PERSON_MOVIE": "TIM_CREDITS_COMPLETED", "PERSON_SERIE": "TIM_CREDITS_COMPLETED", "PERSON_SEASON": "TIM_CREDITS_COMPLETED", "KEYWORD": "TIM_KEYWORDS_COMPLETED",
    "RELEASE_DATE": "TIM_RELEASE_DATES_COMPLETED", "WATCH_PROVIDER": "TIM_WATCH_PROVIDERS_COMPLETED", "IMAGE": "TIM_IMAGES_COMPLETED", "VIDEO": "TIM_VIDEOS_COMPLETED",
}


def rules(kind: str) -> dict[str, Rule]:
    """The rule of every table that an entity kind's chain settles."""
    own, owner = kind.upper(), f"ID_{kind.upper()}"
    images = Rule((owner,), ("TYPE_IMAGE", "IMAGE_PATH"), listed_by=("IMAGE_PATH",))
    videos = Rule((owner, "LANG_REQUESTED"), ("ID_CREDIT",))
    credits = Rule((owner,), ("ID_CREDIT",))
    if kind in ("movie", "serie"):
        relations = {f"{own}_{r}": Rule((owner,), (column,), "keep") for r, (_, _, _, column) in sn.RELATIONS.items() if kind == "serie" or r != "NETWORK"}
        neighbours = {f"{own}_{r}": Rule((owner,), ("ID_NEIGHBOUR",), "keep") for r in ("SIMILAR", "RECOMMENDATION")}
        whole = {f"{own}_WATCH_PROVIDER": Rule((owner,))} | ({"MOVIE_RELEASE_DATE": Rule((owner,))} if kind == "movie" else {})
        return relations | neighbours | whole | {
            f"PERSON_{own}": credits, f"{own}_KEYWORD": Rule((owner,), ("ID_KEYWORD",), mode="merge"), f"{own}_IMAGE": images, f"{own}_VIDEO": videos,
        }
    if kind == "person":
        return {"PERSON_MOVIE": credits, "PERSON_SERIE": credits, "PERSON_IMAGE": images}
    if kind == "season":  # a season's answer holds a part of its episodes' credits only
        part = Rule(("ID_EPISODE",), ("ID_CREDIT",), mode="merge")
        return {"PERSON_SEASON": credits, "PERSON_EPISODE": part, "SEASON_IMAGE": images, "SEASON_VIDEO": videos}
    if kind == "episode":
        return {"PERSON_EPISODE": credits, "EPISODE_IMAGE": images, "EPISODE_VIDEO": videos}
    if kind == "list":
        return {"LIST_MEMBER": Rule(("ID_LIST", "KIND"), ("ID_TITLE",), "keep")}
    return {f"{own}_IMAGE": images} if kind != "keyword" else {}


# Outcomes


def _list_state(raw: Column) -> Column:
    """Of a field's raw text: NULL when it is absent, -1 when it is no list, else the list's length."""
    items = F.try_variant_get(F.try_parse_json(raw), "$", "array<variant>")
    return F.when(raw.isNotNull(), F.coalesce(F.size(items), F.lit(-1)))


def _lists(*raws: Column) -> Column:
    """The outcome of an answer whose rows stand in the given lists; absent lists are empty."""
    states = F.array(*[_list_state(r) for r in raws])
    return F.when(F.exists(states, lambda s: s == -1), MALFORMED).when(F.exists(states, lambda s: s > 0), FILLED).otherwise(EMPTY)


def _valid(rule, field: str) -> Column:
    """The outcome of an answer that is taken whole or not at all."""
    raw = F.try_element_at("m", F.lit(field))
    size = F.coalesce(_list_state(raw), F.lit(-1))
    listed = F.when(size >= 0, size > 0).otherwise(raw != "{}")
    return F.when(~F.coalesce(rule(F.col("payload")), F.lit(False)), MALFORMED).when(F.coalesce(listed, F.lit(False)), FILLED).otherwise(EMPTY)


def _part(raw: Column, *names: str) -> list[Column]:
    """The raw texts of an object's lists; an object that is none gives a text that is no list."""
    fields = F.from_json(raw, "MAP<STRING, STRING>")
    return [F.when(raw.isNotNull(), F.when(fields.isNull(), F.lit("?")).otherwise(F.try_element_at(fields, F.lit(n)))) for n in names]


def outcomes(answers: DataFrame, kind: str, main: DataFrame | None = None) -> DataFrame:
    """(TABLE_NAME, ID_OWNER, SCOPE, OUTCOME) of the newest answers of one kind: one pass, each answer tells about all its tables.

    ``answers`` carry their top-level fields in ``m``. ``main`` are the main images (id, path, localized ones): an owner that
    has any is never empty of images.
    """
    own, raw = kind.upper(), lambda k: F.try_element_at("m", F.lit(k))
    status = F.coalesce(raw("status_code").try_cast("int"), F.lit(0))
    answered = F.col("m").isNotNull() & (status <= 1)
    said: list[tuple[str, str, Column, Column]] = []  # endpoint, table, scope, outcome
    none = F.lit(None).cast("string")
    say = lambda endpoint, table, outcome, scope=none: said.append((endpoint, table, scope, outcome))
    if kind in ("movie", "serie"):
        for r, (key, _, _, _) in sn.RELATIONS.items():
            if kind == "serie" or r != "NETWORK":
                say("details", f"{own}_{r}", _lists(raw(key)))
        people = _part(raw("credits"), "cast", "crew")
        say("details", f"PERSON_{own}", _lists(*people, *([raw("created_by")] if kind == "serie" else [])))
        say("keywords", f"{own}_KEYWORD", _lists(raw("keywords" if kind == "movie" else "results")))
        say("similar", f"{own}_SIMILAR", _lists(raw("results")))
        say("recommendations", f"{own}_RECOMMENDATION", _lists(raw("results")))
        say("watch_providers", f"{own}_WATCH_PROVIDER", _valid(sn.valid_watch_providers, "results"))
        if kind == "movie":
            say("release_dates", "MOVIE_RELEASE_DATE", _valid(sn.valid_release_dates, "results"))
    if kind == "person":
        for media in ("MOVIE", "SERIE"):
            say("details", f"PERSON_{media}", _lists(*_part(raw("combined_credits"), "cast", "crew")))
    if kind == "season":
        rich = F.when(raw("aggregate_credits").isNotNull(), _lists(*_part(raw("aggregate_credits"), "cast", "crew"))).otherwise(_lists(*_part(raw("credits"), "cast", "crew")))
        say("details", "PERSON_SEASON", rich)
    if kind == "episode":
        say("credits", "PERSON_EPISODE", _lists(raw("cast"), raw("crew"), raw("guest_stars")))
    shown = _lists(*[raw(k) for k in sn.IMAGE_LISTS])
    if main is not None:
        ids = main.select(F.col(main.columns[0]).alias("id"), (F.coalesce(F.col(main.columns[1]) != "", F.lit(False)) | (F.size(main.columns[2]) > 0)).alias("_main"))
        answers = answers.join(ids, "id", "left")
        shown = F.when((shown == EMPTY) & F.coalesce("_main", F.lit(False)), FILLED).otherwise(shown)
    say("images", f"{own}_IMAGE", shown)
    say("videos", f"{own}_VIDEO", _lists(raw("results")), F.col("lang"))
    in_english = (F.col("endpoint") != "details") | (F.col("lang") == "en") if kind in ("movie", "serie") else F.lit(True)
    told = F.array(*[F.when(F.col("endpoint") == e, F.struct(F.lit(t).alias("t"), s.alias("s"), o.alias("o"))) for e, t, s, o in said])
    rows = answers.filter(in_english).select(_owner(kind).alias("ID_OWNER"), answered.alias("ok"), F.explode(F.filter(told, lambda x: x.isNotNull())).alias("x"))
    long = rows.select(F.col("x.t").alias("TABLE_NAME"), "ID_OWNER", F.col("x.s").alias("SCOPE"), F.when(F.col("ok"), F.col("x.o")).otherwise(FAILED).alias("OUTCOME"))
    if kind == "list":
        long = _list_outcomes(answers)
    if kind == "season":
        episodes = sn.episode_credits(answers, "season").select("ID_EPISODE").distinct()
        long = long.union(episodes.select(F.lit("PERSON_EPISODE"), "ID_EPISODE", none, F.lit(FILLED)))
    return one_outcome(long)


def _owner(kind: str) -> Column:
    """Rows of seasons carry their series' id; their tables go by the season's own, which the payload tells."""
    return F.try_element_at("m", F.lit("id")).try_cast("bigint") if kind == "season" else F.col("id")


def _list_outcomes(answers: DataFrame) -> DataFrame:
    """A list's outcome by kind of its members; a list of which a page is missing or unusable is failed as a whole."""
    f = sn._fields()
    items = f.rows("items", "media_type STRING")
    pages = sn.documents(answers, "list", "page").select(
        F.col("id").alias("ID_OWNER"), f.number("page", "int").alias("page"), f.number("total_pages", "int").alias("pages"),
        F.exists(items, lambda x: x["media_type"] == "movie").alias("movie"), F.exists(items, lambda x: ~x["media_type"].eqNullSafe("movie")).alias("serie"), items.isNull().alias("bad"),
    )
    lists = pages.groupBy("ID_OWNER").agg(
        (F.count_distinct("page") < F.max("pages")).alias("missing"), F.bool_or("bad").alias("bad"), *[F.coalesce(F.bool_or(k), F.lit(False)).alias(k) for k in ("movie", "serie")]
    )
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("SCOPE"), F.col(k).alias("any")) for k in ("movie", "serie")])).alias("k")
    outcome = F.when(F.col("bad"), MALFORMED).when(F.coalesce("missing", F.lit(False)), FAILED).when(F.col("k.any"), FILLED).otherwise(EMPTY)
    return lists.select("ID_OWNER", "missing", "bad", kinds).select(F.lit("LIST_MEMBER").alias("TABLE_NAME"), "ID_OWNER", "k.SCOPE", outcome.alias("OUTCOME"))


# Chains


def settle_entity(
    payloads: DataFrame, kind: str, ledger: DataFrame, now: Column, stored: Mapping[str, DataFrame], main: DataFrame | None = None, films: DataFrame | None = None, ratings: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The next state of every table of an entity kind, from its newest answers and what is stored.

    Detail and language rows are upserted (an invalid date or empty title leaves the old one), relation tables are settled by
    outcome, and the entity's own table gets the completion times of what was answered. Ids inside a retry window or whose
    details answer is unusable touch nothing. Lists without a poster take that of their best rated film (``films``, ``ratings``).
    """
    answers = sn.usable(payloads, kind, ledger, now)
    fresh = sn.tables_of(answers, kind, main)
    told = cut(outcomes(answers, kind, main), "outcomes")
    out = settle(stored, fresh, told, rules(kind))
    own, owner = kind.upper(), f"ID_{kind.upper()}"
    for name, rows in fresh.items():
        if name in out:
            continue
        keys = ["ID_EPISODE"] if name == "EPISODE" else [owner, "LANG"] if name.endswith("_LANG") else [owner]
        keep = {c: "skip_null" for c in rows.columns if c not in keys and (c in ("DAT_RELEASE", "TITLE") or kind in ("collection", "company", "network", "keyword"))}
        out[name] = merge.upsert(stored.get(name, rows.limit(0)), rows, keys, keep)
    if own in out:
        ends = {n: c for n in rules(kind) for end, c in STAMPS.items() if n == end or n == f"{own}_{end}"}
        out[own] = stamped(out[own], told, owner, ends, now)
    if kind == "list" and "LIST" in stored:
        films_ = out["LIST_MEMBER"].filter(F.col("KIND") == "movie")
        out["LIST"] = sn.list_poster(stored["LIST"], films_, films, ratings) if films is not None and ratings is not None else stored["LIST"]
    return out


def merged_episode_credits(stored: DataFrame, partial: DataFrame, full: DataFrame, told: DataFrame) -> DataFrame:
    """Credits of episodes from two sources: the full one has precedence over the part that a season's answer embeds.

    ``told`` are the outcomes of the full source, by episode. Where it answered, its rows are all there is, and what only the
    short source (or an earlier answer) gave goes. Elsewhere the short source's rows are merged in and nothing goes.
    """
    answered = told.filter(F.col("OUTCOME").isin(FILLED, EMPTY)).select(F.col("ID_OWNER").alias("ID_EPISODE")).distinct()
    short = partial.join(shuffled(answered), "ID_EPISODE", "left_anti")
    listed = short.select(F.col("ID_EPISODE").alias("ID_OWNER")).distinct().select("ID_OWNER", F.lit(None).cast("string").alias("SCOPE"), F.lit(FILLED).alias("OUTCOME"))
    both = settle({"PERSON_EPISODE": stored}, {"PERSON_EPISODE": short}, listed.withColumn("TABLE_NAME", F.lit("PERSON_EPISODE")), rules("season"))["PERSON_EPISODE"]
    return settle({"PERSON_EPISODE": both}, {"PERSON_EPISODE": full}, told, rules("episode"))["PERSON_EPISODE"]
