"""Catalogue snapshots: API payload documents to relational rows.

Input is a payload table (entity, id, endpoint, lang, fetched_at, payload). A payload
is parsed once to its top-level fields; lists are expanded, ordered and deduplicated
inside the row, so flattening never shuffles. Only owner-level replace and prune do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions import once, shuffled
from kgspark.functions.text import valid_iso_date
from kgspark.operators import merge
from kgspark.operators.ranking import latest_wins, pinned_order
from kgspark.session import cut

# Monetization modes, in storage order.
MODES = ("flatrate", "free", "ads", "rent", "buy")
IMAGE_LISTS = {"backdrops": "backdrop", "posters": "poster", "logos": "logo", "profiles": "profile", "stills": "still"}
SHORT_FILM_MINUTES = 58
RECENT_SEASON_DAYS, RECENT_EPISODE_DAYS, ACTIVE_LOOKBACK_DAYS = 120, 45, 90

_PERSON = "id BIGINT, name STRING, credit_id STRING, `character` STRING, department STRING, job STRING, `order` INT"
_LISTED = "id: BIGINT, credit_id: STRING, `character`: STRING, department: STRING, job: STRING"  # what a title's credits use of it
_IMAGE = "file_path STRING, iso_639_1 STRING, aspect_ratio DOUBLE, width INT, height INT, vote_average DOUBLE, vote_count INT"


class Fields:
    """Typed access to the top-level fields ``m`` (a map of raw texts) of a payload."""

    def __init__(self, m: Column):
        self.m = m

    def raw(self, key: str) -> Column:
        return F.try_element_at(self.m, F.lit(key))

    def has(self, key: str) -> Column:
        return F.coalesce(F.map_contains_key(self.m, key), F.lit(False))

    def text(self, key: str, limit: int | None = None, default: str = "") -> Column:
        """The field's text; ``default`` when it is absent, NULL when it is null."""
        value = F.when(self.has(key), self.raw(key)).otherwise(F.lit(default))
        return F.left(value, F.lit(limit)) if limit else value

    def filled(self, key: str, limit: int | None = None) -> Column:
        """The field's text or NULL when absent or empty (nothing to write)."""
        value = F.nullif(self.raw(key), F.lit(""))
        return F.left(value, F.lit(limit)) if limit else value

    def number(self, key: str, kind: str = "bigint") -> Column:
        return F.when(self.has(key), self.raw(key).try_cast(kind)).otherwise(F.lit(0).cast(kind))

    def flag(self, key: str) -> Column:
        return F.when(F.coalesce(self.raw(key) == "true", F.lit(False)), 1).otherwise(0)

    def tri_state(self, key: str) -> Column:
        return F.when(self.raw(key) == "true", 1).when(self.raw(key) == "false", 0)

    def sub(self, key: str, schema: str) -> Column:
        return F.from_json(self.raw(key), schema)

    def rows(self, key: str, fields: str) -> Column:
        return F.from_json(self.raw(key), f"ARRAY<STRUCT<{fields}>>")

    def date(self, key: str, name: str, prefix: str) -> list[Column]:
        parts = valid_iso_date(self.raw(key))
        return [
            F.when(parts["year"].isNotNull(), self.raw(key)).alias(name),
            *[parts[p].alias(f"{prefix}_{p.upper()}") for p in ("year", "month", "day")],
        ]


def listed(items: Column) -> Column:
    """'|a|b|' of a list in order, '|' when it is empty, '' when it is absent."""
    return F.when(items.isNull(), "").otherwise(
        F.concat(F.lit("|"), F.array_join(F.transform(items, lambda x: F.concat(x, F.lit("|"))), ""))
    )


def with_fields(payloads: DataFrame) -> DataFrame:
    """Payloads with their top-level fields as raw texts in ``m``: the one parse of each."""
    return once(payloads, m=F.from_json("payload", "MAP<STRING, STRING>"))


# Kinds whose payload rows share the id of their series or list, and the fields that tell them apart.
NUMBERED = {"season": ("season_number",), "episode": ("season_number", "episode_number"), "list": ("page",)}


def _numbered(payloads: DataFrame, kind: str) -> tuple[DataFrame, list[str]]:
    """The payloads with what tells their fetches apart: (entity, id, endpoint, language), of seasons, episodes and list
    pages their numbers too."""
    numbers = {f"_{k}": F.get_json_object("payload", f"$.{k}") for k in NUMBERED.get(kind, ())}
    return payloads.withColumns(numbers) if numbers else payloads, ["entity", "id", "endpoint", "lang", *numbers]


def _at(payloads: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """Payloads that meet a narrow head by ``keys`` (NULL equals NULL). Hashed by head: the wide rows move once and are not sorted."""
    named = heads.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)])
    same = [payloads[k] == named[f"_h{i}"] if k == "id" else payloads[k].eqNullSafe(named[f"_h{i}"]) for i, k in enumerate(keys)]
    return payloads.join(named.hint("shuffle_hash"), same, "left_semi")


def newest(payloads: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """The latest fetch of every key; equal times are settled by the text.

    ``heads`` are the keys and times of the fetches, written before, so that payloads are looked up by them. Only payloads
    of one key and time are compared. Fetches without an id are left out.
    """
    per_time = heads.groupBy(*keys, "fetched_at").agg(F.count(F.lit(1)).alias("_n"))
    last = cut(per_time.groupBy(*keys).agg(F.max(F.struct("fetched_at", "_n")).alias("_l")).select(*keys, "_l.*"), "latest")
    alone = _at(payloads, last.filter(F.col("_n") == 1), [*keys, "fetched_at"])
    tied = last.filter(F.col("_n") > 1)
    if tied.isEmpty():
        return alone
    return alone.unionByName(latest_wins(_at(payloads, tied, [*keys, "fetched_at"]), keys, ["payload"]))


def _usable_ids(payloads: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """Ids whose newest first answer (of any language) is usable; ``heads`` are those of first answers and tell if they are (``_ok``).

    Texts are read only where answers of one time disagree.
    """
    per_time = heads.groupBy(*keys, "fetched_at").agg(F.bool_and("_ok").alias("_all"), F.bool_or("_ok").alias("_any"))
    last = cut(per_time.groupBy(*keys).agg(F.max(F.struct("fetched_at", "_all", "_any")).alias("_l")).select(*keys, "_l.*"), "answers")
    ok, unclear = last.filter("_all").select("id"), last.filter(F.col("_any") & ~F.col("_all"))
    if not unclear.isEmpty():
        texts = latest_wins(_at(payloads, unclear, [*keys, "fetched_at"]).select(*keys, "payload"), keys, ["payload"])
        ok = ok.union(texts.filter(merge.fetch_outcome(F.col("payload")) == "ok").select("id"))
    return ok.distinct()


def documents(payloads: DataFrame, entity: str, endpoint: str) -> DataFrame:
    """Usable payloads of one endpoint with their top-level fields in ``m``."""
    mine = payloads.filter((F.col("entity") == entity) & (F.col("endpoint") == endpoint))
    parsed = mine if "m" in payloads.columns else with_fields(mine)
    status = F.coalesce(F.try_element_at("m", F.lit("status_code")).try_cast("int"), F.lit(0))
    return parsed.filter(F.col("m").isNotNull() & (status <= 1))


def listing(payloads: DataFrame, entity: str, endpoint: str, **fields: str) -> DataFrame:
    """Usable payloads of one endpoint with the named top-level fields in ``k``, read as the given types by one parse.

    Nothing is copied as raw text to be parsed again, and other fields are skipped. What that parse cannot read whole goes by
    the raw texts of ``documents``, so that a malformed field does not touch its neighbours; so does a payload that has
    them already.
    """
    mine, whole = payloads.filter((F.col("entity") == entity) & (F.col("endpoint") == endpoint)), F.lit(False)
    if "m" not in payloads.columns:
        schema = ", ".join(["status_code STRING", *[f"`{n}` {kind}" for n, kind in fields.items()], "_text STRING"])
        objects = F.when(F.col("payload").startswith("{"), F.col("payload"))
        mine = once(mine, e=F.from_json(objects, schema, {"columnNameOfCorruptRecord": "_text"}))
        whole = F.col("e").isNotNull() & F.col("e._text").isNull()
        mine = once(mine, m=F.when(~whole, F.from_json("payload", "MAP<STRING, STRING>")))
    raw = _fields()
    status = F.when(whole, F.col("e.status_code")).otherwise(raw.raw("status_code")) if "e" in mine.columns else raw.raw("status_code")
    usable_ = mine.filter((whole | F.col("m").isNotNull()) & (F.coalesce(status.try_cast("int"), F.lit(0)) <= 1))
    parsed = {n: raw.sub(n, kind) for n, kind in fields.items()}
    if "e" in mine.columns:
        parsed = {n: F.when(whole, F.col(f"e.{n}")).otherwise(x) for n, x in parsed.items()}
    return once(usable_, k=F.struct(*[x.alias(n) for n, x in parsed.items()])).drop("e", "m")


def _fields() -> Fields:
    return Fields(F.col("m"))


def movie_details(payloads: DataFrame) -> DataFrame:
    """Scalar film columns. DAT_RELEASE is NULL when invalid and must not overwrite."""
    f = _fields()
    genres = f.rows("genres", "name STRING")
    names = F.transform(genres, lambda g: g["name"])
    documentary = F.coalesce(F.array_contains(names, "Documentary"), F.lit(False))
    runtime = F.coalesce(f.number("runtime", "int"), F.lit(0))
    return documents(payloads, "movie", "details").select(
        F.col("id").alias("ID_MOVIE"),
        F.coalesce(f.text("imdb_id"), F.lit("")).alias("ID_IMDB"),
        F.coalesce(f.sub("external_ids", "STRUCT<wikidata_id: STRING>")["wikidata_id"], F.lit("")).alias("ID_WIKIDATA"),
        f.text("overview").alias("OVERVIEW"),
        *f.date("release_date", "DAT_RELEASE", "RELEASE"),
        f.flag("video").alias("VIDEO"),
        f.text("poster_path").alias("POSTER_PATH"),
        f.text("homepage", 500).alias("HOMEPAGE_URL"),
        f.text("title", 250).alias("TITLE"),
        f.text("original_language").alias("ORIGINAL_LANGUAGE"),
        f.number("popularity", "double").alias("POPULARITY"),
        f.text("backdrop_path").alias("BACKDROP_PATH"),
        f.text("original_title", 250).alias("ORIGINAL_TITLE"),
        f.text("status").alias("STATUS"),
        listed(names).alias("GENRES"),
        F.coalesce(f.sub("belongs_to_collection", "STRUCT<id: BIGINT>")["id"], F.lit(0)).alias("ID_COLLECTION"),
        f.flag("adult").alias("ADULT"),
        f.number("budget").alias("BUDGET"),
        runtime.alias("RUNTIME"),
        F.when((runtime > 0) & (runtime <= SHORT_FILM_MINUTES), 1).otherwise(0).alias("IS_SHORT_FILM"),
        f.number("revenue").alias("REVENUE"),
        f.text("tagline").alias("TAGLINE"),
        f.number("vote_average", "double").alias("VOTE_AVERAGE"),
        f.number("vote_count").alias("VOTE_COUNT"),
        listed(F.transform(f.rows("production_countries", "iso_3166_1 STRING"), lambda x: x["iso_3166_1"])).alias("COUNTRIES"),
        listed(F.transform(f.rows("spoken_languages", "iso_639_1 STRING"), lambda x: x["iso_639_1"])).alias("SPOKEN_LANGUAGES"),
        F.when(documentary, 1).otherwise(0).alias("IS_DOCUMENTARY"),
        F.when(documentary, 0).otherwise(1).alias("IS_MOVIE"),
    )


def _episode_signal(f: Fields, key: str, prefix: str) -> list[Column]:
    e = f.sub(key, "STRUCT<air_date: STRING, season_number: INT, episode_number: INT>")
    return [
        F.when(valid_iso_date(e["air_date"])["year"].isNotNull(), e["air_date"]).alias(f"{prefix}_DAT_AIR"),
        e["season_number"].alias(f"{prefix}_SEASON_NUMBER"),
        e["episode_number"].alias(f"{prefix}_NUMBER"),
    ]


def serie_details(payloads: DataFrame) -> DataFrame:
    """Scalar series columns and the signals of an active series."""
    f = _fields()
    ids = f.sub("external_ids", "STRUCT<imdb_id: STRING, wikidata_id: STRING, tvdb_id: BIGINT>")
    return documents(payloads, "serie", "details").select(
        F.col("id").alias("ID_SERIE"),
        F.coalesce(ids["imdb_id"], F.lit("")).alias("ID_IMDB"),
        F.coalesce(ids["wikidata_id"], F.lit("")).alias("ID_WIKIDATA"),
        F.nullif(ids["tvdb_id"], F.lit(0)).alias("ID_TVDB"),
        f.text("overview").alias("OVERVIEW"),
        *f.date("first_air_date", "DAT_FIRST_AIR", "FIRST_AIR"),
        *f.date("last_air_date", "DAT_LAST_AIR", "LAST_AIR"),
        f.text("poster_path").alias("POSTER_PATH"),
        f.text("homepage", 500).alias("HOMEPAGE_URL"),
        f.text("name", 250).alias("TITLE"),
        f.text("original_language").alias("ORIGINAL_LANGUAGE"),
        f.number("popularity", "double").alias("POPULARITY"),
        f.text("backdrop_path").alias("BACKDROP_PATH"),
        f.text("original_name", 250).alias("ORIGINAL_TITLE"),
        f.text("status").alias("STATUS"),
        listed(F.transform(f.rows("genres", "name STRING"), lambda g: g["name"])).alias("GENRES"),
        f.flag("adult").alias("ADULT"),
        f.text("tagline").alias("TAGLINE"),
        f.number("vote_average", "double").alias("VOTE_AVERAGE"),
        f.number("vote_count").alias("VOTE_COUNT"),
        listed(F.transform(f.rows("production_countries", "iso_3166_1 STRING"), lambda x: x["iso_3166_1"])).alias("COUNTRIES"),
        listed(F.transform(f.rows("spoken_languages", "iso_639_1 STRING"), lambda x: x["iso_639_1"])).alias("SPOKEN_LANGUAGES"),
        f.number("number_of_episodes").alias("NUMBER_OF_EPISODES"),
        f.number("number_of_seasons").alias("NUMBER_OF_SEASONS"),
        f.text("type").alias("SERIE_TYPE"),
        f.tri_state("in_production").alias("IN_PRODUCTION"),
        *_episode_signal(f, "next_episode_to_air", "NEXT_EPISODE"),
        *_episode_signal(f, "last_episode_to_air", "LAST_EPISODE"),
    )


def person_details(payloads: DataFrame) -> DataFrame:
    f = _fields()
    return documents(payloads, "person", "details").select(
        F.col("id").alias("ID_PERSON"),
        F.coalesce(f.text("imdb_id"), F.lit("")).alias("ID_IMDB"),
        F.coalesce(f.sub("external_ids", "STRUCT<wikidata_id: STRING>")["wikidata_id"], F.lit("")).alias("ID_WIKIDATA"),
        f.raw("biography").alias("BIOGRAPHY"),
        *f.date("birthday", "BIRTHDAY", "BIRTH"),
        *f.date("deathday", "DEATHDAY", "DEATH"),
        f.raw("gender").try_cast("int").alias("GENDER"),
        f.raw("profile_path").alias("PROFILE_PATH"),
        F.left(f.raw("homepage"), F.lit(250)).alias("HOMEPAGE_URL"),
        f.raw("name").alias("NAME"),
        # A missing place is stored as the text None.
        F.left(F.btrim(F.coalesce(f.raw("place_of_birth"), F.lit("None"))), F.lit(200)).alias("PLACE_OF_BIRTH"),
        f.raw("popularity").try_cast("double").alias("POPULARITY"),
        f.raw("known_for_department").alias("KNOWN_FOR_DEPARTMENT"),
        f.flag("adult").alias("ADULT"),
        listed(f.sub("also_known_as", "ARRAY<STRING>")).alias("ALSO_KNOWN_AS"),
    )


def _date_of(x: Column, name: str, prefix: str) -> list[Column]:
    parts = valid_iso_date(x)
    return [F.when(parts["year"].isNotNull(), x).alias(name), *[parts[p].alias(f"{prefix}_{p.upper()}") for p in ("year", "month", "day")]]


_EPISODE = (
    "id BIGINT, air_date STRING, name STRING, overview STRING, season_number INT, episode_number INT, runtime INT, "
    "production_code STRING, episode_type STRING, still_path STRING, vote_average DOUBLE, vote_count INT, "
    f"crew ARRAY<STRUCT<{_PERSON}>>, guest_stars ARRAY<STRUCT<{_PERSON}>>"
)


def season_details(payloads: DataFrame) -> DataFrame:
    """Season rows; the payload row's ``id`` is the series id."""
    f = _fields()
    blank = lambda k: F.coalesce(f.raw(k), F.lit(""))
    episodes = F.size(F.coalesce(f.rows("episodes", "id BIGINT"), F.array().cast("array<struct<id:bigint>>")))
    return documents(payloads, "season", "details").filter(f.has("id")).select(
        f.raw("id").try_cast("bigint").alias("ID_SEASON"),
        F.col("id").alias("ID_SERIE"),
        f.raw("season_number").try_cast("int").alias("SEASON_NUMBER"),
        F.left(blank("name"), F.lit(250)).alias("TITLE"),
        blank("overview").alias("OVERVIEW"),
        *f.date("air_date", "DAT_AIR", "AIR"),
        blank("poster_path").alias("POSTER_PATH"),
        F.nullif(episodes, F.lit(0)).alias("EPISODE_COUNT"),
        f.number("vote_average", "double").alias("VOTE_AVERAGE"),
    )


def episode_rows(payloads: DataFrame) -> DataFrame:
    """Episodes embedded in season payloads."""
    f = _fields()
    rows = documents(payloads, "season", "details").select(
        F.col("id").alias("ID_SERIE"), f.raw("id").try_cast("bigint").alias("ID_SEASON"), F.explode_outer(f.rows("episodes", _EPISODE)).alias("e")
    )
    e = F.col("e")
    blank = lambda k: F.coalesce(e[k], F.lit(""))
    return rows.filter(F.col("e.id").isNotNull()).select(
        F.col("e.id").alias("ID_EPISODE"), "ID_SERIE", "ID_SEASON", e["season_number"].alias("SEASON_NUMBER"), e["episode_number"].alias("EPISODE_NUMBER"),
        F.left(blank("name"), F.lit(250)).alias("TITLE"), blank("overview").alias("OVERVIEW"), *_date_of(e["air_date"], "DAT_AIR", "AIR"),
        e["runtime"].alias("RUNTIME"), blank("production_code").alias("PRODUCTION_CODE"), blank("episode_type").alias("EPISODE_TYPE"), blank("still_path").alias("STILL_PATH"),
        F.coalesce(e["vote_average"], F.lit(0.0)).alias("VOTE_AVERAGE"), F.coalesce(e["vote_count"], F.lit(0)).alias("VOTE_COUNT"),
    )


# Relation lists of a title: (payload list, item field, type, column). None prunes when empty.
RELATIONS = {
    "GENRE": ("genres", "id", "BIGINT", "ID_GENRE"),
    "PRODUCTION_COUNTRY": ("production_countries", "iso_3166_1", "STRING", "COUNTRY_CODE"),
    "SPOKEN_LANGUAGE": ("spoken_languages", "iso_639_1", "STRING", "SPOKEN_LANGUAGE"),
    "COMPANY": ("production_companies", "id", "BIGINT", "ID_COMPANY"),
    "NETWORK": ("networks", "id", "BIGINT", "ID_NETWORK"),
}


def title_relations(payloads: DataFrame, entity: str, relation: str) -> DataFrame:
    """(owner, value, DISPLAY_ORDER); a value listed twice keeps its last position."""
    key, field, kind, column = RELATIONS[relation]
    owner = f"ID_{entity.upper()}"
    docs = listing(payloads, entity, "details", **{key: f"ARRAY<STRUCT<{field}: {kind}>>"})
    rows = docs.select(F.col("id").alias(owner), F.posexplode(f"k.{key}").alias("p", "x"))
    return rows.groupBy(owner, F.col(f"x.{field}").alias(column)).agg(F.max(F.col("p") + 1).alias("DISPLAY_ORDER"))


def _credit(x: Column, kind: str, order: Column, limit: int | None = None) -> Column:
    """Uniform credit struct; crew has no character, cast no department and job."""
    crew = kind == "crew"
    character = F.lit("") if crew else x["character"]
    return F.struct(
        x["id"].alias("ID_PERSON"),
        x["credit_id"].alias("ID_CREDIT"),
        (F.left(F.coalesce(character, F.lit("")), F.lit(limit)) if limit else character).alias("CAST_CHARACTER"),
        (x["department"] if crew else F.lit("")).alias("CREW_DEPARTMENT"),
        (x["job"] if crew else F.lit("")).alias("CREW_JOB"),
        F.lit(kind).alias("CREDIT_TYPE"),
        order.cast("int").alias("DISPLAY_ORDER"),
    )


#: Persons in a list up to which a credit's place is looked up person by person.
FEW_PERSONS = 64


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sorted_places(ids: dict[str, Column]) -> Column:
    """Of every entry of the lists, one after the other: the first place of its person in each list, by sorting."""

    def numbered(n: int, persons: Column) -> Column:
        return F.transform(persons, lambda v, i: F.struct(v.alias("v"), F.lit(n).alias("n"), (i + 1).alias("i")))

    pairs = F.array_sort(F.concat(*[numbered(n, persons) for n, persons in enumerate(ids.values())]))
    start = lambda p, i: (i == 0) | ~F.get(p, i - 1)["v"].eqNullSafe(F.get(p, i)["v"])

    def run(p: Column, starts: Column, s: Column, j: Column) -> Column:
        return F.slice(p, s + 1, F.coalesce(F.get(starts, j + 1), F.size(p)) - s)

    def first(entries: Column, n: int) -> Column:
        return F.array_min(F.transform(F.filter(entries, lambda e: e["n"] == n), lambda e: e["i"]))

    def placed(p: Column, starts: Column) -> Column:
        def entries(s: Column, j: Column) -> Column:
            mine = run(p, starts, s, j)
            return _let(F.struct(*[first(mine, n).alias(name) for n, name in enumerate(ids)]), lambda f: F.transform(mine, lambda e: F.struct(e["n"].alias("n"), e["i"].alias("i"), f.alias("f"))))

        return F.transform(F.array_sort(F.flatten(F.transform(starts, entries))), lambda e: e["f"])

    return _let(pairs, lambda p: _let(F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: start(p, i)), lambda starts: placed(p, starts)))


def _credit_entries(payloads: DataFrame, entity: str, owner: str) -> DataFrame:
    """One row per listed credit: owner, ``_kind`` (cast, crew or maker), ``_at`` (1-based place in its list), ``x``, and as
    ``_in_…`` the first place of its person in each list; for series also ``_doc`` and ``_last``, the position that the
    last crew row, or else the last cast row, will get.

    Places are found inside the document: nothing is shuffled or sorted as rows. Lists of few persons are looked up, others
    sorted, so a list of any length costs no more than sorting it.
    """
    maker = entity == "serie"
    people = f"ARRAY<STRUCT<{_LISTED}>>"
    docs = listing(payloads, entity, "details", credits=f"STRUCT<`cast`: {people}, crew: {people}>", **({"created_by": people} if maker else {}))
    sides = {"cast": "k.credits.cast", "crew": "k.credits.crew"} | ({"maker": "k.created_by"} if maker else {})
    lists = [F.coalesce(x, F.array().cast(people)).alias(f"_{n}") for n, x in sides.items()]
    own = [F.monotonically_increasing_id().alias("_doc")] if maker else []
    base = once(docs.select(F.col("id").alias(owner), *own, *lists), **{f"_{n}_ids": F.col(f"_{n}.id") for n in sides})
    base = once(base, **{f"_{n}_of": F.array_distinct(f"_{n}_ids") for n in sides})
    ids = {n: F.col(f"_{n}_ids") for n in sides}
    many = F.greatest(*[F.size(f"_{n}_of") for n in sides]) > FEW_PERSONS
    firsts = lambda n: F.transform(f"_{n}_of", lambda person: F.array_position(ids[n], person).cast("int"))
    looked_up = {f"_{n}_at": F.when(~many, firsts(n)) for n in sides}
    if maker:
        end = lambda n: F.array_position(ids[n], F.try_element_at(ids[n], F.lit(-1)))  # noqa: E731  one search a document
        moved = F.when(F.array_contains(ids["maker"], F.try_element_at(ids["crew"], F.lit(-1))), 1).otherwise(0)
        last = F.coalesce(F.when(F.size("_crew") > 0, end("crew") + moved), end("cast"), F.lit(0)).cast("int")
        looked_up["_last"] = last
    base = once(base, _places=F.when(many, _sorted_places(ids)), **looked_up)
    before, parts = F.lit(0), []
    for n in sides:
        parts.append(F.struct(F.lit(n).alias("_kind"), before.alias("_before"), F.col(f"_{n}").alias("_list")))
        before = before + F.size(f"_{n}")
    kept = [owner, *(["_doc", "_last"] if maker else [])]
    unfolded = base.select(*kept, "_places", *[f"_{n}_{x}" for n in sides for x in ("of", "at")], F.inline(F.array(*parts)))
    rows = unfolded.select(*[c for c in unfolded.columns if c != "_list"], F.posexplode("_list").alias("_i", "x"))

    def first(n: str) -> Column:
        among = F.array_position(f"_{n}_of", F.col("x.id")).cast("int") - 1
        found = F.when(F.col("_places").isNull(), F.get(f"_{n}_at", among)).otherwise(F.get("_places", F.col("_before") + F.col("_i"))[n])
        return F.when(F.col("x.id").isNotNull(), found)  # a credit without a person has no place

    return rows.select(*kept, "_kind", (F.col("_i") + 1).alias("_at"), "x", *[first(n).alias(f"_in_{n}") for n in sides])


def title_credits(payloads: DataFrame, entity: str = "movie") -> DataFrame:
    """Cast and crew rows; for series also the creators, as crew of their own job.

    A person's later credits reuse the place of the first one in the same list. A creator among the crew gets an extra
    row at the crew place, and the crew rows move one on; creators credited nowhere follow the last place handed out.
    """
    from pyspark.sql.window import Window

    owner, serie = f"ID_{entity.upper()}", entity == "serie"
    rows = _credit_entries(payloads, entity, owner)
    x, kind = F.col("x"), F.col("_kind")
    moved = F.col("_in_crew") + (F.when(F.col("_in_maker").isNotNull(), 1).otherwise(0) if serie else 0)
    as_cast, as_crew = _credit(x, "cast", F.col("_in_cast")), _credit(x, "crew", moved)
    out = rows.filter(kind != "maker").select(owner, F.when(kind == "cast", as_cast).otherwise(as_crew).alias("c"))
    if serie:
        rows = cut(rows.filter((kind == "maker") & F.col("x.id").isNotNull()), "makers")

        def creator(order: Column) -> Column:
            return F.struct(
                x["id"].alias("ID_PERSON"), x["credit_id"].alias("ID_CREDIT"), F.lit("").alias("CAST_CHARACTER"), F.lit("Creator").alias("CREW_DEPARTMENT"),
                F.lit("Creator").alias("CREW_JOB"), F.lit("crew").alias("CREDIT_TYPE"), order.cast("int").alias("DISPLAY_ORDER"),
            )

        working = rows.filter(F.col("_in_crew").isNotNull() & (F.col("_at") == F.col("_in_maker"))).select(owner, creator(F.col("_in_crew")).alias("c"))
        absent = rows.filter(F.col("_in_crew").isNull() & F.col("_in_cast").isNull())
        nth = F.row_number().over(Window.partitionBy("_doc").orderBy("_at"))
        out = out.union(working).union(absent.select(owner, creator(F.col("_last") + nth).alias("c")))
    return out.select(owner, "c.*")


def person_credits(payloads: DataFrame, media: str) -> DataFrame:
    """A person's combined credits in films (media 'movie') or series ('tv')."""
    fields = f"{_PERSON}, media_type STRING"
    lists = f"STRUCT<`cast`: ARRAY<STRUCT<{fields}>>, crew: ARRAY<STRUCT<{fields}>>>"
    docs = once(documents(payloads, "person", "details"), k=_fields().sub("combined_credits", lists))
    empty = F.array().cast(f"array<struct<{fields}>>")

    def side(name: str) -> Column:
        mine = F.filter(F.coalesce(F.col(f"k.{name}"), empty), lambda x: x["media_type"] == media)
        return F.transform(mine, lambda x: _credit(x, name, F.lit(None)))

    rows = docs.select(F.col("id").alias("ID_PERSON"), F.explode(F.concat(side("cast"), side("crew"))).alias("c"))
    title = "ID_MOVIE" if media == "movie" else "ID_SERIE"
    return rows.select(
        "ID_PERSON", F.col("c.ID_PERSON").alias(title), "c.ID_CREDIT", "c.CAST_CHARACTER", "c.CREW_DEPARTMENT", "c.CREW_JOB", "c.CREDIT_TYPE"
    )


def episode_credits(payloads: DataFrame, source: str = "episode") -> DataFrame:
    """Cast, crew and guest rows of episodes.

    ``source="season"`` reads the partial lists embedded in season payloads (to be
    merged); ``"episode"`` reads the dedicated payload, whose absences purge.
    """
    people = f"ARRAY<STRUCT<{_PERSON}>>"
    empty = F.array().cast(f"array<struct<{_PERSON}>>")
    f = _fields()
    if source == "season":
        docs = documents(payloads, "season", "details")
        eps = docs.select(f.raw("id").try_cast("bigint").alias("ID_SEASON"), F.explode_outer(f.rows("episodes", _EPISODE)).alias("e"))
        base = eps.filter(F.col("e.id").isNotNull()).select(
            F.col("e.id").alias("ID_EPISODE"), empty.alias("a"), F.coalesce("e.crew", empty).alias("b"), F.coalesce("e.guest_stars", empty).alias("g")
        )
    else:
        part = lambda k: F.coalesce(f.sub(k, people), empty)
        base = documents(payloads, "episode", "credits").select(F.col("id").alias("ID_EPISODE"), part("cast").alias("a"), part("crew").alias("b"), part("guest_stars").alias("g"))

    def rows(name: str, kind: str) -> Column:
        placed = F.transform(F.col(name), lambda x, i: F.struct(x.alias("x"), F.coalesce(x["order"], i + 1).alias("o")))
        ok = F.filter(placed, lambda y: (F.coalesce(y["x"]["credit_id"], F.lit("")) != "") & (F.coalesce(y["x"]["id"], F.lit(0)) != 0))
        return F.transform(ok, lambda y: _credit(y["x"], kind, y["o"], 600))

    all_ = F.concat(rows("a", "cast"), rows("b", "crew"), rows("g", "guest"))
    return base.select("ID_EPISODE", F.explode(all_).alias("c")).select("ID_EPISODE", "c.*")


def season_credits(payloads: DataFrame) -> DataFrame:
    """Per-role season credits; the plain credits only where no aggregate exists."""
    role = "credit_id STRING, `character` STRING, episode_count INT, job STRING, department STRING"
    person = f"id BIGINT, `order` INT, department STRING, roles ARRAY<STRUCT<{role}>>, jobs ARRAY<STRUCT<{role}>>"
    f = _fields()
    docs = once(
        documents(payloads, "season", "details"),
        g=f.sub("aggregate_credits", f"STRUCT<`cast`: ARRAY<STRUCT<{person}>>, crew: ARRAY<STRUCT<{person}>>>"),
        k=f.sub("credits", f"STRUCT<`cast`: ARRAY<STRUCT<{_PERSON}>>, crew: ARRAY<STRUCT<{_PERSON}>>>"),
    )

    def row(pid: Column, credit: Column, character: Column, department: Column, job: Column, kind: str, order: Column, n: Column) -> Column:
        return F.struct(
            pid.alias("ID_PERSON"), credit.alias("ID_CREDIT"), F.left(F.coalesce(character, F.lit("")), F.lit(600)).alias("CAST_CHARACTER"),
            F.coalesce(department, F.lit("")).alias("CREW_DEPARTMENT"), F.coalesce(job, F.lit("")).alias("CREW_JOB"), F.lit(kind).alias("CREDIT_TYPE"),
            order.cast("int").alias("o"), n.cast("int").alias("TOTAL_EPISODE_COUNT"),
        )

    none, no_number = F.lit(None).cast("string"), F.lit(None).cast("int")
    cast_roles = F.flatten(F.transform("g.cast", lambda p: F.transform(p["roles"], lambda r: row(p["id"], r["credit_id"], r["character"], none, none, "cast", p["order"], r["episode_count"]))))
    crew_jobs = F.flatten(F.transform("g.crew", lambda p: F.transform(p["jobs"], lambda r: row(p["id"], r["credit_id"], none, F.coalesce(F.nullif(p["department"], F.lit("")), r["department"]), r["job"], "crew", no_number, r["episode_count"]))))
    plain_cast = F.transform("k.cast", lambda p: row(p["id"], p["credit_id"], p["character"], none, none, "cast", p["order"], no_number))
    plain_crew = F.transform("k.crew", lambda p: row(p["id"], p["credit_id"], none, p["department"], p["job"], "crew", no_number, no_number))
    empty = F.array().cast("array<struct<ID_PERSON:bigint,ID_CREDIT:string,CAST_CHARACTER:string,CREW_DEPARTMENT:string,CREW_JOB:string,CREDIT_TYPE:string,o:int,TOTAL_EPISODE_COUNT:int>>")
    rich = F.concat(F.coalesce(cast_roles, empty), F.coalesce(crew_jobs, empty))
    plain = F.concat(F.coalesce(plain_cast, empty), F.coalesce(plain_crew, empty))
    sequence = once(docs.withColumnRenamed("id", "ID_SERIE"), s=F.when(F.col("g").isNotNull(), rich).otherwise(plain))
    kept = F.filter("s", lambda x: (F.coalesce(x["ID_CREDIT"], F.lit("")) != "") & (F.coalesce(x["ID_PERSON"], F.lit(0)) != 0))
    numbered = F.transform(kept, lambda x, i: F.struct(x.alias("c"), F.coalesce(x["o"], i + 1).alias("n")))
    out = sequence.select(f.raw("id").try_cast("bigint").alias("ID_SEASON"), "ID_SERIE", F.explode(numbered).alias("y"))
    return out.select("ID_SEASON", "ID_SERIE", "y.c.*", F.col("y.n").alias("DISPLAY_ORDER")).drop("o")


def translated(payloads: DataFrame, entity: str) -> DataFrame:
    """Title and overview per language as they were answered, an empty title as well."""
    f = _fields()
    title = "title" if entity == "movie" else "name"
    return documents(payloads, entity, "details").filter(F.col("lang").isNotNull()).select(
        F.col("id").alias(f"ID_{entity.upper()}"), F.col("lang").alias("LANG"), f.text(title, 250).alias("TITLE"), f.text("overview").alias("OVERVIEW"),
        f.text("poster_path").alias("POSTER_PATH"), f.text("backdrop_path").alias("BACKDROP_PATH"), f.text("tagline").alias("TAGLINE"),
    )


def localized(payloads: DataFrame, entity: str) -> DataFrame:
    """Title and overview per language as they are stored; an empty title is not written."""
    return translated(payloads, entity).withColumn("TITLE", F.nullif("TITLE", F.lit("")))


def keywords(payloads: DataFrame, entity: str) -> DataFrame:
    """Keyword links in list order; films list them as keywords, series as results."""
    key = "keywords" if entity == "movie" else "results"
    docs = listing(payloads, entity, "keywords", **{key: "ARRAY<STRUCT<id: BIGINT, name: STRING>>"})
    rows = docs.select(F.col("id").alias(f"ID_{entity.upper()}"), F.posexplode(f"k.{key}").alias("p", "x"))
    return rows.select(f"ID_{entity.upper()}", F.col("x.id").alias("ID_KEYWORD"), F.col("x.name").alias("NAME"), (F.col("p") + 1).alias("DISPLAY_ORDER"))


def neighbours(payloads: DataFrame, entity: str, kind: str) -> DataFrame:
    """Similar or recommended titles with their rank; prune with on_empty='keep'."""
    column = "ID_NEIGHBOUR"
    docs = listing(payloads, entity, kind, results="ARRAY<STRUCT<id: BIGINT>>")
    rows = docs.select(F.col("id").alias(f"ID_{entity.upper()}"), F.posexplode("k.results").alias("p", "x"))
    return rows.select(f"ID_{entity.upper()}", F.col("x.id").alias(column), (F.col("p") + 1).alias("DISPLAY_ORDER"))


# Validators: a payload with any malformed part is rejected as a whole.


def _is(v: Column, path: str, kind: str) -> Column:
    shape = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return F.coalesce(shape.startswith(kind), F.lit(False))


def _all_of(v: Column, path: str, test) -> Column:
    """Every element of the array (or value of the object) at ``path`` passes."""
    return F.coalesce(F.forall(F.try_variant_get(v, path, "array<variant>"), test), F.lit(True))


def valid_release_dates(payload: Column) -> Column:
    v = F.try_parse_json(payload)

    def item(x: Column) -> Column:
        # An absent descriptor list is fine, a null one is not.
        absent = F.try_variant_get(x, "$.descriptors", "variant").isNull()
        return _is(x, "$.release_date", "STRING") & _is(x, "$.type", "BIGINT") & (absent | _is(x, "$.descriptors", "ARRAY"))

    def country(x: Column) -> Column:
        return _is(x, "$.iso_3166_1", "STRING") & _is(x, "$.release_dates", "ARRAY") & _all_of(x, "$.release_dates", item)

    return _is(v, "$.results", "ARRAY") & _all_of(v, "$.results", country)


def valid_watch_providers(payload: Column) -> Column:
    v = F.try_parse_json(payload)
    countries = F.map_values(F.try_variant_get(v, "$.results", "map<string,variant>"))

    def country(x: Column) -> Column:
        ok = _is(x, "$", "OBJECT")
        for mode in MODES:
            absent = F.try_variant_get(x, f"$.{mode}", "variant").isNull()
            listed_ = _is(x, f"$.{mode}", "ARRAY") & _all_of(x, f"$.{mode}", lambda p: _is(p, "$.provider_id", "BIGINT"))
            ok = ok & (absent | listed_)
        return ok

    return _is(v, "$.results", "OBJECT") & F.coalesce(F.forall(countries, country), F.lit(True))


def valid_provider_catalog(payload: Column) -> Column:
    v = F.try_parse_json(payload)
    results = F.try_variant_get(v, "$.results", "array<variant>")
    ids = F.transform(results, lambda x: F.try_variant_get(x, "$.provider_id", "bigint"))

    def provider(x: Column) -> Column:
        regions = F.try_variant_get(x, "$.display_priorities", "map<string,variant>")
        codes = F.forall(F.map_keys(regions), lambda k: F.length(k) == 2)
        numbers = F.forall(F.map_values(regions), lambda p: F.schema_of_variant(p) == "BIGINT")
        positive = F.coalesce(F.try_variant_get(x, "$.provider_id", "bigint") > 0, F.lit(False))
        return _is(x, "$.provider_id", "BIGINT") & positive & regions.isNotNull() & F.coalesce(codes & numbers, F.lit(True))

    distinct = F.size(F.array_distinct(ids)) == F.size(ids)
    return _is(v, "$.results", "ARRAY") & F.coalesce((F.size(results) > 0) & distinct & F.forall(results, provider), F.lit(False))


def validated(payloads: DataFrame, entity: str, endpoint: str, rule) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) payloads of one endpoint; failed fetches are in neither."""
    docs = once(documents(payloads, entity, endpoint), ok=rule(F.col("payload")))
    return docs.filter("ok").drop("ok"), docs.filter(~F.col("ok")).drop("ok", "m")


def release_dates(valid: DataFrame) -> DataFrame:
    """Country × release rows with the UTC time of each release."""
    item = "release_date STRING, type INT, iso_639_1 STRING, certification STRING, note STRING, descriptors ARRAY<STRING>"
    rows = valid.select("id", F.posexplode(_fields().rows("results", f"iso_3166_1 STRING, release_dates ARRAY<STRUCT<{item}>>")).alias("c", "x"))
    rows = rows.select("id", "c", "x.iso_3166_1", F.posexplode("x.release_dates").alias("p", "r"))
    utc = F.to_utc_timestamp(F.try_to_timestamp(F.col("r.release_date")), "UTC")
    return rows.select(
        F.col("id").alias("ID_MOVIE"), F.left("iso_3166_1", F.lit(2)).alias("COUNTRY_CODE"), F.col("r.iso_639_1").alias("LANG"), F.col("r.certification").alias("CERTIFICATION"),
        F.col("r.note").alias("NOTE"), F.left("r.release_date", F.lit(40)).alias("RELEASE_DATE_RAW"), F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("TIM_RELEASE"),
        F.col("r.type").alias("RELEASE_TYPE"), F.to_json(F.coalesce("r.descriptors", F.array().cast("array<string>"))).alias("DESCRIPTORS"),
        (F.col("c") + 1).alias("COUNTRY_ORDER"), (F.col("p") + 1).alias("DISPLAY_ORDER"),
    )


def watch_providers(valid: DataFrame, owner: str) -> DataFrame:
    """Country × mode × provider rows."""
    provider = "provider_id BIGINT, provider_name STRING, logo_path STRING, display_priority INT"
    modes = ", ".join(f"{m}: ARRAY<STRUCT<{provider}>>" for m in MODES)
    countries = valid.select("id", F.posexplode(_fields().sub("results", f"MAP<STRING, STRUCT<link: STRING, {modes}>>")).alias("c", "code", "x"))
    lists = F.array(*[F.struct(F.lit(m).alias("mode"), F.col(f"x.{m}").alias("providers")) for m in MODES])
    by_mode = countries.select("id", "c", "code", "x.link", F.explode(lists).alias("l")).filter(F.col("l.providers").isNotNull())
    rows = by_mode.select("id", "c", "code", "link", "l.mode", F.posexplode("l.providers").alias("p", "w"))
    return rows.select(
        F.col("id").alias(owner), F.left("code", F.lit(2)).alias("COUNTRY_CODE"), F.col("mode").alias("MONETIZATION_TYPE"), F.col("w.provider_id").alias("ID_PROVIDER"),
        F.left("w.provider_name", F.lit(250)).alias("PROVIDER_NAME"), F.left("w.logo_path", F.lit(200)).alias("LOGO_PATH"), F.col("w.display_priority").alias("DISPLAY_PRIORITY"),
        F.left("link", F.lit(1000)).alias("LINK"), (F.col("c") + 1).alias("COUNTRY_ORDER"), (F.col("p") + 1).alias("DISPLAY_ORDER"),
    )


def provider_catalog(valid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalogue rows, regional priorities) of the validated provider catalogues; ``lang`` holds the content type."""
    fields = "provider_id BIGINT, provider_name STRING, logo_path STRING, display_priorities MAP<STRING, INT>"
    rows = valid.select(F.col("lang").alias("CONTENT_TYPE"), "fetched_at", F.posexplode(_fields().rows("results", fields)).alias("p", "x"))
    catalog = rows.select(
        F.col("x.provider_id").alias("ID_PROVIDER"), "CONTENT_TYPE", F.left("x.provider_name", F.lit(250)).alias("PROVIDER_NAME"), F.left("x.logo_path", F.lit(200)).alias("LOGO_PATH"),
        (F.col("p") + 1).alias("DISPLAY_ORDER"), F.col("fetched_at").alias("TIM_PROVIDER_UPDATED"),
    )
    regions = rows.select(F.col("x.provider_id").alias("ID_PROVIDER"), "CONTENT_TYPE", F.posexplode("x.display_priorities").alias("r", "code", "priority"))
    return catalog, regions.select(
        "ID_PROVIDER", "CONTENT_TYPE", F.upper("code").alias("COUNTRY_CODE"), F.col("priority").alias("PROVIDER_DISPLAY_PRIORITY"), (F.col("r") + 1).alias("DISPLAY_ORDER")
    )


def provider_identities(catalog: DataFrame, current: DataFrame, now: Column) -> DataFrame:
    """Shared provider rows: film catalogue first, then series; vanished ones soft-deleted."""
    side = lambda kind: catalog.filter(F.col("CONTENT_TYPE") == kind)
    fresh = merge.coalesce_sides(side("movie"), side("serie"), "ID_PROVIDER", ["PROVIDER_NAME", "LOGO_PATH", "DISPLAY_ORDER"], "TIM_PROVIDER_UPDATED")
    fresh = fresh.withColumn("DELETED", F.lit(0)).withColumn("TIM_UPDATED", now)
    merged = merge.upsert(current, fresh, ["ID_PROVIDER"])
    return merge.soft_delete_absent(merged, catalog, "ID_PROVIDER", now)


def catalog_state(catalog: DataFrame, regions: DataFrame) -> DataFrame:
    """Providers and regional relations per content type."""
    tagged = catalog.select("CONTENT_TYPE", F.lit(1).alias("_c")).union(regions.select("CONTENT_TYPE", F.lit(0)))
    return tagged.groupBy("CONTENT_TYPE").agg(
        F.count_if(F.col("_c") == 1).alias("PROVIDER_COUNT"), F.count_if(F.col("_c") == 0).alias("REGION_RELATION_COUNT")
    )


def images(payloads: DataFrame, entity: str, main: DataFrame | None = None, main_type: str = "poster") -> DataFrame:
    """Image rows of every list, main images pinned to the front.

    ``main`` is (id, base path, array of localized (path, lang)); a pinned image the
    endpoint did not return is added. Prune with on_empty='delete'.
    """
    f = _fields()
    docs = documents(payloads, entity, "images")
    if main is None:
        docs = docs.withColumn("_base", F.lit(None).cast("string")).withColumn("_local", F.array().cast("array<struct<path:string,lang:string>>"))
    else:
        m = main.select(F.col(main.columns[0]).alias("id"), F.col(main.columns[1]).alias("_base"), F.col(main.columns[2]).alias("_local"))
        # Only the lists meet the main images, and they are not sorted for it.
        lists = F.map_filter("m", lambda k, _: k.isin(*IMAGE_LISTS))
        docs = docs.select("id", lists.alias("m")).join(m.hint("shuffle_hash"), "id", "left")
    empty = F.array().cast("array<struct<path:string,lang:string,ratio:double,width:int,height:int,average:double,votes:int>>")
    docs = docs.withColumn("_local", F.coalesce("_local", F.array().cast("array<struct<path:string,lang:string>>")))

    def entries(key: str) -> Column:
        rows = F.filter(f.rows(key, _IMAGE), lambda x: F.coalesce(x["file_path"], F.lit("")) != "")
        return F.transform(
            rows,
            lambda x: F.struct(
                x["file_path"].alias("path"), F.coalesce(x["iso_639_1"], F.lit("")).alias("lang"), F.coalesce(x["aspect_ratio"], F.lit(0.0)).alias("ratio"),
                F.coalesce(x["width"], F.lit(0)).alias("width"), F.coalesce(x["height"], F.lit(0)).alias("height"),
                F.coalesce(x["vote_average"], F.lit(0.0)).alias("average"), F.coalesce(x["vote_count"], F.lit(0)).alias("votes"),
            ),
        )

    listed_ = once(docs, **{k: F.coalesce(entries(k), empty) for k in IMAGE_LISTS})
    none = F.lit(None).cast("string")

    def typed(placed: Column, kind: str) -> Column:
        return F.transform(placed, lambda y: F.struct(F.lit(kind).alias("type"), y["position"].cast("int").alias("position"), y["image"].alias("image")))

    parts = []
    for key, kind in IMAGE_LISTS.items():
        base, local = (F.col("_base"), F.transform("_local", lambda x: x["path"])) if kind == main_type else (none, F.array().cast("array<string>"))
        placed = pinned_order(F.col(key), base, local)
        parts.append(typed(placed, kind))
    shown = F.flatten(F.array(*[F.transform(key, lambda x: x["path"]) for key in IMAGE_LISTS]))

    def injected(path: Column, lang: Column, order: int) -> Column:
        image = F.struct(
            path.alias("path"), lang.alias("lang"), F.lit(None).cast("double").alias("ratio"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("average"), F.lit(None).cast("int").alias("votes"),
        )
        return F.struct(F.lit(main_type).alias("type"), F.lit(order).alias("position"), image.alias("image"))

    missing = lambda p: (F.coalesce(p, F.lit("")) != "") & ~F.array_contains(shown, p)
    base_row = F.transform(F.filter(F.array(F.col("_base")), missing), lambda p: injected(p, F.lit("en"), 0))
    local_new = F.filter("_local", lambda x: missing(x["path"]) & ~(x["path"].eqNullSafe(F.col("_base"))))
    local_rows = F.transform(local_new, lambda x: injected(x["path"], F.coalesce(x["lang"], F.lit("")), 1))
    rows = listed_.select(F.col("id").alias(f"ID_{entity.upper()}"), F.explode(F.concat(*parts, base_row, local_rows)).alias("r"))
    return rows.select(
        f"ID_{entity.upper()}", F.col("r.type").alias("TYPE_IMAGE"), F.col("r.image.path").alias("IMAGE_PATH"), F.col("r.image.lang").alias("LANG"), F.col("r.position").alias("DISPLAY_ORDER"),
        F.col("r.image.ratio").alias("ASPECT_RATIO"), F.col("r.image.width").alias("WIDTH"), F.col("r.image.height").alias("HEIGHT"),
        F.col("r.image.average").alias("VOTE_AVERAGE"), F.col("r.image.votes").alias("VOTE_COUNT"),
    )


def videos(payloads: DataFrame, entity: str, zone: str = "Europe/Paris") -> DataFrame:
    """Video rows per requested language; publication time in the local zone.

    LANG is the row's own language and LANG_REQUESTED the payload's: prune by the latter.
    """
    fields = "id STRING, published_at STRING, type STRING, iso_639_1 STRING, iso_3166_1 STRING, `key` STRING, name STRING, site STRING, size INT, official BOOLEAN"
    rows = documents(payloads, entity, "videos").select(F.col("id").alias("_id"), "lang", F.posexplode(_fields().rows("results", fields)).alias("p", "v"))
    text = lambda k: F.coalesce(F.col(f"v.{k}"), F.lit(""))
    utc = F.try_to_timestamp(F.col("v.published_at"))
    size = F.coalesce("v.size", F.lit(0))
    return rows.filter(text("id") != "").select(
        F.col("_id").alias(f"ID_{entity.upper()}"), F.col("lang").alias("LANG_REQUESTED"), (F.col("p") + 1).alias("DISPLAY_ORDER"),
        F.date_format(F.from_utc_timestamp(utc, zone), "yyyy-MM-dd HH:mm:ss").alias("DAT_PUBLISHED"), text("type").alias("VIDEO_TYPE"), text("iso_639_1").alias("LANG"),
        text("iso_3166_1").alias("COUNTRY_CODE"), F.col("v.id").alias("ID_CREDIT"), text("key").alias("VIDEO_KEY"), text("name").alias("VIDEO_NAME"), text("site").alias("VIDEO_SITE"),
        size.alias("QUALITY"), F.concat(size.cast("string"), F.lit("p")).alias("QUALITY_TEXT"), F.coalesce("v.official", F.lit(False)).alias("OFFICIAL"),
    )


def simple_details(payloads: DataFrame, entity: str) -> DataFrame:
    """Collection, company, network and keyword rows; NULL means: leave as it is."""
    f = _fields()
    docs = documents(payloads, entity, "details")
    key = F.col("id").alias(f"ID_{entity.upper()}")
    if entity == "collection":
        return docs.select(key, f.text("overview").alias("OVERVIEW"), f.text("poster_path").alias("POSTER_PATH"), f.filled("name").alias("NAME"), f.text("backdrop_path").alias("BACKDROP_PATH"))
    if entity == "keyword":
        return docs.select(key, f.filled("name").alias("NAME"))
    limit = 200 if entity == "company" else None
    columns = [
        key, f.filled("logo_path").alias("LOGO_PATH"), f.filled("name").alias("NAME"), f.filled("headquarters", limit).alias("HEADQUARTERS"),
        f.filled("homepage", 500).alias("HOMEPAGE_URL"), f.filled("origin_country").alias("ORIGIN_COUNTRY"),
    ]
    if entity == "company":
        columns += [f.filled("description").alias("DESCRIPTION"), F.coalesce(f.sub("parent_company", "STRUCT<id: BIGINT>")["id"], F.lit(0)).alias("ID_PARENT")]
    return docs.select(*columns)


def list_members(payloads: DataFrame) -> DataFrame:
    """Members of lists over all their pages, one running order for films and series.

    The order is the number of items on earlier pages plus the position on the page;
    pages are counted, never gathered, so a list of any length is spread by page.
    """
    from pyspark.sql.window import Window

    f = _fields()
    docs = documents(payloads, "list", "page").select(F.col("id").alias("ID_LIST"), f.number("page", "int").alias("page"), f.rows("items", "id BIGINT, media_type STRING").alias("items"))
    before = Window.partitionBy("ID_LIST").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    sizes = docs.select("ID_LIST", "page", F.coalesce(F.size("items"), F.lit(0)).alias("n"))
    offsets = sizes.select("ID_LIST", "page", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"))
    rows = docs.select("ID_LIST", "page", F.posexplode("items").alias("p", "x")).join(offsets, ["ID_LIST", "page"])
    kind = F.when(F.col("x.media_type") == "movie", "movie").otherwise("serie")
    return rows.select("ID_LIST", kind.alias("KIND"), F.col("x.id").alias("ID_TITLE"), (F.col("o") + F.col("p") + 1).cast("int").alias("DISPLAY_ORDER"))


def list_poster(lists: DataFrame, members: DataFrame, films: DataFrame, ratings: DataFrame) -> DataFrame:
    """Lists without any poster take the poster of their best rated film."""
    rated = (
        members.select("ID_LIST", F.col("ID_TITLE").alias("ID_MOVIE"))
        .join(films.select("ID_MOVIE", "ID_IMDB", "POSTER_PATH").filter(F.col("POSTER_PATH").isNotNull()), "ID_MOVIE")
        .join(ratings.filter(F.col("RATING").isNotNull()), "ID_IMDB")
    )
    best = rated.groupBy("ID_LIST").agg(F.max_by("POSTER_PATH", F.struct(F.col("RATING"), -F.col("ID_MOVIE"))).alias("_best"))
    needs = (F.coalesce("POSTER_PATH", F.lit("")) == "") & F.col("_best").isNotNull()
    return lists.join(best, "ID_LIST", "left").withColumn("POSTER_PATH", F.when(needs, F.col("_best")).otherwise(F.col("POSTER_PATH"))).drop("_best")


def changed_children(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(series whose seasons changed, distinct (series, season, episode) hints)."""
    value = "STRUCT<season_number: INT, episode_number: INT>"
    rows = changes.select(F.col("id").alias("ID_SERIE"), F.explode(F.from_json("payload", f"STRUCT<changes: ARRAY<STRUCT<`key`: STRING, items: ARRAY<STRUCT<value: {value}>>>>>")["changes"]).alias("c"))
    seasons = rows.filter(F.col("c.key") == "seasons").select("ID_SERIE").distinct()
    hints = rows.filter(F.col("c.key") == "episodes").select("ID_SERIE", F.explode("c.items").alias("i")).select(
        "ID_SERIE", F.col("i.value.season_number").alias("SEASON_NUMBER"), F.col("i.value.episode_number").alias("EPISODE_NUMBER")
    )
    return seasons, hints.dropna().distinct()


def _incomplete() -> Column:
    stamps = ("TIM_CREDITS_COMPLETED", "TIM_TRANSLATIONS_COMPLETED", "TIM_IMAGES_COMPLETED", "TIM_VIDEOS_COMPLETED")
    out = F.col(stamps[0]).isNull()
    for s in stamps[1:]:
        out = out | F.col(s).isNull()
    return out


def _recent(today: Column, days: int) -> Column:
    return F.coalesce(F.datediff(today, F.col("DAT_AIR")).between(0, days), F.lit(False))


def latest_active_season(series: DataFrame, remote: DataFrame, today: Column) -> DataFrame:
    """Highest numbered season (above 0) of every series that is still active."""
    # The first known signal decides: in production, then a next episode, then the last one's age.
    alive = (F.col("IN_PRODUCTION") == 1) | F.col("NEXT_EPISODE_DAT_AIR").isNotNull() | (F.datediff(today, F.col("LAST_EPISODE_DAT_AIR")) <= ACTIVE_LOOKBACK_DAYS)
    active_ = series.filter(F.coalesce(alive, F.lit(False))).select("ID_SERIE")
    return remote.filter(F.col("SEASON_NUMBER") > 0).join(active_, "ID_SERIE", "left_semi").groupBy("ID_SERIE").agg(F.max("SEASON_NUMBER").alias("LATEST"))


def season_refresh_selection(remote: DataFrame, local: DataFrame, series: DataFrame, hints: DataFrame, today: Column) -> DataFrame:
    """Seasons to refresh with the first reason that applies.

    ``remote`` is (ID_SERIE, SEASON_NUMBER, EPISODE_COUNT) as the catalogue lists them.
    """
    keys = ["ID_SERIE", "SEASON_NUMBER"]
    known = local.select(*keys, F.col("EPISODE_COUNT").alias("_local"), "DAT_AIR", "TIM_CREDITS_COMPLETED", "TIM_TRANSLATIONS_COMPLETED", "TIM_IMAGES_COMPLETED", "TIM_VIDEOS_COMPLETED", F.lit(1).alias("_known"))
    hinted = hints.select(*keys).distinct().withColumn("_hint", F.lit(1))
    rows = remote.join(known, keys, "left").join(hinted, keys, "left").join(latest_active_season(series, remote, today), "ID_SERIE", "left")
    drift = F.col("EPISODE_COUNT").isNotNull() & ~F.col("EPISODE_COUNT").eqNullSafe(F.col("_local"))
    reason = (
        F.when(F.col("_known").isNull(), "missing locally")
        .when(drift, "episode count drift")
        .when(_incomplete(), "completion incomplete")
        .when(_recent(today, RECENT_SEASON_DAYS), "recent season")
        .when(F.col("SEASON_NUMBER") == F.col("LATEST"), "active series, latest season")
        .when(F.col("_hint") == 1, "episode hint")
    )
    return rows.withColumn("REASON", reason).filter(F.col("REASON").isNotNull()).select(*keys, "REASON")


def episode_refresh_selection(refreshed: DataFrame, local: DataFrame, latest: DataFrame, hints: DataFrame, today: Column) -> DataFrame:
    """Episodes of refreshed seasons to refresh with the first reason that applies."""
    keys = ["ID_SERIE", "SEASON_NUMBER", "EPISODE_NUMBER"]
    hinted = hints.select(*keys).distinct().withColumn("_hint", F.lit(1))
    rows = (
        local.filter(F.col("EPISODE_NUMBER").isNotNull())
        .join(refreshed.select("ID_SERIE", "SEASON_NUMBER").distinct(), ["ID_SERIE", "SEASON_NUMBER"], "left_semi")
        .join(hinted, keys, "left")
        .join(latest, "ID_SERIE", "left")
    )
    reason = (
        F.when(F.col("_hint") == 1, "episode hint")
        .when(_incomplete(), "completion incomplete")
        .when(_recent(today, RECENT_EPISODE_DAYS), "recent episode")
        .when(F.col("SEASON_NUMBER") == F.col("LATEST"), "active season")
    )
    return rows.withColumn("REASON", reason).filter(F.col("REASON").isNotNull()).select(*keys, "REASON")


def usable(payloads: DataFrame, kind: str, ledger: DataFrame, now: Column) -> DataFrame:
    """The newest answers of one kind, parsed once and written.

    Ids inside a retry window are left out, and so is an id whose newest details answer is not usable ("gone" or an error):
    the rest of the chain depends on it.
    """
    waiting = merge.in_retry_window(ledger.filter(F.col("ENTITY_TYPE") == kind), now).select(F.col("ID_ENTITY").alias("id"))
    mine, keys = _numbered(payloads.filter(F.col("entity") == kind), kind)
    first = F.col("endpoint") == {"list": "page", "episode": "credits"}.get(kind, "details")
    heads = mine.select(*keys, "fetched_at", F.when(first, merge.fetch_outcome(F.col("payload")) == "ok").alias("_ok"))
    heads = cut(heads.filter(F.col("id").isNotNull()), "heads")
    # An answer without numbers says nothing about the other seasons, episodes or pages of its id.
    ok = _usable_ids(mine.filter(first), heads.filter(first), keys if kind in NUMBERED else ["id"]).join(shuffled(waiting), "id", "left_anti")
    latest = newest(mine, heads.join(shuffled(ok), "id", "left_semi"), keys).select(*payloads.columns)
    # Of a parsed answer the text is kept only for endpoints that are validated as a whole.
    whole = F.when(F.col("endpoint").isin("release_dates", "watch_providers"), F.col("payload"))
    return cut(with_fields(latest).withColumn("payload", whole), "payloads", "zstd", wide=True)


def snapshot_entity(payloads: DataFrame, kind: str, ledger: DataFrame, now: Column) -> dict[str, DataFrame]:
    """Every table of one entity kind from its payloads alone; ``settled.settle_entity`` brings them into what is stored."""
    return tables_of(usable(payloads, kind, ledger, now), kind)


def tables_of(mine: DataFrame, kind: str, main: DataFrame | None = None) -> dict[str, DataFrame]:
    """The rows of every table of one kind; ``mine`` are usable answers, ``main`` the main images."""
    if kind == "movie":
        dated, _ = validated(mine, kind, "release_dates", valid_release_dates)
        watch, _ = validated(mine, kind, "watch_providers", valid_watch_providers)
        return {
            "MOVIE": movie_details(mine.filter(F.col("lang") == "en")),
            "MOVIE_LANG": localized(mine.filter(F.col("lang") == "fr"), kind),
            **{f"MOVIE_{r}": title_relations(mine.filter(F.col("lang") == "en"), kind, r) for r in RELATIONS if r != "NETWORK"},
            "PERSON_MOVIE": title_credits(mine.filter(F.col("lang") == "en"), kind),
            "MOVIE_KEYWORD": keywords(mine, kind),
            "MOVIE_SIMILAR": neighbours(mine, kind, "similar"),
            "MOVIE_RECOMMENDATION": neighbours(mine, kind, "recommendations"),
            "MOVIE_RELEASE_DATE": release_dates(dated),
            "MOVIE_WATCH_PROVIDER": watch_providers(watch, "ID_MOVIE"),
            "MOVIE_IMAGE": images(mine, kind, main),
            "MOVIE_VIDEO": videos(mine.filter(F.col("lang").isin("en", "fr")), kind),
        }
    if kind == "serie":
        watch, _ = validated(mine, kind, "watch_providers", valid_watch_providers)
        return {
            "SERIE": serie_details(mine.filter(F.col("lang") == "en")),
            "SERIE_LANG": localized(mine.filter(F.col("lang") == "fr"), kind),
            **{f"SERIE_{r}": title_relations(mine.filter(F.col("lang") == "en"), kind, r) for r in RELATIONS},
            "PERSON_SERIE": title_credits(mine.filter(F.col("lang") == "en"), kind),
            "SERIE_KEYWORD": keywords(mine, kind),
            "SERIE_SIMILAR": neighbours(mine, kind, "similar"),
            "SERIE_RECOMMENDATION": neighbours(mine, kind, "recommendations"),
            "SERIE_WATCH_PROVIDER": watch_providers(watch, "ID_SERIE"),
            "SERIE_IMAGE": images(mine, kind, main),
            "SERIE_VIDEO": videos(mine.filter(F.col("lang").isin("en", "fr")), kind),
        }
    if kind == "person":
        return {
            "PERSON": person_details(mine),
            "PERSON_MOVIE": person_credits(mine, "movie"),
            "PERSON_SERIE": person_credits(mine, "tv"),
            "PERSON_IMAGE": images(mine, kind, main, main_type="profile"),
        }
    if kind == "season":
        return {
            "SEASON": season_details(mine),
            "EPISODE": episode_rows(mine),
            "PERSON_SEASON": season_credits(mine),
            "PERSON_EPISODE": episode_credits(mine, "season"),
            "SEASON_LANG": localized(mine.filter(F.col("lang") == "fr"), kind),
            "SEASON_IMAGE": images(mine, kind, main),
            "SEASON_VIDEO": videos(mine, kind),
        }
    if kind == "episode":
        return {
            "PERSON_EPISODE": episode_credits(mine),
            "EPISODE_LANG": localized(mine.filter(F.col("lang") == "fr"), kind),
            "EPISODE_IMAGE": images(mine, kind, main, main_type="still"),
            "EPISODE_VIDEO": videos(mine, kind),
        }
    if kind == "list":
        return {"LIST_MEMBER": list_members(mine)}
    tables = {kind.upper(): simple_details(mine.filter(F.col("lang") == "en") if kind == "collection" else mine, kind)}
    if kind == "collection":
        tables["COLLECTION_LANG"] = localized(mine.filter(F.col("lang") == "fr"), kind)
    if kind != "keyword":
        tables[f"{kind.upper()}_IMAGE"] = images(mine, kind, main)
    return tables
