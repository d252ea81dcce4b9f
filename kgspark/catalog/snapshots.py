"""Catalogue snapshots: payload documents derived from the tables, flattened again."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.operators import merge
from kgspark.plans import snapshots as sn

c = F.col
WORDS = r"(SELECT doc_id, source, lang, n_chars, unnest(w) AS w, generate_subscripts(w,1) AS i FROM (SELECT *, regexp_split_to_array(text,'\s+') AS w FROM documents))"


@query(
    "movie_details",
    """SELECT doc_id AS ID_MOVIE, left(text,250) AS TITLE, text AS OVERVIEW, CASE doc_id%3 WHEN 0 THEN '1999-02-30' WHEN 1 THEN '2001-07-04' END AS DAT_RELEASE, CASE doc_id%3 WHEN 0 THEN 1999 WHEN 1 THEN 2001 END AS RELEASE_YEAR, CASE doc_id%3 WHEN 0 THEN 30 WHEN 1 THEN 4 END AS RELEASE_DAY,
       CASE WHEN n_chars%2=0 THEN 1 ELSE 0 END AS ADULT, n_chars AS BUDGET, n_chars%150 AS RUNTIME, CASE WHEN n_chars%150 BETWEEN 1 AND 58 THEN 1 ELSE 0 END AS IS_SHORT_FILM,
       '|'||CASE WHEN n_chars%5=0 THEN 'Documentary' ELSE 'Drama' END||'|'||source||'|' AS GENRES, CASE WHEN n_chars%5=0 THEN 1 ELSE 0 END AS IS_DOCUMENTARY FROM documents""",
)
def movie_details(d):
    return sn.movie_details(d.movie_payload).select(
        "ID_MOVIE", "TITLE", "OVERVIEW", "DAT_RELEASE", "RELEASE_YEAR", "RELEASE_DAY", "ADULT", "BUDGET", "RUNTIME", "IS_SHORT_FILM", "GENRES", "IS_DOCUMENTARY"
    )


@query(
    "movie_country_list",
    f"""SELECT doc_id AS ID_MOVIE, '|'||string_agg(w,'|' ORDER BY i)||'|' AS COUNTRIES FROM {WORDS} GROUP BY 1""",
)
def movie_country_list(d):
    return sn.movie_details(d.movie_payload).select("ID_MOVIE", "COUNTRIES")


@query(
    "serie_details",
    """SELECT o_orderkey AS ID_SERIE, o_orderpriority AS TITLE, strftime(o_orderdate,'%Y-%m-%d') AS DAT_FIRST_AIR, month(o_orderdate) AS FIRST_AIR_MONTH, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 0 END AS IN_PRODUCTION,
       CASE WHEN o_orderstatus='P' THEN '2024-01-01' END AS NEXT_EPISODE_DAT_AIR, CASE WHEN o_orderstatus='P' THEN 3 END AS NEXT_EPISODE_NUMBER, nullif(o_custkey,0) AS ID_TVDB, 'tt1' AS ID_IMDB FROM orders""",
)
def serie_details(d):
    return sn.serie_details(d.serie_payload).select(
        "ID_SERIE", "TITLE", "DAT_FIRST_AIR", "FIRST_AIR_MONTH", "IN_PRODUCTION", "NEXT_EPISODE_DAT_AIR", "NEXT_EPISODE_NUMBER", "ID_TVDB", "ID_IMDB"
    )


@query(
    "person_details",
    """SELECT c_custkey AS ID_PERSON, c_name AS NAME, c_mktsegment AS BIOGRAPHY, CASE WHEN c_custkey%4=0 THEN '19'||lpad((c_custkey%100)::VARCHAR,2,'0')||'-0'||(c_custkey%9+1)||'-31' END AS BIRTHDAY, CASE WHEN c_custkey%4=0 THEN c_custkey%9+1 END AS BIRTH_MONTH,
       c_custkey%3 AS GENDER, CASE WHEN c_custkey%5<>0 THEN 'place '||c_nationkey ELSE 'None' END AS PLACE_OF_BIRTH, CASE WHEN c_acctbal>0 THEN 1 ELSE 0 END AS ADULT, '|'||replace(c_name,'#','|')||'|' AS ALSO_KNOWN_AS FROM customer""",
)
def person_details(d):
    return sn.person_details(d.person_payload).select("ID_PERSON", "NAME", "BIOGRAPHY", "BIRTHDAY", "BIRTH_MONTH", "GENDER", "PLACE_OF_BIRTH", "ADULT", "ALSO_KNOWN_AS")


@query(
    "person_credits",
    """SELECT c_custkey AS ID_PERSON, c_custkey+1 AS ID_MOVIE, 'movie1-'||c_custkey AS ID_CREDIT, c_mktsegment AS CAST_CHARACTER, 'cast' AS CREDIT_TYPE FROM customer""",
)
def person_credits(d):
    return sn.person_credits(d.person_payload, "movie").select("ID_PERSON", "ID_MOVIE", "ID_CREDIT", "CAST_CHARACTER", "CREDIT_TYPE")


@query(
    "season_details",
    """SELECT o_orderkey+1 AS ID_SEASON, o_orderkey AS ID_SERIE, o_orderpriority AS TITLE, strftime(o_orderdate,'%Y-%m-%d') AS DAT_AIR, 2 AS EPISODE_COUNT FROM orders""",
)
def season_details(d):
    return sn.season_details(d.season_payload).select("ID_SEASON", "ID_SERIE", "TITLE", "DAT_AIR", "EPISODE_COUNT")


@query(
    "episode_rows",
    """SELECT o_orderkey*10+n AS ID_EPISODE, o_orderkey+1 AS ID_SEASON, n AS EPISODE_NUMBER, 'E'||n||' '||o_orderpriority AS TITLE, year(o_orderdate) AS AIR_YEAR FROM orders, (VALUES (1),(2)) v(n)""",
)
def episode_rows(d):
    return sn.episode_rows(d.season_payload).select("ID_EPISODE", "ID_SEASON", "EPISODE_NUMBER", "TITLE", "AIR_YEAR")


@query(
    "episode_credits",
    """SELECT o_orderkey*10+n AS ID_EPISODE, o_orderkey+k AS ID_PERSON, 'p'||k||'-'||o_orderkey AS ID_CREDIT, CASE k WHEN 3 THEN 'guest' ELSE 'crew' END AS CREDIT_TYPE, CASE k WHEN 3 THEN o_orderpriority ELSE '' END AS CAST_CHARACTER,
       CASE k WHEN 1 THEN 'Director' WHEN 2 THEN 'Writer' ELSE '' END AS CREW_JOB, CASE k WHEN 3 THEN 9 ELSE k END AS DISPLAY_ORDER FROM orders, (VALUES (1),(2)) v(n), (VALUES (1),(2),(3)) p(k) WHERE o_orderkey+k <> 0""",
)
def episode_credits(d):
    return sn.episode_credits(d.season_payload, "season").select("ID_EPISODE", "ID_PERSON", "ID_CREDIT", "CREDIT_TYPE", "CAST_CHARACTER", "CREW_JOB", "DISPLAY_ORDER")


@query(
    "season_credits",
    """SELECT o_orderkey+1 AS ID_SEASON, o_orderkey+1 AS ID_PERSON, 'r'||n||'-'||o_orderkey AS ID_CREDIT, 'cast' AS CREDIT_TYPE, '' AS CREW_JOB, 5 AS DISPLAY_ORDER, n AS TOTAL_EPISODE_COUNT FROM orders, (VALUES (1),(2)) v(n) WHERE o_orderstatus='O'
       UNION ALL SELECT o_orderkey+1, o_orderkey+2, 'j1-'||o_orderkey, 'crew', 'Editor', 3, 1 FROM orders WHERE o_orderstatus='O'
       UNION ALL SELECT o_orderkey+1, o_orderkey+3, 'p3-'||o_orderkey, 'cast', '', 9, NULL FROM orders WHERE o_orderstatus<>'O'
       UNION ALL SELECT o_orderkey+1, o_orderkey+k, 'p'||k||'-'||o_orderkey, 'crew', CASE k WHEN 1 THEN 'Director' ELSE 'Writer' END, k+1, NULL FROM orders, (VALUES (1),(2)) v(k) WHERE o_orderstatus<>'O'""",
)
def season_credits(d):
    return sn.season_credits(d.season_payload).select("ID_SEASON", "ID_PERSON", "ID_CREDIT", "CREDIT_TYPE", "CREW_JOB", "DISPLAY_ORDER", "TOTAL_EPISODE_COUNT")


@query(
    "title_relations",
    f"""SELECT doc_id AS ID_MOVIE, w AS COUNTRY_CODE, max(i)::INT AS DISPLAY_ORDER FROM {WORDS} GROUP BY 1,2""",
)
def title_relations(d):
    return sn.title_relations(d.movie_payload, "movie", "PRODUCTION_COUNTRY")


@query(
    "title_credits",
    f"""SELECT doc_id AS ID_MOVIE, length(w) AS ID_PERSON, doc_id||'-'||(i-1) AS ID_CREDIT, w AS CAST_CHARACTER, '' AS CREW_JOB, 'cast' AS CREDIT_TYPE, (min(i) OVER (PARTITION BY doc_id, length(w)))::INT AS DISPLAY_ORDER FROM {WORDS}
        UNION ALL SELECT doc_id, n_chars%7, 'c'||doc_id, '', source, 'crew', 1 FROM documents""",
)
def title_credits(d):
    return sn.title_credits(d.movie_payload).select("ID_MOVIE", "ID_PERSON", "ID_CREDIT", "CAST_CHARACTER", "CREW_JOB", "CREDIT_TYPE", "DISPLAY_ORDER")


@query(
    "serie_credits",
    """SELECT o_orderkey AS ID_SERIE, p AS ID_PERSON, r||'-'||o_orderkey AS ID_CREDIT, t AS CREDIT_TYPE, j AS CREW_JOB, o AS DISPLAY_ORDER FROM orders,
         (VALUES (1,'a1','cast','',1),(2,'a2','cast','',2),(10,'b1','crew','J',1),(10,'b3','crew','J',1)) v(p,r,t,j,o)
       UNION ALL SELECT o_orderkey, 11, 'b2-'||o_orderkey, 'crew', 'J', CASE WHEN o_orderstatus='O' THEN 3 ELSE 2 END FROM orders
       UNION ALL SELECT o_orderkey, 11, 'm-'||o_orderkey, 'crew', 'Creator', 2 FROM orders WHERE o_orderstatus='O'
       UNION ALL SELECT o_orderkey, 99, 'm-'||o_orderkey, 'crew', 'Creator', 2 FROM orders WHERE o_orderstatus='P'""",
)
def serie_credits(d):
    return sn.title_credits(d.serie_payload, "serie").select("ID_SERIE", "ID_PERSON", "ID_CREDIT", "CREDIT_TYPE", "CREW_JOB", "DISPLAY_ORDER")


@query("localized_titles", "SELECT doc_id AS ID_MOVIE, 'en' AS LANG, left(text,250) AS TITLE, text AS OVERVIEW FROM documents")
def localized_titles(d):
    return sn.translated(d.movie_payload, "movie").select("ID_MOVIE", "LANG", "TITLE", "OVERVIEW")


@query("keyword_links", f"SELECT doc_id AS ID_MOVIE, length(w) AS ID_KEYWORD, w AS NAME, i::INT AS DISPLAY_ORDER FROM {WORDS}")
def keyword_links(d):
    return sn.keywords(d.movie_answer("keywords"), "movie")


@query("neighbour_links", f"SELECT doc_id AS ID_MOVIE, length(w) AS ID_NEIGHBOUR, i::INT AS DISPLAY_ORDER FROM {WORDS}")
def neighbour_links(d):
    return sn.neighbours(d.movie_answer("similar"), "movie", "similar")


@query(
    "neighbour_prune",
    f"""SELECT doc_id AS ID_MOVIE, n AS ID_NEIGHBOUR FROM documents, range(1,9) r(n) WHERE EXISTS (SELECT 1 FROM {WORDS} w WHERE w.doc_id=documents.doc_id AND length(w.w)=n)""",
)
def neighbour_prune(d):
    answers = d.movie_answer("similar")
    links = sn.neighbours(answers, "movie", "similar")
    stored = d.documents.select(c("doc_id").alias("ID_MOVIE"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(8).cast("bigint"))).alias("ID_NEIGHBOUR"))
    owners = sn.documents(answers, "movie", "similar").select(c("id").alias("ID_MOVIE"))
    return merge.prune_absent(stored, links, owners, "ID_MOVIE", ["ID_NEIGHBOUR"], "keep")


@query(
    "release_dates",
    """SELECT o_orderkey AS ID_MOVIE, left(o_orderpriority,2) AS COUNTRY_CODE, strftime(o_orderdate,'%Y-%m-%dT%H:%M:%S.000Z') AS RELEASE_DATE_RAW, strftime(o_orderdate,'%Y-%m-%d %H:%M:%S') AS TIM_RELEASE, 3 AS RELEASE_TYPE, o_orderpriority AS CERTIFICATION, 1 AS DISPLAY_ORDER FROM orders WHERE o_orderstatus<>'F'
       UNION ALL SELECT o_orderkey, left(o_orderpriority,2), 'someday', NULL, 4, NULL, 2 FROM orders WHERE o_orderstatus<>'F'""",
)
def release_dates(d):
    valid, _ = sn.validated(d.release_payload, "movie", "release_dates", sn.valid_release_dates)
    return sn.release_dates(valid).select("ID_MOVIE", "COUNTRY_CODE", "RELEASE_DATE_RAW", "TIM_RELEASE", "RELEASE_TYPE", "CERTIFICATION", "DISPLAY_ORDER")


@query("release_quarantine", "SELECT o_orderkey AS ID_MOVIE FROM orders WHERE o_orderstatus='F'")
def release_quarantine(d):
    _, bad = sn.validated(d.release_payload, "movie", "release_dates", sn.valid_release_dates)
    return bad.select(c("id").alias("ID_MOVIE"))


@query(
    "watch_providers",
    """WITH x AS (SELECT o_orderkey, o_custkey, o_orderstatus, cc, co FROM orders, (VALUES ('FR',1),('US',2)) v(cc,co)), p AS (SELECT o_orderkey AS k, o_totalprice AS t FROM orders)
       SELECT o_orderkey AS ID_MOVIE, cc AS COUNTRY_CODE, 'flatrate' AS MONETIZATION_TYPE, o_custkey AS ID_PROVIDER, o_orderstatus AS LINK, co AS COUNTRY_ORDER, 1 AS DISPLAY_ORDER FROM x JOIN p ON k=o_orderkey WHERE t>100000
       UNION ALL SELECT o_orderkey, cc, 'rent', o_custkey, o_orderstatus, co, n FROM x JOIN p ON k=o_orderkey, (VALUES (1),(2)) v(n) WHERE t>200000""",
)
def watch_providers(d):
    valid, _ = sn.validated(d.watch_payload, "movie", "watch_providers", sn.valid_watch_providers)
    return sn.watch_providers(valid, "ID_MOVIE").select("ID_MOVIE", "COUNTRY_CODE", "MONETIZATION_TYPE", "ID_PROVIDER", "LINK", "COUNTRY_ORDER", "DISPLAY_ORDER")


@query(
    "provider_catalog",
    """SELECT p_partkey+1 AS ID_PROVIDER, t AS CONTENT_TYPE, cc AS COUNTRY_CODE, p_size+o-1 AS PROVIDER_DISPLAY_PRIORITY, o AS DISPLAY_ORDER FROM part, (VALUES ('movie',2),('serie',3)) v(t,m), (VALUES ('FR',1),('US',2)) w(cc,o) WHERE p_partkey%m=0""",
)
def provider_catalog(d):
    valid, _ = sn.validated(d.catalog_payload, "providers", "catalog", sn.valid_provider_catalog)
    return sn.provider_catalog(valid)[1]


@query(
    "provider_identities",
    """SELECT p_partkey+1 AS ID_PROVIDER, p_name AS PROVIDER_NAME, p_brand AS LOGO_PATH, 0 AS DELETED, 'now' AS TIM_UPDATED FROM part WHERE p_partkey%2=0 OR p_partkey%3=0 UNION ALL SELECT -1-s_suppkey, s_name, NULL, 1, 'now' FROM supplier""",
)
def provider_identities(d):
    valid, _ = sn.validated(d.catalog_payload, "providers", "catalog", sn.valid_provider_catalog)
    catalog, _ = sn.provider_catalog(valid)
    current = d.supplier.select(
        (-1 - c("s_suppkey")).alias("ID_PROVIDER"), c("s_name").alias("PROVIDER_NAME"), F.lit(None).cast("string").alias("LOGO_PATH"), F.lit(1).alias("DISPLAY_ORDER"),
        F.lit("old").alias("TIM_PROVIDER_UPDATED"), F.lit(0).alias("DELETED"), F.lit("old").alias("TIM_UPDATED"),
    )
    return sn.provider_identities(catalog, current, F.lit("now")).select("ID_PROVIDER", "PROVIDER_NAME", "LOGO_PATH", "DELETED", "TIM_UPDATED")


@query(
    "catalog_state",
    """SELECT t AS CONTENT_TYPE, count(*) AS PROVIDER_COUNT, 2*count(*) AS REGION_RELATION_COUNT FROM part, (VALUES ('movie',2),('serie',3)) v(t,m) WHERE p_partkey%m=0 GROUP BY 1""",
)
def catalog_state(d):
    valid, _ = sn.validated(d.catalog_payload, "providers", "catalog", sn.valid_provider_catalog)
    return sn.catalog_state(*sn.provider_catalog(valid))


@query(
    "images",
    f"""WITH w AS {WORDS}, x AS (SELECT doc_id, '/'||w AS p, i, CASE WHEN i%2=1 THEN 'en' ELSE 'fr' END AS l, CASE WHEN '/'||w='/'||source THEN 1 WHEN '/'||w='/the' THEN 1 ELSE 0 END AS pin FROM w)
        SELECT doc_id AS ID_MOVIE, p AS IMAGE_PATH, l AS LANG, CASE WHEN p='/the' AND l='en' THEN 0 WHEN pin=1 THEN 1 ELSE (sum(1-pin) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING))::INT END AS DISPLAY_ORDER FROM x
        UNION ALL SELECT doc_id, '/the', 'en', 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM x WHERE p='/the') UNION ALL SELECT doc_id, '/'||source, 'fr', 1 FROM documents""",
)
def images(d):
    # Base image '/the', localized image named after the source (never among the words).
    main = d.documents.select(
        "doc_id", F.lit("/the").alias("base"), F.array(F.struct(F.concat(F.lit("/"), c("source")).alias("path"), F.lit("fr").alias("lang"))).alias("local")
    )
    rows = sn.images(d.movie_answer("images"), "movie", main)
    return rows.select("ID_MOVIE", "IMAGE_PATH", "LANG", "DISPLAY_ORDER")


@query(
    "videos",
    """SELECT event_id AS ID_MOVIE, CASE WHEN event_id%2=0 THEN 'en' ELSE 'fr' END AS LANG_REQUESTED, 2 AS DISPLAY_ORDER, CASE WHEN event_type<>'error' THEN strftime(date_trunc('second',ts)+INTERVAL 1 HOUR,'%Y-%m-%d %H:%M:%S') END AS DAT_PUBLISHED,
       event_type AS VIDEO_TYPE, 'v'||event_id AS ID_CREDIT, user_id||'p' AS QUALITY_TEXT, "value">10 AS OFFICIAL FROM events""",
)
def videos(d):
    return sn.videos(d.video_payload, "movie").select("ID_MOVIE", "LANG_REQUESTED", "DISPLAY_ORDER", "DAT_PUBLISHED", "VIDEO_TYPE", "ID_CREDIT", "QUALITY_TEXT", "OFFICIAL")


@query("simple_details", "SELECT doc_id AS ID_COLLECTION, text AS OVERVIEW, NULL::VARCHAR AS NAME, '' AS POSTER_PATH FROM documents")
def simple_details(d):
    rows = sn.simple_details(d.movie_payload.withColumn("entity", F.lit("collection")), "collection")
    return rows.select("ID_COLLECTION", "OVERVIEW", "NAME", "POSTER_PATH")


@query(
    "list_members",
    r"""SELECT conv_id AS ID_LIST, CASE WHEN length(w)%2=0 THEN 'movie' ELSE 'serie' END AS KIND, length(w) AS ID_TITLE, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, i))::INT AS DISPLAY_ORDER FROM
        (SELECT conv_id, turn, unnest(w) AS w, generate_subscripts(w,1) AS i FROM (SELECT *, regexp_split_to_array(text,'\s+') AS w FROM conversations))""",
)
def list_members(d):
    return sn.list_members(d.list_payload)


@query(
    "list_poster",
    """SELECT o_custkey AS ID_LIST, CASE WHEN o_custkey%2=0 THEN 'own' ELSE first(o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) END AS POSTER_PATH FROM orders GROUP BY 1""",
)
def list_poster(d):
    o = d.orders.select(c("o_orderkey").alias("ID_MOVIE"), c("o_custkey").alias("ID_LIST"), "o_totalprice", "o_orderpriority", c("o_orderkey").cast("string").alias("ID_IMDB"))
    lists = o.select("ID_LIST").distinct().withColumn("POSTER_PATH", F.when(c("ID_LIST") % 2 == 0, "own").otherwise(""))
    films = o.select("ID_MOVIE", "ID_IMDB", c("o_orderpriority").alias("POSTER_PATH"))
    return sn.list_poster(lists, o.select("ID_LIST", c("ID_MOVIE").alias("ID_TITLE")), films, o.select("ID_IMDB", c("o_totalprice").alias("RATING")))


def refresh_inputs(d):
    """Lines as remote seasons of their order, orders as series, events as hints."""
    remote = d.lineitem.groupBy(c("l_orderkey").alias("ID_SERIE"), c("l_linenumber").alias("SEASON_NUMBER")).agg(F.count(F.lit(1)).cast("int").alias("EPISODE_COUNT"))
    stamp = F.when(c("SEASON_NUMBER") != 3, F.lit("done"))
    local = remote.filter(c("SEASON_NUMBER") != 5).join(d.orders.select(c("o_orderkey").alias("ID_SERIE"), "o_orderdate"), "ID_SERIE").select(
        "ID_SERIE", "SEASON_NUMBER", F.when(c("SEASON_NUMBER") == 4, c("EPISODE_COUNT") + 1).otherwise(c("EPISODE_COUNT")).alias("EPISODE_COUNT"), c("o_orderdate").cast("date").alias("DAT_AIR"),
        stamp.alias("TIM_CREDITS_COMPLETED"), F.lit("x").alias("TIM_TRANSLATIONS_COMPLETED"), F.lit("x").alias("TIM_IMAGES_COMPLETED"), F.lit("x").alias("TIM_VIDEOS_COMPLETED"),
    )
    series = d.orders.select(
        c("o_orderkey").alias("ID_SERIE"), F.when(c("o_orderstatus") == "O", 1).otherwise(0).alias("IN_PRODUCTION"), F.lit(None).cast("date").alias("NEXT_EPISODE_DAT_AIR"),
        c("o_orderdate").cast("date").alias("LAST_EPISODE_DAT_AIR"),
    )
    hints = d.events.select(c("event_id").alias("ID_SERIE"), F.lit(1).alias("SEASON_NUMBER"), F.lit(1).alias("EPISODE_NUMBER"))
    return remote, local, series, hints, F.lit("2001-08-02").cast("date")


REFRESH_CTE = """r AS (SELECT l_orderkey AS s, l_linenumber AS n FROM lineitem GROUP BY 1,2), o AS (SELECT o_orderkey AS s, o_orderdate::DATE AS dt, o_orderstatus AS st FROM orders),
    mx AS (SELECT r.s, max(n) AS m FROM r JOIN o ON o.s=r.s WHERE st='O' OR datediff('day',dt,DATE '2001-08-02') <= 90 GROUP BY 1)"""
REASON_TAIL = """WHEN datediff('day',dt,DATE '2001-08-02') BETWEEN 0 AND {days} THEN 'recent {what}'"""


@query(
    "season_refresh_selection",
    f"""WITH {REFRESH_CTE} SELECT * FROM (SELECT r.s AS ID_SERIE, r.n AS SEASON_NUMBER, CASE WHEN n=5 THEN 'missing locally' WHEN n=4 THEN 'episode count drift' WHEN n=3 THEN 'completion incomplete'
        {REASON_TAIL.format(days=120, what="season")} WHEN n=m THEN 'active series, latest season' WHEN n=1 AND r.s IN (SELECT event_id FROM events) THEN 'episode hint' END AS REASON FROM r JOIN o ON o.s=r.s LEFT JOIN mx ON mx.s=r.s) WHERE REASON IS NOT NULL""",
)
def season_refresh_selection(d):
    remote, local, series, hints, today = refresh_inputs(d)
    return sn.season_refresh_selection(remote, local, series, hints, today)


@query(
    "episode_refresh_selection",
    f"""WITH {REFRESH_CTE} SELECT * FROM (SELECT r.s AS ID_SERIE, r.n AS SEASON_NUMBER, 1 AS EPISODE_NUMBER, CASE WHEN n=1 AND r.s IN (SELECT event_id FROM events) THEN 'episode hint' WHEN n=3 THEN 'completion incomplete'
        {REASON_TAIL.format(days=45, what="episode")} WHEN n=m THEN 'active season' END AS REASON FROM r JOIN o ON o.s=r.s LEFT JOIN mx ON mx.s=r.s WHERE n<>5 AND n<>2) WHERE REASON IS NOT NULL""",
)
def episode_refresh_selection(d):
    remote, local, series, hints, today = refresh_inputs(d)
    episodes = local.withColumn("EPISODE_NUMBER", F.lit(1))
    latest = sn.latest_active_season(series, remote, today)
    return sn.episode_refresh_selection(remote.filter(c("SEASON_NUMBER") != 2), episodes, latest, hints, today)


@query(
    "changed_children",
    """SELECT DISTINCT user_id AS ID_SERIE, json_extract(props,'$.k')::INT AS SEASON_NUMBER, (event_id%10)::INT AS EPISODE_NUMBER FROM events WHERE event_type='view'""",
)
def changed_children(d):
    number = F.get_json_object("props", "$.k").cast("int")
    value = F.struct(number.alias("season_number"), (c("event_id") % 10).cast("int").alias("episode_number"))
    key = F.when(c("event_type") == "view", "episodes").when(c("event_type") == "click", "seasons").otherwise("images")
    body = F.struct(F.array(F.struct(key.alias("key"), F.array(F.struct(value.alias("value"))).alias("items"))).alias("changes"))
    changes = d.events.select(c("user_id").alias("id"), F.to_json(body).alias("payload"))
    return sn.changed_children(changes)[1]


@query(
    "snapshot_skips_dead_ids",
    """SELECT doc_id AS ID_MOVIE FROM documents WHERE doc_id NOT IN (SELECT user_id FROM events WHERE event_type='view')""",
)
def snapshot_skips_dead_ids(d):
    gone = d.events.filter(c("event_type") == "view").select(
        F.lit("movie").alias("ENTITY_TYPE"), c("user_id").alias("ID_ENTITY"), c("ts").alias("TS"), c("event_id").alias("SEQ"), F.lit("gone").alias("OUTCOME")
    )
    tables = sn.snapshot_entity(d.movie_payload, "movie", merge.not_found_ledger(gone), F.lit("2024-01-02 00:00:00").cast("timestamp"))
    return tables["MOVIE"].select("ID_MOVIE")


@query(
    "snapshot_newest_payload",
    """SELECT doc_id AS ID_MOVIE, left('again '||source,250) AS TITLE FROM documents WHERE lang<>'de' AND lang<>'es'
       UNION ALL SELECT doc_id, left(text,250) FROM documents WHERE lang='es'""",
)
def snapshot_newest_payload(d):
    """A second, later fetch of each film but the Spanish ones: a new title, or for German ones the answer that it is gone."""
    body = F.when(c("lang") == "de", F.lit('{"status_code":34}')).otherwise(F.to_json(F.struct(c("doc_id").alias("id"), F.concat(F.lit("again "), c("source")).alias("title"))))
    later = d.documents.filter(c("lang") != "es").select(
        F.lit("movie").alias("entity"), c("doc_id").alias("id"), F.lit("details").alias("endpoint"), F.lit("en").alias("lang"), F.lit("2024-02-02 00:00:00").alias("fetched_at"), body.alias("payload")
    )
    no_ledger = merge.not_found_ledger(
        d.events.filter(F.lit(False)).select(F.lit("movie").alias("ENTITY_TYPE"), c("user_id").alias("ID_ENTITY"), c("ts").alias("TS"), c("event_id").alias("SEQ"), F.lit("gone").alias("OUTCOME"))
    )
    tables = sn.snapshot_entity(d.movie_payload.unionByName(later), "movie", no_ledger, F.lit("2024-03-01 00:00:00").cast("timestamp"))
    return tables["MOVIE"].select("ID_MOVIE", "TITLE")
