"""First-generation bindings and streams over the driver tables."""

import uuid

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.catalog.snapshots import REFRESH_CTE, REASON_TAIL, refresh_inputs
from kgspark.catalog.writes import LEDGER_SQL, api_events, ledger_text
from kgspark.plans import bindings as bd
from kgspark.session import scratch_root
from kgspark.sources.driver import CUSTOMER, NATION, ORDER, PART, SUPPLIER, qid
from kgspark.sources.payloads import bindings
from kgspark.streaming import feeds

c = F.col
URI = "http://www.wikidata.org/entity/"
FILM_VARIABLES = ["item", "itemLabel", "imdbID", "tmdbID", "releaseDate", "plexMediaKey", "criterionFilmID", "criterionSpine", "type", "genres", "color"]


def cell(value):
    return F.struct(value.alias("value"))


def uri(q):
    return F.concat(F.lit(URI), q)


def film_rows(d):
    """Orders as result documents with two bindings: the second lacks date and genre."""
    k = c("o_orderkey")
    label = F.when(k % 4 == 0, qid(ORDER, "o_orderkey")).otherwise(c("o_orderpriority"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def binding(n):
        first = n == 1
        return F.struct(
            cell(uri(qid(ORDER, "o_orderkey"))).alias("item"), cell(label).alias("itemLabel"), cell(F.concat(F.lit("tt00000000"), k.cast("string"))).alias("imdbID"),
            cell((k + n).cast("string")).alias("tmdbID"), *([cell(F.when(c("o_orderstatus") != "F", stamp).otherwise("bad")).alias("releaseDate")] if first else []),
            cell(F.lit("12x" if first else "12")).alias("criterionFilmID"), cell(uri(qid(8, F.lit(n)))).alias("type"),
            *([cell(uri(qid(PART, "o_custkey"))).alias("genres")] if first else []), cell(uri(qid(9, F.length("o_orderpriority")))).alias("color"),
        )

    # The second binding is aligned to the first one's fields by going through JSON.
    body = F.concat(F.lit('{"results":{"bindings":['), F.to_json(binding(1)), F.lit(","), F.to_json(binding(2)), F.lit("]}}"))
    docs = d.spread(d.orders).select(c("o_orderkey").alias("doc"), body.alias("payload"))
    return bindings(docs, FILM_VARIABLES, ["doc"])


@query(
    "v1_movies",
    """SELECT 'Q'||(6000000000+o_orderkey) AS ID_WIKIDATA, o_orderkey+2 AS ID_MOVIE, left('tt00000000'||o_orderkey,10) AS ID_IMDB, CASE WHEN o_orderkey%4=0 THEN '' ELSE o_orderpriority END AS TITLE, 12 AS ID_CRITERION, 0 AS ID_CRITERION_SPINE, 'Q8000000002' AS INSTANCE_OF,
       NULL::VARCHAR AS PLEX_MEDIA_KEY, CASE WHEN o_orderstatus<>'F' THEN strftime(o_orderdate,'%Y-%m-%d') END AS DAT_RELEASE FROM orders""",
)
def v1_movies(d):
    return bd.v1_movies(film_rows(d), ["doc", "pos"])


@query(
    "v1_multi_values",
    """SELECT DISTINCT 'Q'||(6000000000+o_orderkey) AS ID_WIKIDATA, 'P136' AS ID_PROPERTY, 'Q'||(5000000000+o_custkey) AS ID_ITEM FROM orders UNION ALL SELECT 'Q'||(6000000000+o_orderkey), 'P462', 'Q'||(9000000000+length(o_orderpriority)) FROM orders""",
)
def v1_multi_values(d):
    return bd.v1_multi_values(film_rows(d))


@query(
    "v1_replace_multi_values",
    """SELECT 'Q'||(6000000000+o_orderkey) AS ID_WIKIDATA, 'P136' AS ID_PROPERTY, 'Q'||(5000000000+o_custkey) AS ID_ITEM FROM orders UNION ALL SELECT 'Q'||(6000000000+o_orderkey), 'P462', 'Q'||(9000000000+length(o_orderpriority)) FROM orders
       UNION SELECT * FROM v1_triple""",
)
def v1_replace_multi_values(d):
    stale = d.orders.select(qid(ORDER, "o_orderkey").alias("ID_WIKIDATA"), F.lit("P136").alias("ID_PROPERTY"), F.lit("Q1").alias("ID_ITEM"))
    return bd.v1_replace_multi_values(d.v1_triple.union(stale), film_rows(d))


@query(
    "v1_persons",
    """SELECT 'Q'||(3000000000+c_custkey) AS ID_WIKIDATA, c_custkey AS ID_PERSON, left(c_name,10) AS ID_IMDB, c_name AS NAME, 'Q5' AS INSTANCE_OF, CASE WHEN c_nationkey<10 THEN '1990-01-02' END AS BIRTHDAY, NULL::VARCHAR AS DEATHDAY FROM customer""",
)
def v1_persons(d):
    birth = F.when(c("c_nationkey") < 10, "1990-01-02T00:00:00Z").otherwise("1990-01-02")
    b = F.struct(
        cell(uri(qid(CUSTOMER, "c_custkey"))).alias("item"), cell(c("c_name")).alias("itemLabel"), cell(c("c_name")).alias("imdbID"), cell(c("c_custkey").cast("string")).alias("tmdbID"),
        cell(birth).alias("birthDate"), cell(F.lit(f"{URI}Q5")).alias("instanceOf"),
    )
    docs = d.customer.select(c("c_custkey").alias("doc"), F.to_json(F.struct(F.struct(F.array(b).alias("bindings")).alias("results"))).alias("payload"))
    rows = bindings(docs, ["item", "itemLabel", "imdbID", "tmdbID", "birthDate", "deathDate", "instanceOf"], ["doc"])
    return bd.v1_persons(rows, ["doc", "pos"])


@query(
    "v1_series",
    """SELECT 'Q'||(4000000000+s_suppkey) AS ID_WIKIDATA, s_suppkey+1 AS ID_SERIE, left('tt'||s_name,10) AS ID_IMDB, s_name AS TITLE, 'Q'||(2000000000+s_nationkey) AS INSTANCE_OF, CASE WHEN s_acctbal>0 THEN 'k'||s_suppkey END AS PLEX_MEDIA_KEY,
       CASE WHEN s_nationkey<10 THEN '1990-01-02' END AS DAT_START, NULL::VARCHAR AS DAT_END FROM supplier""",
)
def v1_series(d):
    """Series bindings; the variable of the catalogue's id is a parameter."""
    start = F.when(c("s_nationkey") < 10, "1990-01-02T00:00:00Z").otherwise("soon")
    b = F.struct(
        cell(uri(qid(SUPPLIER, "s_suppkey"))).alias("item"), cell(c("s_name")).alias("itemLabel"), cell(F.concat(F.lit("tt"), "s_name")).alias("imdbID"), cell((c("s_suppkey") + 1).cast("string")).alias("seriesID"),
        cell(uri(qid(NATION, "s_nationkey"))).alias("type"), cell(F.when(c("s_acctbal") > 0, F.concat(F.lit("k"), "s_suppkey")).otherwise("")).alias("plexMediaKey"), cell(start).alias("startTime"),
    )
    docs = d.supplier.select(c("s_suppkey").alias("doc"), F.to_json(F.struct(F.struct(F.array(b).alias("bindings")).alias("results"))).alias("payload"))
    rows = bindings(docs, ["item", "itemLabel", "imdbID", "seriesID", "type", "plexMediaKey", "startTime", "endTime"], ["doc"])
    return bd.v1_series(rows, ["doc", "pos"], "seriesID")


@query(
    "v1_properties",
    """SELECT DISTINCT 'Q'||(6000000000+l_orderkey) AS ID_WIKIDATA, CASE WHEN l_linestatus='O' THEN 'P166' ELSE 'P1411' END AS ID_PROPERTY, 'Q'||(5000000000+l_partkey) AS ID_ITEM FROM lineitem WHERE l_returnflag<>'N'""",
)
def v1_properties(d):
    value = F.when(c("l_returnflag") != "N", uri(qid(PART, "l_partkey"))).otherwise(c("l_shipdate").cast("string"))
    prop = F.when(c("l_linestatus") == "O", "P166").otherwise("P1411")
    rows = d.lineitem.select(uri(qid(ORDER, "l_orderkey")).alias("item"), uri(prop).alias("property"), value.alias("value"))
    return bd.v1_properties(rows)


def turn_rows(d):
    """Conversation turns as alias and label bindings of their conversation."""
    t = c("text")
    return d.conversations.select(
        uri(F.concat(F.lit("Q"), c("conv_id").cast("string"))).alias("item"), F.lit("en").alias("lang"), c("turn").alias("pos"), c("role").alias("itemAlias"),
        F.when(c("role") == "assistant", t).alias("itemLabel"), F.when(c("role") == "user", t).alias("itemDescription"), uri(F.concat(F.lit("Q"), F.length("text").cast("string"))).alias("instanceOf"),
    )


@query("v1_aliases", "SELECT 'Q'||conv_id AS ID_WIKIDATA, 'en' AS LANG, '|'||string_agg(role,'|' ORDER BY t)||'|' AS ALIASES FROM (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY 1,2) GROUP BY 1")
def v1_aliases(d):
    return bd.v1_aliases(turn_rows(d))


@query(
    "v1_items",
    """SELECT 'Q'||conv_id AS ID_WIKIDATA, 'en' AS LANG, coalesce(first(text ORDER BY turn) FILTER (role='assistant' AND text<>''),'') AS LABEL, coalesce(first(text ORDER BY turn) FILTER (role='user' AND text<>''),'') AS DESCRIPTION,
       any_value(a) AS ALIASES, 'Q'||first(length(text) ORDER BY turn DESC) AS INSTANCE_OF FROM conversations
       JOIN (SELECT conv_id AS i, '|'||string_agg(role,'|' ORDER BY t)||'|' AS a FROM (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY 1,2) GROUP BY 1) ON i=conv_id GROUP BY conv_id""",
)
def v1_items(d):
    return bd.v1_items(turn_rows(d), ["pos"])


@query(
    "v1_unlabelled_items",
    """SELECT DISTINCT ID_ITEM FROM v1_triple WHERE ID_ITEM > 'Q5000000500' AND ID_ITEM NOT IN (SELECT 'Q'||(5000000000+p_partkey) FROM part WHERE p_size<20) ORDER BY ID_ITEM LIMIT 5000""",
)
def v1_unlabelled_items(d):
    named = d.part.select(qid(PART, "p_partkey"), F.when(c("p_size") < 20, c("p_name")).otherwise("").alias("LABEL"))
    return bd.v1_unlabelled_items(d.v1_triple, [named, d.v2_entity.select("ID_WIKIDATA", "LABEL_EN")], "Q5000000500")


@query(
    "v1_fix_class",
    """SELECT 'Q'||(6000000000+o_orderkey) AS ID_WIKIDATA, CASE WHEN o_orderstatus='F' THEN coalesce((SELECT 'Q'||(5000000000+max(l_partkey)) FROM lineitem WHERE l_orderkey=o_orderkey),'') ELSE o_orderstatus END AS INSTANCE_OF FROM orders""",
)
def v1_fix_class(d):
    items = d.orders.select(qid(ORDER, "o_orderkey").alias("ID_WIKIDATA"), F.when(c("o_orderstatus") != "F", c("o_orderstatus")).otherwise("").alias("INSTANCE_OF"))
    rows = d.lineitem.select(uri(qid(ORDER, "l_orderkey")).alias("item"), uri(qid(PART, "l_partkey")).alias("instanceOf"), "l_partkey")
    return bd.v1_fix_class(items, rows, ["l_partkey"])


@query(
    "v1_promote_items",
    """SELECT 'items' AS SIDE, o_orderkey AS ID_WIKIDATA, LANG AS NAME, '' AS INSTANCE_OF FROM orders, (VALUES ('en'),('fr')) v(LANG) WHERE o_orderpriority<>'1-URGENT' UNION ALL
       SELECT 'target', o_orderkey, CASE WHEN o_orderstatus='O' THEN 'own' ELSE o_orderstatus END, o_orderpriority FROM orders WHERE o_orderpriority='1-URGENT' UNION ALL SELECT 'target', o_orderkey, 'own', '' FROM orders WHERE o_orderpriority<>'1-URGENT' AND o_orderstatus='O'""",
)
def v1_promote_items(d):
    items = d.orders.select(c("o_orderkey").alias("ID_WIKIDATA"), F.explode(F.array(F.lit("en"), F.lit("fr"))).alias("LANG"), c("o_orderstatus").alias("LABEL"), c("o_orderpriority").alias("INSTANCE_OF"))
    target = d.orders.filter(c("o_orderstatus") == "O").select(c("o_orderkey").alias("ID_WIKIDATA"), F.lit("own").alias("NAME"), F.lit("").alias("INSTANCE_OF"))
    left, moved = bd.v1_promote_items(items, target, ["1-URGENT"], {"LABEL": "NAME", "INSTANCE_OF": "INSTANCE_OF"})
    a = left.select(F.lit("items").alias("SIDE"), "ID_WIKIDATA", c("LANG").alias("NAME"), F.lit("").alias("INSTANCE_OF"))
    return a.union(moved.select(F.lit("target"), "ID_WIKIDATA", "NAME", "INSTANCE_OF"))


# Streams. Each run lands in a folder of its own under the shared scratch folder.


def scratch(d, name):
    return f"{scratch_root(d.spark)}/kgspark/{name}-{uuid.uuid4().hex}"


def in_two_epochs(d, rows, first, run):
    """Run a stream twice: over the rows for which ``first`` holds, then, from its checkpoint, over the others."""
    folder = scratch(d, "source")
    for part in (first, ~first):
        rows.filter(part).write.mode("append").parquet(folder)
        run(d.spark.readStream.schema(rows.schema).parquet(folder)).awaitTermination()


@query(
    "stream_ingest",
    """SELECT user_id, event_type, event_id, "value" FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn=1""",
)
def stream_ingest(d):
    """Newer rows come in both epochs, for a third of the later ones is in the first."""
    folder, keys = scratch(d, "ingest"), ["user_id", "event_type"]
    rows = d.events.select("user_id", "event_type", "event_id", "value")
    in_two_epochs(d, rows, c("event_id") % 3 == 0, lambda s: feeds.ingest_batches(s, f"{folder}/rows", f"{folder}/state", keys, ["event_id"]))
    return feeds.ingest_table(d.spark, f"{folder}/rows", feeds._ddl(rows), keys).read()


@query("stream_retry_ledger", LEDGER_SQL)
def stream_retry_ledger(d):
    """The second epoch brings some outcomes of the days before its start, too."""
    folder = scratch(d, "ledger")
    start = F.lit("2024-01-20").cast("timestamp")
    late = (c("TS") >= F.date_sub(start, 3)) & (c("SEQ") % 7 == 0)
    in_two_epochs(d, api_events(d), (c("TS") < start) & ~late, lambda s: feeds.retry_ledger(s, f"{folder}/rows", f"{folder}/state"))
    return ledger_text(feeds.ledger_state(d.spark, f"{folder}/rows"))


FEED_CTE = f"""{REFRESH_CTE}, te AS (SELECT event_id%3000 AS s, CASE WHEN event_id < (SELECT (max(event_id)+1)//2 FROM events) THEN 0 ELSE 1 END AS e, max(CASE WHEN event_type='view' THEN 1 ELSE 0 END) AS v FROM events WHERE event_type IN ('view','click') GROUP BY 1,2),
    x AS (SELECT te.s, te.e, te.v, n, m, dt, CASE WHEN n=5 THEN 'missing locally' WHEN n=4 THEN 'episode count drift' WHEN n=3 THEN 'completion incomplete' {REASON_TAIL.format(days=120, what="season")}
        WHEN n=m THEN 'active series, latest season' WHEN n=1 AND v=1 THEN 'episode hint' END AS sr FROM r JOIN o ON o.s=r.s LEFT JOIN mx ON mx.s=r.s JOIN te ON te.s=r.s),
    y AS (SELECT *, CASE WHEN n=1 AND v=1 THEN 'episode hint' WHEN n=3 THEN 'completion incomplete' {REASON_TAIL.format(days=45, what="episode")} WHEN n=m THEN 'active season' END AS er FROM x WHERE sr IS NOT NULL)"""


@query(
    "stream_changes_feed",
    f"""WITH {FEED_CTE} SELECT 'season' AS KIND, s AS ID_SERIE, n AS SEASON_NUMBER, NULL::INT AS EPISODE_NUMBER, sr AS REASON, e::BIGINT AS EPOCH FROM y QUALIFY row_number() OVER (PARTITION BY s, n ORDER BY e)=1
        UNION ALL SELECT 'episode', s, n, 1, er, e FROM (SELECT * FROM y WHERE er IS NOT NULL AND n<>5 QUALIFY row_number() OVER (PARTITION BY s, n ORDER BY e)=1)""",
)
def stream_changes_feed(d):
    """Many series change in both epochs; what the first selected is not selected again."""
    remote, local, series, _, today = refresh_inputs(d)
    folder = scratch(d, "changes")
    key = F.when(c("event_type") == "view", "episodes").when(c("event_type") == "click", "seasons").otherwise("images")
    value = F.struct(F.lit(1).alias("season_number"), F.lit(1).alias("episode_number"))
    body = F.struct(F.array(F.struct(key.alias("key"), F.array(F.struct(value.alias("value"))).alias("items"))).alias("changes"))
    changes = d.events.select((c("event_id") % 3000).alias("id"), F.to_json(body).alias("payload"), "event_id")
    half = (d.events.agg(F.max("event_id")).first()[0] + 1) // 2
    episodes = local.withColumn("EPISODE_NUMBER", F.lit(1))
    in_two_epochs(d, changes, c("event_id") < half, lambda s: feeds.changes_feed(s, remote, local, series, episodes, today, f"{folder}/rows", f"{folder}/state"))
    tables = feeds.feed_tables(d.spark, f"{folder}/rows")
    seasons = tables["seasons"].read().select(F.lit("season").alias("KIND"), "ID_SERIE", "SEASON_NUMBER", F.lit(None).cast("int").alias("EPISODE_NUMBER"), "REASON", "EPOCH")
    return seasons.union(tables["episodes"].read().select(F.lit("episode"), "ID_SERIE", "SEASON_NUMBER", "EPISODE_NUMBER", "REASON", "EPOCH"))


@query("stream_progress", "SELECT count(*) AS ROWS, count(*) FILTER (event_type='error') AS PARSE_ERRORS FROM events")
def stream_progress(d):
    """Live counters of a stream of dump lines: error events lose their closing brace."""
    import time

    body = F.when(c("event_type") == "error", F.regexp_replace("props", r"\}$", "")).otherwise(c("props"))
    folder, listener = scratch(d, "lines"), feeds.Progress(f"p{uuid.uuid4().hex}")
    d.events.select(body.alias("value")).write.text(f"{folder}/in")
    d.spark.streams.addListener(listener)
    lines = feeds.counted(d.spark.readStream.text(f"{folder}/in"), listener.name)
    lines.writeStream.format("noop").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    for _ in range(100):  # listeners hear of a micro-batch a little after it
        if listener.seen:
            break
        time.sleep(0.1)
    d.spark.streams.removeListener(listener)
    return d.spark.createDataFrame([(listener.total("ROWS"), listener.total("PARSE_ERRORS"))], "ROWS bigint, PARSE_ERRORS bigint")
