"""Media resolution.

Fixed values: the SQL below repeats the extension lists, address forms and flags of ``operators.media``, which results must have.
"""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.catalog.twins import stable_bigint
from kgspark.operators import media

c = F.col
BATCH = "batch_media"


def served(d):
    """Customers in credit serve as the live films, series and persons."""
    from kgspark.sources.driver import CUSTOMER, qid

    return d.customer.filter(c("c_acctbal") > 0).select(qid(CUSTOMER, "c_custkey"))


def commons(d):
    s = d.media_statement
    return media.commons_resources(s.drop("FILE_NAME", "VALUE_EXTERNAL_ID"), s.filter(c("FILE_NAME").isNotNull()), served(d), BATCH)


def external(d, build):
    s = d.media_statement
    return build(s.drop("FILE_NAME", "VALUE_EXTERNAL_ID"), s.filter(c("VALUE_EXTERNAL_ID").isNotNull()), served(d), BATCH)


LIVE = """ID_WIKIDATA IN (SELECT 'Q'||(3000000000+c_custkey) FROM customer WHERE c_acctbal>0) AND DELETED=0 AND coalesce("RANK",'')<>'deprecated'"""
COMMONS = f"""SELECT ID_STATEMENT, ID_WIKIDATA, ID_PROPERTY, n, replace(n,' ','_') AS norm, lower(list_last(string_split(n,'.'))) AS ext, 'commons:'||left(replace(n,' ','_'),200)||':S'||ID_STATEMENT AS k,
   CASE WHEN lower(list_last(string_split(n,'.'))) IN ('webm','mp4','ogv','mov','mkv') THEN 'video' WHEN lower(list_last(string_split(n,'.'))) IN ('wav','mp3','oga','ogg','opus','flac') THEN 'audio'
     WHEN lower(list_last(string_split(n,'.'))) IN ('pdf','djvu') THEN 'document' ELSE 'image' END AS kind FROM (SELECT *, trim(FILE_NAME) AS n FROM media_statement WHERE {LIVE}) WHERE n<>''"""


def external_sql(platform, prop):
    return f"""SELECT ID_STATEMENT, ID_WIKIDATA, ID_PROPERTY, n, '{platform}:'||left(n,200)||':S'||ID_STATEMENT AS k FROM (SELECT *, trim(VALUE_EXTERNAL_ID) AS n FROM media_statement WHERE {LIVE} AND ID_PROPERTY='{prop}') WHERE n<>''"""


@query(
    "commons_resources",
    f"""SELECT {stable_bigint('k')} AS ID_MEDIA_RESOURCE, ID_STATEMENT, n AS SOURCE_IDENTIFIER, norm AS SOURCE_IDENTIFIER_NORMALIZED, k AS RESOURCE_KEY, kind AS RESOURCE_KIND, n AS RESOURCE_TITLE, ext AS FILE_EXTENSION_PRIMARY,
        CASE WHEN kind IN ('video','audio') THEN 1 ELSE 0 END AS IS_PLAYABLE, 1 AS IS_DOWNLOADABLE, 0 AS IS_EMBEDDABLE, 'resolved' AS RESOLUTION_STATUS FROM ({COMMONS})""",
)
def commons_resources(d):
    return commons(d).select(
        "ID_MEDIA_RESOURCE", "ID_STATEMENT", "SOURCE_IDENTIFIER", "SOURCE_IDENTIFIER_NORMALIZED", "RESOURCE_KEY", "RESOURCE_KIND", "RESOURCE_TITLE", "FILE_EXTENSION_PRIMARY",
        "IS_PLAYABLE", "IS_DOWNLOADABLE", "IS_EMBEDDABLE", "RESOLUTION_STATUS",
    )


EXTERNAL_COLUMNS = ("ID_MEDIA_RESOURCE", "ID_STATEMENT", "SOURCE_IDENTIFIER", "RESOURCE_KEY", "RESOURCE_KIND", "IS_PLAYABLE", "IS_DOWNLOADABLE", "IS_EMBEDDABLE")


def external_resources_sql(platform, prop, downloadable):
    return f"""SELECT {stable_bigint('k')} AS ID_MEDIA_RESOURCE, ID_STATEMENT, n AS SOURCE_IDENTIFIER, k AS RESOURCE_KEY, 'video' AS RESOURCE_KIND, 1 AS IS_PLAYABLE, {downloadable} AS IS_DOWNLOADABLE, 1 AS IS_EMBEDDABLE FROM ({external_sql(platform, prop)})"""


@query("youtube_resources", external_resources_sql("youtube", "P1651", 0))
def youtube_resources(d):
    return external(d, media.youtube_resources).select(*EXTERNAL_COLUMNS)


@query("internet_archive_resources", external_resources_sql("internet_archive", "P724", 1))
def internet_archive_resources(d):
    return external(d, media.internet_archive_resources).select(*EXTERNAL_COLUMNS)


def urls_sql(source, *urls):
    rows = " UNION ALL ".join(
        f"SELECT {stable_bigint('k')} AS r, '{kind}' AS URL_TYPE, {url} AS URL, {order} AS DISPLAY_ORDER, {flags[0]} AS IS_CANONICAL, {flags[1]} AS IS_DIRECT_FILE, {flags[2]} AS IS_PLAYABLE, {flags[3]} AS IS_DOWNLOADABLE, {flags[4]} AS IS_EMBEDDABLE FROM s"
        for kind, url, order, flags in urls
    )
    key = stable_bigint("r||'|'||sha256(URL)")
    return f"WITH s AS ({source}), u AS ({rows}) SELECT {key} AS ID_MEDIA_RESOURCE_URL, r AS ID_MEDIA_RESOURCE, sha256(URL) AS URL_HASH, u.* EXCLUDE (r) FROM u"


URL_COLUMNS = ("ID_MEDIA_RESOURCE_URL", "ID_MEDIA_RESOURCE", "URL_HASH", "URL_TYPE", "URL", "DISPLAY_ORDER", "IS_CANONICAL", "IS_DIRECT_FILE", "IS_PLAYABLE", "IS_DOWNLOADABLE", "IS_EMBEDDABLE")


@query(
    "commons_urls",
    urls_sql(
        COMMONS,
        ("page", "'https://commons.wikimedia.org/wiki/File:'||norm", 1, (1, 0, 0, 0, 0)),
        ("thumbnail", "'https://commons.wikimedia.org/wiki/Special:FilePath/'||norm||'?width=400'", 2, (0, 0, 0, 0, 0)),
        ("file", "'https://upload.wikimedia.org/wikipedia/commons/'||left(md5(norm),1)||'/'||left(md5(norm),2)||'/'||norm", 3, (0, 1, "CASE WHEN kind IN ('video','audio') THEN 1 ELSE 0 END", 1, 0)),
    ),
)
def commons_urls(d):
    return media.commons_urls(commons(d)).select(*URL_COLUMNS)


@query(
    "youtube_urls",
    urls_sql(
        external_sql("youtube", "P1651"),
        ("watch", "'https://www.youtube.com/watch?v='||n", 1, (1, 0, 1, 0, 0)),
        ("embed", "'https://www.youtube.com/embed/'||n", 2, (0, 0, 1, 0, 1)),
        ("thumbnail", "'https://i.ytimg.com/vi/'||n||'/hqdefault.jpg'", 3, (0, 0, 0, 0, 0)),
    ),
)
def youtube_urls(d):
    return media.youtube_urls(external(d, media.youtube_resources)).select(*URL_COLUMNS)


@query(
    "internet_archive_urls",
    urls_sql(
        external_sql("internet_archive", "P724"),
        ("page", "'https://archive.org/details/'||n", 1, (1, 0, 1, 0, 0)),
        ("file", "'https://archive.org/download/'||n", 2, (0, 1, 0, 1, 0)),
    ),
)
def internet_archive_urls(d):
    return media.internet_archive_urls(external(d, media.internet_archive_resources)).select(*URL_COLUMNS)


@query(
    "media_gate",
    f"""SELECT 'commons' AS SOURCE_PLATFORM, count(*) AS RESOURCES, 3*count(*) AS URLS, true AS OK FROM ({COMMONS}) UNION ALL SELECT 'youtube', count(*), 3*count(*), true FROM ({external_sql("youtube", "P1651")})""",
)
def media_gate(d):
    from kgspark.operators.checks import media_gate as gate

    a, b = commons(d), external(d, media.youtube_resources)
    return gate(a.unionByName(b), media.commons_urls(a).unionByName(media.youtube_urls(b)))


@query(
    "media_staging_upsert",
    """SELECT o_orderkey AS ID_MEDIA_RESOURCE, CASE o_orderpriority WHEN '1-URGENT' THEN 'commons' WHEN '2-HIGH' THEN 'youtube' END AS SOURCE_PLATFORM, CASE WHEN o_orderstatus='O' THEN 'audio' ELSE 'video' END AS RESOURCE_KIND,
       CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END AS IS_PLAYABLE, 1 AS IS_ACTIVE FROM orders UNION ALL SELECT -1-c_custkey, 'youtube', 'image', 0, 0 FROM customer""",
)
def media_staging_upsert(d):
    from kgspark.operators.merge import upsert

    priority = c("o_orderpriority")
    staged = d.orders.select(
        c("o_orderkey").alias("ID_MEDIA_RESOURCE"), F.when(priority == "1-URGENT", "commons").when(priority == "2-HIGH", "youtube").otherwise(priority).alias("SOURCE_PLATFORM"),
        F.when(c("o_orderstatus") == "O", "audio").otherwise("film").alias("RESOURCE_KIND"), F.when(c("o_orderstatus") == "P", F.lit(1)).alias("IS_PLAYABLE"), F.lit(None).cast("int").alias("IS_ACTIVE"),
    )
    guarded = media.guard_rows(staged, media.RESOURCE_ENUMS, media.RESOURCE_FLAGS, F.lit("now"))
    old = lambda key: [key.alias("ID_MEDIA_RESOURCE"), F.lit("youtube").alias("SOURCE_PLATFORM"), F.lit("image").alias("RESOURCE_KIND"), F.lit(0).alias("IS_PLAYABLE"), F.lit(0).alias("IS_ACTIVE")]
    target = d.customer.select(*old(-1 - c("c_custkey"))).unionByName(d.orders.filter(c("o_totalprice") > 200000).select(*old(c("o_orderkey"))))
    return upsert(target, guarded, ["ID_MEDIA_RESOURCE"])


def staged_urls(d):
    """Orders as URL rows of outside tools: every third type is unknown, flags and counters are missing."""
    kind = F.element_at(F.array(F.lit("page"), F.lit("file"), F.lit("odd")), (c("o_orderkey") % 3 + 1).cast("int"))
    none = lambda t: F.lit(None).cast(t)
    return d.orders.select(
        c("o_orderkey").alias("ID_MEDIA_RESOURCE_URL"), c("o_custkey").alias("ID_MEDIA_RESOURCE"), kind.alias("URL_TYPE"), c("o_orderpriority").alias("URL"),
        F.when(c("o_orderstatus") == "P", F.lit(1)).alias("IS_PLAYABLE"), none("int").alias("IS_ACTIVE"), none("int").alias("CHECK_COUNT"), none("string").alias("DISCOVERED_AT"), none("string").alias("TIM_UPDATED"),
        F.when(c("o_orderstatus") == "O", "b1").otherwise("b2").alias("IMPORT_BATCH_ID"), F.when(c("o_orderkey") % 7 == 0, "LOADED").otherwise("NEW").alias("ROW_STATUS"),
        none("string").alias("ERROR_MESSAGE"), c("o_orderkey").alias("ID_STG_ROW"),
    )


@query(
    "media_url_staging",
    """SELECT o_orderkey AS ID_MEDIA_RESOURCE_URL, CASE o_orderkey%3 WHEN 0 THEN 'page' WHEN 1 THEN 'file' END AS URL_TYPE, CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END AS IS_PLAYABLE, 1 AS IS_ACTIVE, 0 AS CHECK_COUNT, 'now' AS DISCOVERED_AT, 'now' AS TIM_UPDATED, o_orderkey%2 AS OLD
       FROM orders WHERE o_orderstatus<>'O' AND o_orderkey%7<>0 UNION ALL SELECT o_orderkey, 'old', 9, 9, 9, 'old', 'old', 1 FROM orders WHERE o_orderkey%2=1 AND (o_orderstatus='O' OR o_orderkey%7=0)""",
)
def media_url_staging(d):
    """Only waiting rows of the batch enter; every second URL is there already and keeps the column that the staging lacks."""
    staged = staged_urls(d)
    old = d.orders.filter(c("o_orderkey") % 2 == 1).select(
        c("o_orderkey").alias("ID_MEDIA_RESOURCE_URL"), F.lit("old").alias("URL_TYPE"), F.lit(9).alias("IS_PLAYABLE"), F.lit(9).alias("IS_ACTIVE"), F.lit(9).alias("CHECK_COUNT"),
        F.lit("old").alias("DISCOVERED_AT"), F.lit("old").alias("TIM_UPDATED"), F.lit(1).alias("OLD"),
    )
    targets, _ = media.load_staged({"MEDIA_RESOURCE_URL": old}, {"MEDIA_RESOURCE_URL": staged}, "b2", F.lit("now"))
    return targets["MEDIA_RESOURCE_URL"].withColumn("OLD", F.coalesce("OLD", F.lit(0)).cast("bigint"))


def staged_checks(d, last):
    """Events as checks of URLs: the status of some is unknown, the second batch brings every fifth check of the first again."""
    kind = c("event_type")
    status = F.when(kind == "error", "failure").when(kind == "purchase", "success").when(kind == "view", "partial").otherwise("odd")
    return d.events.filter((c("event_id") % 2 == 1) | (c("event_id") % 5 == 0) if last else c("event_id") % 2 == 0).select(
        c("event_id").alias("ID_MEDIA_RESOURCE_CHECK"), (c("user_id") % 10).alias("ID_MEDIA_RESOURCE"), c("user_id").alias("ID_MEDIA_RESOURCE_URL"), F.lit("url").alias("CHECK_SCOPE"),
        F.lit("http_head").alias("CHECK_TYPE"), (F.lit("failure") if last else status).alias("CHECK_STATUS"), F.length("props").alias("HTTP_STATUS"),
        F.when(kind != "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("CHECKED_AT"),
    )


@query(
    "media_check_history",
    """WITH h AS (SELECT event_id AS i, user_id AS u, length(props) AS s, CASE WHEN event_type<>'click' THEN strftime(date_trunc('second',ts),'%Y-%m-%d %H:%M:%S') ELSE '2024-02-01 00:00:00' END AS t,
         CASE WHEN event_id%2=1 OR event_id%5=0 THEN 'failure' WHEN event_type='purchase' THEN 'success' WHEN event_type='error' THEN 'failure' WHEN event_type='view' THEN 'partial' END AS x FROM events)
       SELECT u%10 AS ID_MEDIA_RESOURCE, u AS ID_MEDIA_RESOURCE_URL, arg_max({'x': x}, (t,i)).x AS CHECK_STATUS, arg_max(s, (t,i))::INT AS HTTP_STATUS, count(*) AS CHECK_COUNT, count(*) FILTER (x='failure') AS FAIL_COUNT, max(t) AS LAST_CHECKED_AT, max(t) FILTER (x='success') AS LAST_SUCCESS_AT FROM h GROUP BY 2""",
)
def media_check_history(d):
    """Two batches of checks, the first loaded twice; checks without a time get the load's."""
    from kgspark.session import cut_path

    folder, now = cut_path(d.spark, "checks"), F.lit("2024-02-01 00:00:00")
    for batch, last in (("b1", False), ("b2", True), ("b1", False)):
        media.append_checks(staged_checks(d, last), folder, batch, now)
    return media.newest_checks(media.check_history(d.spark, folder))


@query(
    "media_url_check_state",
    """SELECT o_orderkey AS ID_MEDIA_RESOURCE_URL, coalesce(n,7) AS CHECK_COUNT, coalesce(f,7) AS FAIL_COUNT, coalesce(t,'own') AS LAST_CHECKED_AT FROM orders LEFT JOIN
       (SELECT user_id AS u, count(*) AS n, count(*) FILTER (event_type='error') AS f, max(strftime(date_trunc('second',ts),'%Y-%m-%d %H:%M:%S')) AS t FROM events WHERE event_id%2=0 AND event_type<>'click' GROUP BY 1) ON u=o_orderkey""",
)
def media_url_check_state(d):
    """URL rows take over what the history says of them."""
    urls = d.orders.select(c("o_orderkey").alias("ID_MEDIA_RESOURCE_URL"), F.lit(7).cast("bigint").alias("CHECK_COUNT"), F.lit(7).cast("bigint").alias("FAIL_COUNT"), F.lit("own").alias("LAST_CHECKED_AT"))
    return media.with_check_state(urls, media.newest_checks(staged_checks(d, False).filter(c("CHECKED_AT").isNotNull())))
