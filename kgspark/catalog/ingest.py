"""Reading, gating, projecting and filtering."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.catalog.twins import stable_bigint
from kgspark.functions import text as tx
from kgspark.operators import ranking
from kgspark.session import cut_path
from kgspark.sources import dump, staging, tables

NOW = "2024-02-01 00:00:00"


@query(
    "dump_line_cleaning",
    """SELECT count(*) AS LINES, sum(CASE WHEN l_linestatus='O' THEN 1 ELSE 0 END)::BIGINT AS WITH_AWARD,
       count(*) AS CLOSED FROM lineitem""",
)
def dump_line_cleaning(d):
    lines = dump.clean_lines(d.dump_lines)
    return lines.agg(
        F.count(F.lit(1)).alias("LINES"),
        F.count_if(F.col("value").contains('"claims":{"P166"')).alias("WITH_AWARD"),
        F.count_if(F.col("value").startswith("{") & F.col("value").endswith("}")).alias("CLOSED"),
    )


@query(
    "parse_errors_by_source",
    """SELECT event_type AS SOURCE, count(*) FILTER (event_type<>'error') AS GOOD, count(*) FILTER (event_type='error') AS BAD
       FROM events GROUP BY event_type""",
)
def parse_errors_by_source(d):
    # Error events lose their closing brace, so exactly those lines cannot be parsed.
    lines = d.events.select(
        "event_type",
        F.when(F.col("event_type") == "error", F.regexp_replace("props", r"\}$", "")).otherwise(F.col("props")).alias("value"),
    )
    bad = F.try_parse_json("value").isNull()
    return lines.groupBy(F.col("event_type").alias("SOURCE")).agg(F.count_if(~bad).alias("GOOD"), F.count_if(bad).alias("BAD"))


@query(
    "idgate",
    """SELECT 'Q'||(6000000000+l_orderkey) AS ID, count(*) AS LINES FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority='1-URGENT') GROUP BY 1""",
)
def idgate(d):
    from kgspark.sources.driver import ORDER, qid

    wanted = d.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(qid(ORDER, "o_orderkey"))
    kept = dump.idgate(dump.clean_lines(d.dump_lines), wanted)
    return kept.groupBy(dump.top_level_id(F.col("value")).alias("ID")).agg(F.count(F.lit(1)).alias("LINES"))


@query("id_set", "SELECT DISTINCT 'Q'||(5000000000+l_partkey) AS ID FROM lineitem")
def id_set(d):
    from kgspark.sources.driver import PART, qid

    path = cut_path(d.spark, "ids")
    tables.write_id_set(d.lineitem.select(qid(PART, "l_partkey").alias("ID")), path)
    return tables.read_id_set(d.spark, path)


@query(
    "replace_batch",
    """SELECT IMPORT_BATCH_ID, count(*) AS N, sum(l_quantity)::BIGINT AS QTY FROM (
         SELECT IMPORT_BATCH_ID, l_quantity FROM kg_statement WHERE IMPORT_BATCH_ID <> 'batch_1998'
         UNION ALL SELECT 'batch_1998', l_quantity+1 FROM kg_statement WHERE IMPORT_BATCH_ID = 'batch_1998' AND VALUE_TYPE='item') GROUP BY 1""",
)
def replace_batch(d):
    staged = d.kg_statement.select("ID_STATEMENT", "IMPORT_BATCH_ID", "l_quantity")
    again = (
        d.kg_statement.filter((F.col("IMPORT_BATCH_ID") == "batch_1998") & (F.col("VALUE_TYPE") == "item"))
        .select("ID_STATEMENT", (F.col("l_quantity") + 1).alias("l_quantity"))
    )
    out = tables.replaced_batch(staged, again, "batch_1998")
    return out.groupBy("IMPORT_BATCH_ID").agg(F.count(F.lit(1)).alias("N"), F.sum("l_quantity").cast("bigint").alias("QTY"))


@query(
    "snapshot_changed",
    "SELECT 'orders' AS NAME, count(*) AS \"ROWS\", count(*) FILTER (o_orderstatus<>'P') AS OLD_ROWS, true AS CHANGED FROM orders",
)
def snapshot_changed(d):
    old = tables.fingerprint(d.orders.filter(F.col("o_orderstatus") != "P"))
    ledger = old.select(F.lit("orders").alias("NAME"), F.lit(1).alias("RUN_NO"), "ROWS", "CONTENT")
    return tables.snapshot_changed(d.orders, ledger, "orders")


@query(
    "registered_tables_sql",
    """SELECT n_name, count(*) AS CUSTOMERS FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY n_name""",
)
def registered_tables_sql(d):
    tables.register_tables(d.spark, d.dir, ["customer", "nation"])
    return d.spark.sql(
        "SELECT n_name, count(*) AS CUSTOMERS FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"
    )


@query(
    "staging_rows",
    """SELECT 'batch_x' AS IMPORT_BATCH_ID, 'NEW' AS ROW_STATUS, o_orderstatus, count(*) AS N,
       min('{"k":'||o_orderkey||',"p":"'||o_orderpriority||'"}') AS MIN_JSON FROM orders GROUP BY 3""",
)
def staging_rows(d):
    rows = d.orders.select(
        "o_orderstatus", F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p")).alias("INFO")
    )
    staged = staging.as_staging(rows, "batch_x", "orders.jsonl")
    return staged.groupBy("IMPORT_BATCH_ID", "ROW_STATUS", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("N"), F.min("INFO").alias("MIN_JSON")
    )


@query(
    "label_in_language",
    """SELECT 'Q'||doc_id AS ID_WIKIDATA, CASE WHEN lang='fr' THEN text END AS LABEL_FR, CASE WHEN lang='en' THEN text END AS LABEL_EN,
       NULL::VARCHAR AS LABEL_NUMERIC FROM documents""",
)
def label_in_language(d):
    good, _ = dump.parse_entities(d.labelled_lines)
    return good.select(
        F.regexp_replace("id", "^Q0*(?=[0-9])", "Q").alias("ID_WIKIDATA"),
        dump.in_language(F.col("labels"), "fr").alias("LABEL_FR"),
        dump.in_language(F.col("labels"), "en").alias("LABEL_EN"),
        dump.in_language(F.col("labels"), "zz").alias("LABEL_NUMERIC"),
    )


@query(
    "labels_map_languages",
    """SELECT lang AS LANG, count(*) AS N, sum(length(text))::BIGINT AS CHARS FROM documents WHERE lang IN ('en','fr','de','es') GROUP BY lang""",
)
def labels_map_languages(d):
    good, _ = dump.parse_entities(d.labelled_lines)
    pairs = good.select(F.explode(dump.texts_map(F.col("labels"))).alias("LANG", "TEXT"))
    return pairs.groupBy("LANG").agg(F.count(F.lit(1)).alias("N"), F.sum(F.length("TEXT")).alias("CHARS"))


@query(
    "enum_guard",
    """SELECT CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN o_orderpriority END AS GUARDED,
       CASE WHEN o_orderstatus IN ('O','F') THEN o_orderstatus ELSE 'unknown' END AS DEFAULTED, count(*) AS N FROM orders GROUP BY 1,2""",
)
def enum_guard(d):
    return d.orders.groupBy(
        tx.enum_guard(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"]).alias("GUARDED"),
        tx.enum_guard(F.col("o_orderstatus"), ["O", "F"], "unknown").alias("DEFAULTED"),
    ).agg(F.count(F.lit(1)).alias("N"))


@query(
    "apply_defaults",
    """SELECT o_orderkey, CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END AS DELETED,
       CASE WHEN o_orderstatus='O' THEN '2024-02-01' ELSE strftime(o_orderdate,'%Y-%m-%d') END AS DAT_CREAT FROM orders""",
)
def apply_defaults(d):
    from kgspark.operators.media import guard_rows

    staged = d.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(1)).alias("DELETED"),
        F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("DAT_CREAT"),
    )
    return guard_rows(staged, {}, {"DELETED": 0}, F.lit("2024-02-01"), ("DAT_CREAT",))


@query(
    "loadable_rows",
    """SELECT VALUE_TYPE, count(*) AS N FROM kg_statement WHERE IMPORT_BATCH_ID='batch_1997' AND "RANK" IN ('preferred','normal') GROUP BY 1""",
)
def loadable_rows(d):
    from kgspark.operators.merge import loadable

    status = F.when(F.col("RANK") == "preferred", "NEW").when(F.col("RANK") == "normal", "VALID").otherwise("LOADED")
    staged = d.kg_statement.withColumn("ROW_STATUS", status)
    return loadable(staged, "batch_1997").groupBy("VALUE_TYPE").agg(F.count(F.lit(1)).alias("N"))


@query(
    "active_not_deprecated",
    """SELECT ID_PROPERTY, count(*) AS N FROM kg_statement WHERE DELETED=0 AND "RANK"<>'deprecated' GROUP BY 1""",
)
def active_not_deprecated(d):
    live = d.kg_statement.filter(tx.active(F.col("DELETED")) & tx.not_deprecated(F.col("RANK")))
    return live.groupBy("ID_PROPERTY").agg(F.count(F.lit(1)).alias("N"))


@query(
    "id_predicates",
    """SELECT regexp_matches(v,'^Q[0-9]+$') AS IS_QID, regexp_matches(v,'^[QPL][0-9]+$') AS LOOKS_LIKE_ID,
       CASE WHEN regexp_matches(v,'^[QPL][0-9]+$') THEN '' ELSE v END AS CLEAN, count(*) AS N
       FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Q12' WHEN '2-HIGH' THEN 'P3' WHEN '3-MEDIUM' THEN 'Qx' ELSE o_orderpriority END AS v FROM orders) GROUP BY 1,2,3""",
)
def id_predicates(d):
    p = F.col("o_orderpriority")
    v = F.when(p == "1-URGENT", "Q12").when(p == "2-HIGH", "P3").when(p == "3-MEDIUM", "Qx").otherwise(p)
    return (
        d.orders.select(v.alias("v"))
        .groupBy(tx.is_qid(F.col("v")).alias("IS_QID"), tx.looks_like_id(F.col("v")).alias("LOOKS_LIKE_ID"), tx.clean_label(F.col("v")).alias("CLEAN"))
        .agg(F.count(F.lit(1)).alias("N"))
    )


@query(
    "valid_iso_date",
    """SELECT o_orderkey, CASE WHEN ok THEN strftime(TRY_CAST(t AS DATE),'%Y-%m-%d') END AS DAT, CASE WHEN ok THEN substr(t,1,4)::INT END AS Y,
         CASE WHEN ok THEN substr(t,6,2)::INT END AS M, CASE WHEN ok THEN substr(t,9,2)::INT END AS D
       FROM (SELECT o_orderkey, t, regexp_full_match(t,'[0-9]{4}-[0-9]{2}-[0-9]{2}') AS ok FROM (
         SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN year(o_orderdate)||'-02-'||lpad((o_orderkey%31+1)::VARCHAR,2,'0')
           WHEN 'O' THEN strftime(o_orderdate,'%Y-%m-%d') ELSE strftime(o_orderdate,'%d/%m/%Y') END AS t FROM orders))""",
)
def valid_iso_date(d):
    c = F.col
    feb = F.concat(F.year("o_orderdate").cast("string"), F.lit("-02-"), F.lpad((c("o_orderkey") % 31 + 1).cast("string"), 2, "0"))
    t = (
        F.when(c("o_orderstatus") == "P", feb)
        .when(c("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    parsed = d.orders.select("o_orderkey", tx.valid_iso_date(t).alias("p"))
    return parsed.select(
        "o_orderkey", F.date_format("p.date", "yyyy-MM-dd").alias("DAT"), c("p.year").alias("Y"), c("p.month").alias("M"), c("p.day").alias("D")
    )


@query(
    "stale_rows",
    f"""SELECT event_type, count(*) AS N FROM events
        WHERE (CASE WHEN event_type='view' AND user_id%2=0 THEN NULL ELSE ts END) IS NULL OR ts < TIMESTAMP '{NOW}' - INTERVAL 20 DAY GROUP BY 1""",
)
def stale_rows(d):
    ts = F.when(~((F.col("event_type") == "view") & (F.col("user_id") % 2 == 0)), F.col("ts"))
    rows = d.events.filter(tx.stale(ts, F.to_timestamp(F.lit(NOW)), 20))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("N"))


@query("truncate_text", "SELECT doc_id, left(text,10) AS T10, left(text,250) AS T250, left(source,40) AS S40 FROM documents")
def truncate_text(d):
    cut = tx.truncated
    return d.documents.select(
        "doc_id", cut(F.col("text"), 10).alias("T10"), cut(F.col("text"), 250).alias("T250"), cut(F.col("source"), 40).alias("S40")
    )


@query(
    "filled_and_label_like",
    """SELECT count(*) FILTER (LABEL_EN IS NOT NULL AND LABEL_EN<>'') AS FILLED, count(*) FILTER (LABEL_EN LIKE 'Order#1%') AS LIKE_PREFIX, ENTITY_CLASS
       FROM kg_entity GROUP BY ENTITY_CLASS""",
)
def filled_and_label_like(d):
    return d.kg_entity.groupBy("ENTITY_CLASS").agg(
        F.count_if(tx.filled(F.col("LABEL_EN"))).alias("FILLED"),
        F.count_if(tx.label_like(F.col("LABEL_EN"), "Order#1")).alias("LIKE_PREFIX"),
    )


@query(
    "id_bucket",
    """SELECT CASE WHEN n < 3000000100 THEN 'small' WHEN n < 5000000000 THEN 'middle' WHEN n < 6000005000 THEN 'large' ELSE 'recent' END AS BUCKET, count(*) AS N
       FROM (SELECT substr(ID_WIKIDATA,2)::BIGINT AS n FROM kg_entity) GROUP BY 1""",
)
def id_bucket(d):
    bounds = [(3_000_000_100, "small"), (5_000_000_000, "middle"), (6_000_005_000, "large")]
    return d.kg_entity.groupBy(tx.id_bucket(F.col("ID_WIKIDATA"), bounds, "recent").alias("BUCKET")).agg(F.count(F.lit(1)).alias("N"))


@query(
    "external_id_shape",
    """SELECT CASE WHEN v IS NULL OR v='' THEN 'empty' WHEN regexp_matches(v,'^nm[0-9]+$') THEN 'nm_digits' WHEN regexp_matches(v,'^tt[0-9]+$') THEN 'tt_digits'
         WHEN regexp_matches(v,'^[0-9]+$') THEN 'digits' WHEN v LIKE 'http%' THEN 'url' ELSE 'other' END AS SHAPE, count(*) AS N, min(v) AS EXAMPLE
       FROM (SELECT ID_EXTERNAL AS v FROM v1_entity UNION ALL SELECT url FROM pages UNION ALL SELECT s_suppkey::VARCHAR FROM supplier UNION ALL SELECT s_name FROM supplier) GROUP BY 1""",
)
def external_id_shape(d):
    ids = (
        d.v1_entity.select(F.col("ID_EXTERNAL").alias("v"))
        .union(d.pages.select("url"))
        .union(d.supplier.select(F.col("s_suppkey").cast("string")))
        .union(d.supplier.select("s_name"))
    )
    return ids.groupBy(tx.external_id_shape(F.col("v")).alias("SHAPE")).agg(F.count(F.lit(1)).alias("N"), F.min("v").alias("EXAMPLE"))


@query(
    "duration_text",
    """SELECT o_orderkey, CASE WHEN h>0 THEN h||'h '||lpad(m::VARCHAR,2,'0')||'m '||lpad(s::VARCHAR,2,'0')||'s' ELSE m||'m '||lpad(s::VARCHAR,2,'0')||'s' END AS SHORT,
        concat_ws(', ', CASE WHEN dd>0 THEN dd||' day'||CASE WHEN dd<>1 THEN 's' ELSE '' END END, CASE WHEN hh>0 THEN hh||' hour'||CASE WHEN hh<>1 THEN 's' ELSE '' END END,
         CASE WHEN m>0 THEN m||' minute'||CASE WHEN m<>1 THEN 's' ELSE '' END END, CASE WHEN s>0 THEN s||' second'||CASE WHEN s<>1 THEN 's' ELSE '' END END) AS LONG
       FROM (SELECT o_orderkey, x//3600 AS h, x%3600//60 AS m, x%60 AS s, x//86400 AS dd, x%86400//3600 AS hh FROM (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS x FROM orders))""",
)
def duration_text(d):
    secs = F.floor("o_totalprice")
    return d.orders.select("o_orderkey", tx.short_duration(secs).alias("SHORT"), tx.long_duration(secs).alias("LONG"))


@query(
    "translate_genres_fr",
    """SELECT p_partkey, replace(replace(replace(replace('|'||g||'|War|','|Comedy|','|Comédie|'),'|Drama|','|Drame|'),'|TV Movie|','|Téléfilm|'),'|War|','|Guerre|') AS GENRES
       FROM (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Comedy' WHEN 'LARGE' THEN 'Drama' WHEN 'PROMO' THEN 'TV Movie' ELSE p_type END AS g FROM part)""",
)
def translate_genres_fr(d):
    t = F.col("p_type")
    name = F.when(t == "ECONOMY", "Comedy").when(t == "LARGE", "Drama").when(t == "PROMO", "TV Movie").otherwise(t)
    return d.part.select("p_partkey", tx.translate_genres_fr(F.concat(F.lit("|"), name, F.lit("|War|"))).alias("GENRES"))


@query(
    "strip_json_section",
    """SELECT page_id, length(t) AS LEN, md5(t) AS DIGEST
       FROM (SELECT page_id, regexp_replace(html,'<script>.*?</script>','[cut]','gs') AS t FROM pages)""",
)
def strip_json_section(d):
    cut = tx.strip_json_section(F.col("html"), "<script>", "</script>", "[cut]")
    return d.pages.select("page_id", F.length(cut).cast("bigint").alias("LEN"), F.md5(cut).alias("DIGEST"))


@query(
    "work_queue",
    """SELECT event_id, "value" AS RATING FROM (SELECT event_id, CASE WHEN event_type='error' THEN NULL ELSE "value" END AS "value", ts FROM events) t
       WHERE ts < TIMESTAMP '2024-01-12 00:00:00' ORDER BY "value" DESC NULLS LAST, event_id LIMIT 1000""",
)
def work_queue(d):
    rows = d.events.select("event_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("RATING"))
    return ranking.work_queue(rows, "ts", F.to_timestamp(F.lit(NOW)), 20, "RATING", "event_id").select("event_id", "RATING")


@query(
    "keyset_page",
    "SELECT ID_WIKIDATA, ENTITY_CLASS FROM kg_entity WHERE ID_WIKIDATA > 'Q3000000999' ORDER BY ID_WIKIDATA LIMIT 500",
)
def keyset_page(d):
    return ranking.keyset_page(d.kg_entity.select("ID_WIKIDATA", "ENTITY_CLASS"), "ID_WIKIDATA", "Q3000000999", 500)


@query("bounded_sample", "SELECT ID_WIKIDATA FROM kg_entity ORDER BY ID_WIKIDATA DESC LIMIT 200")
def bounded_sample(d):
    return ranking.bounded_sample(d.kg_entity.select("ID_WIKIDATA"), "ID_WIKIDATA", 200)


@query("stable_bigint", f"SELECT doc_id, {stable_bigint('text')} AS ID FROM documents")
def stable_bigint_of_text(d):
    from kgspark.functions.ident import stable_bigint as ids

    return d.documents.select("doc_id", ids(F.col("text")).alias("ID"))
