"""Write semantics: upserts, purges, prunes, snapshots, ledgers."""

from pyspark.sql import functions as F

from kgspark.functions import n
from kgspark.catalog.registry import query
from kgspark.catalog.twins import stable_bigint
from kgspark.operators import merge
from kgspark.session import cut
from kgspark.sources.driver import ORDER, PART, qid

c = F.col


def base_orders(d):
    """Target: orders before 1999."""
    return d.orders.filter(c("o_orderdate") < F.lit("1999-01-01").cast("timestamp")).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.lit("old").alias("DAT_CREAT"), F.lit("old").alias("TIM_UPDATED")
    )


def next_orders(d):
    """Incoming: orders from 1996, changed, some priorities missing, every fifth twice."""
    rows = d.orders.filter(c("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")).select(
        "o_orderkey", F.lower("o_orderstatus").alias("o_orderstatus"), F.when(c("o_orderkey") % 3 != 0, c("o_orderpriority")).alias("o_orderpriority"),
        F.lit("new").alias("DAT_CREAT"), F.lit("new").alias("TIM_UPDATED"), F.lit(1).alias("ROW_NO"),
    )
    again = rows.filter(c("o_orderkey") % 5 == 0).withColumn("o_orderstatus", F.lit("z")).withColumn("ROW_NO", F.lit(2))
    return rows.unionByName(again)


UPSERT_SQL = """WITH t AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    i AS (SELECT o_orderkey, CASE WHEN o_orderkey%5=0 THEN 'z' ELSE lower(o_orderstatus) END AS o_orderstatus, CASE WHEN o_orderkey%3<>0 THEN o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
    SELECT coalesce(t.o_orderkey,i.o_orderkey) AS o_orderkey, CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
      {priority} AS o_orderpriority, CASE WHEN t.o_orderkey IS NOT NULL THEN 'old' ELSE 'new' END AS DAT_CREAT, CASE WHEN i.o_orderkey IS NOT NULL THEN 'now' ELSE 'old' END AS TIM_UPDATED
    FROM t FULL JOIN i ON t.o_orderkey=i.o_orderkey"""


@query("upsert_overwrite", UPSERT_SQL.format(priority="CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderpriority ELSE t.o_orderpriority END"))
def upsert_overwrite(d):
    policy = {"DAT_CREAT": "insert_only", "TIM_UPDATED": "now"}
    return merge.upsert(base_orders(d), next_orders(d), ["o_orderkey"], policy, F.lit("now"), order=["ROW_NO"])


@query("upsert_skip_null", UPSERT_SQL.format(priority="coalesce(i.o_orderpriority, t.o_orderpriority)"))
def upsert_skip_null(d):
    policy = {"DAT_CREAT": "insert_only", "TIM_UPDATED": "now", "o_orderpriority": "skip_null"}
    return merge.upsert(base_orders(d), next_orders(d), ["o_orderkey"], policy, F.lit("now"), order=["ROW_NO"])


@query(
    "upsert_audit_columns",
    """SELECT coalesce(t.k,i.k) AS k, coalesce(i.v,t.v) AS v, CASE WHEN t.k IS NOT NULL THEN '2020-01-01' ELSE '2024-02-01' END AS DAT_CREAT,
         CASE WHEN i.k IS NOT NULL THEN '2024-02-01 10:00:00' ELSE '2020-01-01 00:00:00' END AS TIM_UPDATED, CASE WHEN t.k IS NOT NULL THEN 1 ELSE 7 END AS ID_CREATOR, CASE WHEN i.k IS NOT NULL THEN 7 ELSE 1 END AS ID_USER_UPDATED
       FROM (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_acctbal>0) t FULL JOIN (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_nationkey<10) i ON t.k=i.k""",
)
def upsert_audit_columns(d):
    when = F.to_timestamp(F.lit("2020-01-01 00:00:00"))
    target = d.customer.filter(c("c_acctbal") > 0).select(
        c("c_custkey").alias("k"), c("c_name").alias("v"), when.cast("date").alias("DAT_CREAT"), when.alias("TIM_UPDATED"),
        F.lit(1).alias("ID_CREATOR"), F.lit(1).alias("ID_USER_UPDATED"),
    )
    rows = d.customer.filter(c("c_nationkey") < 10).select(c("c_custkey").alias("k"), c("c_mktsegment").alias("v"))
    out = merge.upsert_std(target, rows, ["k"], F.to_timestamp(F.lit("2024-02-01 10:00:00")), F.lit(7))
    return out.withColumn("DAT_CREAT", F.date_format("DAT_CREAT", "yyyy-MM-dd")).withColumn("TIM_UPDATED", F.date_format("TIM_UPDATED", "yyyy-MM-dd HH:mm:ss"))


@query(
    "mark_loaded",
    """SELECT IMPORT_BATCH_ID, CASE WHEN IMPORT_BATCH_ID='batch_1997' AND VALUE_TYPE<>'time' THEN 'LOADED' WHEN VALUE_TYPE='time' THEN 'ERROR' WHEN VALUE_TYPE='item' THEN 'NEW' ELSE 'VALID' END AS ROW_STATUS,
       count(*) AS N, count(CASE WHEN IMPORT_BATCH_ID='batch_1997' AND VALUE_TYPE<>'time' THEN NULL ELSE 1 END) AS WITH_MESSAGE FROM kg_statement GROUP BY 1,2""",
)
def mark_loaded(d):
    status = F.when(c("VALUE_TYPE") == "time", "ERROR").when(c("VALUE_TYPE") == "item", "NEW").otherwise("VALID")
    staged = d.kg_statement.select("IMPORT_BATCH_ID", status.alias("ROW_STATUS"), F.lit("x").alias("ERROR_MESSAGE"))
    return merge.mark_loaded(staged, "batch_1997").groupBy("IMPORT_BATCH_ID", "ROW_STATUS").agg(n(), F.count("ERROR_MESSAGE").alias("WITH_MESSAGE"))


def flipped_parents(d):
    """The same statements in a later batch: even quantities changed their type."""
    kind = c("VALUE_TYPE")
    other = F.when(kind == "item", "string").when(kind == "time", "item").otherwise("time")
    return d.kg_claim.select("ID_STATEMENT", F.when(c("l_quantity").cast("int") % 2 == 0, other).otherwise(kind).alias("VALUE_TYPE"))


@query("purge_type_flips", "SELECT ID_STATEMENT, ID_ITEM FROM kg_claim WHERE VALUE_TYPE='item' AND l_quantity::INT%2<>0")
def purge_type_flips(d):
    values = d.kg_claim.filter(c("VALUE_TYPE") == "item").select("ID_STATEMENT", "ID_ITEM")
    return merge.purge_type_flips(values, flipped_parents(d), "item")


@query("count_type_flips", "SELECT VALUE_TYPE AS CHILD_TABLE, count(*) AS CONFLICTS FROM kg_claim WHERE l_quantity::INT%2=0 GROUP BY 1")
def count_type_flips(d):
    tables = {k: d.kg_claim.filter(c("VALUE_TYPE") == k).select("ID_STATEMENT") for k in ("item", "time", "quantity")}
    return merge.count_type_flips(tables, flipped_parents(d))


def maybe_batch(d):
    batch = F.when(c("DELETED") == 0, c("IMPORT_BATCH_ID"))
    return d.kg_statement.select("ID_STATEMENT", "VALUE_TYPE", batch.alias("IMPORT_BATCH_ID"))


@query(
    "prune_older",
    """SELECT IMPORT_BATCH_ID, count(*) AS N FROM (SELECT CASE WHEN DELETED=0 THEN IMPORT_BATCH_ID END AS IMPORT_BATCH_ID FROM kg_statement) WHERE IMPORT_BATCH_ID IS NULL OR IMPORT_BATCH_ID >= 'batch_1998' GROUP BY 1""",
)
def prune_older(d):
    return merge.prune_older(maybe_batch(d), "batch_1998").groupBy("IMPORT_BATCH_ID").agg(n())


@query(
    "prune_cascade",
    """WITH s AS (SELECT ID_STATEMENT, VALUE_TYPE, CASE WHEN DELETED=0 THEN IMPORT_BATCH_ID END AS b FROM kg_statement), gone AS (SELECT ID_STATEMENT FROM s WHERE b < 'batch_1998'),
       m AS (SELECT ID_STATEMENT, l_quantity::INT % 3 = 1 AS odd FROM kg_statement WHERE VALUE_TYPE='item' AND l_quantity::INT % 2 = 0 AND ID_STATEMENT NOT IN (SELECT ID_STATEMENT FROM gone))
       SELECT 'statements' AS TABLE_NAME, count(*) AS N FROM s WHERE ID_STATEMENT NOT IN (SELECT ID_STATEMENT FROM gone)
       UNION ALL SELECT 'item values', count(*) FROM s WHERE VALUE_TYPE='item' AND ID_STATEMENT NOT IN (SELECT ID_STATEMENT FROM gone)
       UNION ALL SELECT 'qualifiers', count(*) FROM kg_qualifier WHERE ID_STATEMENT NOT IN (SELECT ID_STATEMENT FROM gone)
       UNION ALL SELECT 'qualifier items', count(*) FROM kg_qualifier WHERE VALUE_TYPE='item' AND ID_STATEMENT NOT IN (SELECT ID_STATEMENT FROM gone)
       UNION ALL SELECT 'media', count(*) FROM m UNION ALL SELECT 'media urls', 2*count(*) FROM m UNION ALL SELECT 'media checks', count(*) FROM m WHERE NOT odd
       UNION ALL SELECT 'subclass', count(*) FROM orders WHERE year(o_orderdate) >= 1998""",
)
def prune_cascade(d):
    from kgspark.operators.aggregates import table_counts

    # Stored tables, as a prune finds them: written once, for each is read by several steps.
    stored = cut(d.kg_statement.select("ID_STATEMENT", "VALUE_TYPE", "DELETED", "IMPORT_BATCH_ID", "l_quantity"), "statements")
    stmts = stored.select("ID_STATEMENT", "VALUE_TYPE", F.when(c("DELETED") == 0, c("IMPORT_BATCH_ID")).alias("IMPORT_BATCH_ID"))
    quals = cut(d.kg_qualifier.select("ID_STATEMENT_QUALIFIER", "ID_STATEMENT", "VALUE_TYPE"), "qualifiers").withColumn("IMPORT_BATCH_ID", F.lit(None).cast("string"))
    edges = d.orders.select(F.concat(F.lit("batch_"), F.year("o_orderdate").cast("string")).alias("IMPORT_BATCH_ID"))
    # A resource per item statement, of an old batch of its own for odd quantities; two addresses and a check below each.
    whole = c("l_quantity").cast("int")
    resource = stored.filter(c("VALUE_TYPE") == "item").withColumn("ID_MEDIA_RESOURCE", c("ID_STATEMENT") + 1)
    media = resource.select("ID_STATEMENT", "ID_MEDIA_RESOURCE", F.when(whole % 2 == 1, "batch_1990").alias("IMPORT_BATCH_ID"))
    urls = resource.select("ID_MEDIA_RESOURCE", F.explode(F.array(F.lit("page"), F.lit("file"))).alias("URL_KIND"))
    verdicts = resource.select("ID_MEDIA_RESOURCE", F.when(whole % 3 == 1, "batch_1991").alias("IMPORT_BATCH_ID"))
    out = merge.prune_cascade(
        stmts, {"item": stmts.filter(c("VALUE_TYPE") == "item")}, quals, {"item": quals.filter(c("VALUE_TYPE") == "item")},
        media, edges, "batch_1998", urls, verdicts,
    )
    return table_counts(
        {
            "statements": out["statements"],
            "item values": out["values"]["item"],
            "qualifiers": out["qualifiers"],
            "qualifier items": out["qualifier_values"]["item"],
            "media": out["media"],
            "media urls": out["media_urls"],
            "media checks": out["media_checks"],
            "subclass": out["subclass"],
        }
    )


@query("clear_staging", "SELECT IMPORT_BATCH_ID, count(*) AS N FROM kg_statement WHERE IMPORT_BATCH_ID<>'batch_1999' GROUP BY 1")
def clear_staging(d):
    return merge.clear_staging(d.kg_statement, "batch_1999").groupBy("IMPORT_BATCH_ID").agg(n())


def owner_rows(d):
    """Target rows per owner: each user's event values."""
    return d.events.select("user_id", c("event_id").alias("ITEM"), "event_type")


@query(
    "replace_snapshot",
    """SELECT user_id, ITEM, event_type FROM (
         SELECT user_id, event_id AS ITEM, event_type FROM events WHERE user_id%3=0 UNION ALL
         SELECT user_id, event_id+1000000, event_type FROM events WHERE user_id%3=1 AND event_type='click')""",
)
def replace_snapshot(d):
    # user_id % 3: 0 failed (kept), 1 replaced by new clicks, 2 answered with an empty list (cleared)
    new = d.events.filter((c("event_type") == "click") & (c("user_id") % 3 != 2)).select("user_id", (c("event_id") + 1000000).alias("ITEM"), "event_type")
    ok = d.events.filter(c("user_id") % 3 != 0).select("user_id")
    return merge.replace_snapshot(owner_rows(d), new, ok, "user_id")


PRUNE_SQL = """SELECT user_id, event_id AS ITEM, event_type FROM events WHERE user_id%3=0 OR (user_id%3=1 AND event_type='click') {keep}"""


@query("prune_absent_delete", PRUNE_SQL.format(keep=""))
def prune_absent_delete(d):
    listed = d.events.filter((c("event_type") == "click") & (c("user_id") % 3 == 1)).select("user_id", c("event_id").alias("ITEM"))
    ok = d.events.filter(c("user_id") % 3 != 0).select("user_id")
    return merge.prune_absent(owner_rows(d), listed, ok, "user_id", ["ITEM"], "delete")


@query("prune_absent_keep", PRUNE_SQL.format(keep="OR user_id%3=2"))
def prune_absent_keep(d):
    listed = d.events.filter((c("event_type") == "click") & (c("user_id") % 3 == 1)).select("user_id", c("event_id").alias("ITEM"))
    ok = d.events.filter(c("user_id") % 3 != 0).select("user_id")
    return merge.prune_absent(owner_rows(d), listed, ok, "user_id", ["ITEM"], "keep")


@query(
    "soft_delete_absent",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority='2-HIGH') THEN d WHEN coalesce(d,0)<>1 THEN 1 ELSE d END AS DELETED,
         CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority='2-HIGH') AND coalesce(d,0)<>1 THEN 'now' ELSE 'old' END AS TIM_UPDATED
       FROM (SELECT c_custkey, CASE WHEN c_nationkey<5 THEN 1 WHEN c_nationkey<10 THEN NULL ELSE 0 END AS d FROM customer)""",
)
def soft_delete_absent(d):
    nation = c("c_nationkey")
    target = d.customer.select("c_custkey", F.when(nation < 5, 1).when(nation < 10, F.lit(None)).otherwise(0).alias("DELETED"), F.lit("old").alias("TIM_UPDATED"))
    alive = d.orders.filter(c("o_orderpriority") == "2-HIGH").select(c("o_custkey").alias("c_custkey"))
    return merge.soft_delete_absent(target, alive, "c_custkey", F.lit("now"))


@query(
    "fill_empty",
    """SELECT o_orderkey, CASE WHEN t IS NULL OR t='' THEN coalesce(c_mktsegment, t) ELSE t END AS LABEL FROM (SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN '' ELSE o_orderpriority END AS t FROM orders)
       LEFT JOIN (SELECT * FROM customer WHERE c_acctbal>0) ON c_custkey=o_custkey""",
)
def fill_empty(d):
    status = c("o_orderstatus")
    target = d.orders.select("o_orderkey", "o_custkey", F.when(status == "P", F.lit(None)).when(status == "O", "").otherwise(c("o_orderpriority")).alias("LABEL"))
    source = d.customer.filter(c("c_acctbal") > 0).select(c("c_custkey").alias("o_custkey"), c("c_mktsegment").alias("LABEL"))
    return merge.fill_empty(target, source, ["o_custkey"], ["LABEL"]).select("o_orderkey", "LABEL")


@query(
    "move_rows",
    """WITH ids AS (SELECT DISTINCT source FROM documents WHERE n_chars > 5000), src AS (SELECT source, lang, min(text) AS L FROM documents GROUP BY 1,2)
       SELECT 'source' AS SIDE, source, lang, L FROM src WHERE source NOT IN (SELECT source FROM ids)
       UNION ALL SELECT 'target', source, NULL, max(L) FROM src WHERE source IN (SELECT source FROM ids) GROUP BY source""",
)
def move_rows(d):
    src = d.documents.groupBy("source", "lang").agg(F.min("text").alias("L"))
    target = src.limit(0).select("source", "L")
    ids = d.documents.filter(c("n_chars") > 5000).select("source").distinct()
    left, moved = merge.move_rows(src, target, ids, "source", ["L"])
    a = left.select(F.lit("source").alias("SIDE"), "source", "lang", "L")
    return a.union(moved.select(F.lit("target"), "source", F.lit(None).cast("string"), "L"))


@query(
    "cascade_delete",
    """SELECT 'MOVIE' AS TABLE_NAME, count(*) AS N FROM orders WHERE o_totalprice >= 100000 UNION ALL
       SELECT 'MOVIE_GENRE', count(*) FROM lineitem JOIN orders ON o_orderkey=l_orderkey WHERE o_totalprice >= 100000 UNION ALL SELECT 'MOVIE_COMPANY', count(*) FROM lineitem""",
)
def cascade_delete(d):
    from kgspark.operators.aggregates import table_counts

    rows = d.lineitem.select(c("l_orderkey").alias("ID_MOVIE"))
    tables = {"MOVIE": d.orders.select(c("o_orderkey").alias("ID_MOVIE")), "MOVIE_GENRE": rows, "MOVIE_COMPANY": rows}
    return table_counts(merge.cascade_delete(tables, "movie", d.orders.filter(c("o_totalprice") < 100000).select("o_orderkey")))


def collapsed_qualifiers(d):
    """Qualifier parents as the content-based identity left them."""
    from kgspark.functions.ident import stable_bigint as ids

    old_hash = F.concat(F.lit("qualifier|"), c("SNAK_HASH"))
    return d.kg_qualifier.select(ids(old_hash).alias("ID_STATEMENT_QUALIFIER"), "ID_STATEMENT", "ID_QUALIFIER_PROPERTY", old_hash.alias("QUALIFIER_HASH"))


@query(
    "repair_qualifier_ids",
    "SELECT ID_STATEMENT_QUALIFIER, VALUE_TEXT FROM kg_qualifier WHERE VALUE_TYPE='item'",
)
def repair_qualifier_ids(d):
    from kgspark.functions.ident import stable_bigint as ids

    old = ids(F.concat(F.lit("qualifier|"), c("SNAK_HASH")))
    items = d.kg_qualifier.filter(c("VALUE_TYPE") == "item").groupBy(old.alias("ID_STATEMENT_QUALIFIER")).agg(F.min("VALUE_TEXT").alias("VALUE_TEXT"))
    texts = d.kg_qualifier.filter(c("VALUE_TYPE") == "string").groupBy(old.alias("ID_STATEMENT_QUALIFIER")).agg(F.min("VALUE_TEXT").alias("VALUE_TEXT"))
    tables = {"item": items.withColumn("ROW_NO", F.lit(1)), "string": texts.withColumn("ROW_NO", F.lit(1))}
    _, values = merge.repair_qualifier_ids(collapsed_qualifiers(d), tables)
    return values["item"].select("ID_STATEMENT_QUALIFIER", "VALUE_TEXT")


@query(
    "repair_dry_run",
    """SELECT count(*) AS OCCURRENCES, count(DISTINCT SNAK_HASH) AS DISTINCT_BEFORE, count(DISTINCT ID_STATEMENT_QUALIFIER) AS DISTINCT_AFTER, count(*)-count(DISTINCT ID_STATEMENT_QUALIFIER) AS COLLISIONS,
       round(count(*)/count(DISTINCT SNAK_HASH),1) AS RECOVERY_FACTOR, 'ok' AS VERDICT FROM kg_qualifier""",
)
def repair_dry_run(d):
    return merge.repair_dry_run(collapsed_qualifiers(d))


@query(
    "qualifiers_only_load",
    """SELECT VALUE_TYPE, count(*) AS N, min(TIM_UPDATED) AS FIRST_AT, max(TIM_UPDATED) AS LAST_AT FROM (SELECT VALUE_TYPE, CASE WHEN DISPLAY_ORDER=1 THEN '2024-02-01' ELSE '2020-01-01' END AS TIM_UPDATED FROM kg_qualifier) GROUP BY 1""",
)
def qualifiers_only_load(d):
    from kgspark.plans.refresh import QUALIFIERS_ONLY, full_load

    q = d.kg_qualifier.select("ID_STATEMENT_QUALIFIER", "VALUE_TYPE", "DISPLAY_ORDER")
    target = q.filter((c("DISPLAY_ORDER") == 2) | (c("VALUE_TYPE") == "item")).withColumn("TIM_UPDATED", F.lit("2020-01-01"))
    staged = q.filter(c("DISPLAY_ORDER") == 1).select(
        "*", F.lit("b").alias("IMPORT_BATCH_ID"), F.lit("NEW").alias("ROW_STATUS"), F.lit("").alias("ERROR_MESSAGE"), F.lit(1).alias("ID_STG_ROW")
    )
    targets, _ = full_load({"STATEMENT_QUALIFIER": target}, {"STATEMENT_QUALIFIER": staged}, "b", F.lit("2024-02-01"), QUALIFIERS_ONLY)
    return targets["STATEMENT_QUALIFIER"].groupBy("VALUE_TYPE").agg(n(), F.min("TIM_UPDATED").alias("FIRST_AT"), F.max("TIM_UPDATED").alias("LAST_AT"))


OUTCOME_SQL = """CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'ok' WHEN 'view' THEN 'gone' WHEN 'click' THEN 'gone' ELSE 'error' END"""


def api_events(d):
    """Fetch outcomes per id from the event stream: payload text, then its outcome."""
    kind = c("event_type")
    payload = (
        F.when(kind == "error", "{broken").when(kind == "purchase", c("props")).when(kind.isin("view", "click"), '{"status_code":34}')
        .otherwise('{"status_code":25}')
    )
    return d.events.select(
        F.lit("movie").alias("ENTITY_TYPE"), c("user_id").alias("ID_ENTITY"), c("ts").alias("TS"), c("event_id").alias("SEQ"), merge.fetch_outcome(payload).alias("OUTCOME")
    )


@query("fetch_outcome", f"SELECT {OUTCOME_SQL} AS OUTCOME, count(*) AS N FROM events GROUP BY 1")
def fetch_outcome(d):
    return api_events(d).groupBy("OUTCOME").agg(n())


LEDGER_SQL = f"""WITH e AS (SELECT user_id, ts, event_id, {OUTCOME_SQL} AS o FROM events), k AS (SELECT user_id, max(CASE WHEN o='ok' THEN ts END) AS t FROM e GROUP BY 1)
    SELECT 'movie' AS ENTITY_TYPE, e.user_id AS ID_ENTITY, count(*) AS ATTEMPT_COUNT, strftime(min(ts),'%Y-%m-%d %H:%M:%S') AS TIM_FIRST_SEEN, strftime(max(ts),'%Y-%m-%d %H:%M:%S') AS TIM_LAST_SEEN,
      strftime(max(ts) + INTERVAL 1 DAY * (least(count(*),26)*7),'%Y-%m-%d %H:%M:%S') AS TIM_RETRY_AFTER FROM e JOIN k ON e.user_id=k.user_id WHERE o='gone' AND (t IS NULL OR ts > t) GROUP BY 2"""


def ledger_text(ledger):
    stamp = lambda n: F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n)
    return ledger.select("ENTITY_TYPE", "ID_ENTITY", "ATTEMPT_COUNT", stamp("TIM_FIRST_SEEN"), stamp("TIM_LAST_SEEN"), stamp("TIM_RETRY_AFTER"))


@query("not_found_ledger", LEDGER_SQL)
def not_found_ledger(d):
    return ledger_text(merge.not_found_ledger(api_events(d)))


@query(
    "run_ledger",
    """SELECT event_type AS NAME, n AS RUN_NO, v AS "VALUE", lag(v) OVER (PARTITION BY event_type ORDER BY n) AS PREVIOUS_VALUE FROM
       (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)::INT AS n, CASE WHEN length(v0)>255 THEN left(v0,252)||'...' ELSE v0 END AS v FROM (SELECT *, repeat(props, (1+event_id%40)::BIGINT) AS v0 FROM events))""",
)
def run_ledger(d):
    from kgspark.operators.ranking import display_order

    text = F.repeat("props", (1 + c("event_id") % 40).cast("int"))
    rows = d.events.select(c("event_type").alias("NAME"), text.alias("VALUE"), "ts", "event_id")
    runs = display_order(rows, ["NAME"], ["ts", "event_id"], "RUN_NO")
    return merge.run_ledger(runs.select("NAME", "RUN_NO", "VALUE"))


@query(
    "completion_stamp",
    """SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity>45) THEN 'now' ELSE o_orderpriority END AS TIM_CREDITS_COMPLETED, 'old' AS TIM_UPDATED FROM orders""",
)
def completion_stamp(d):
    table = d.orders.select("o_orderkey", c("o_orderpriority").alias("TIM_CREDITS_COMPLETED"), F.lit("old").alias("TIM_UPDATED"))
    ids = d.lineitem.filter(c("l_quantity") > 45).select(c("l_orderkey").alias("o_orderkey"))
    return merge.completion_stamp(table, ids, "o_orderkey", "TIM_CREDITS_COMPLETED", F.lit("now"))


@query("statement_keys", f"SELECT o_orderkey, {stable_bigint(chr(39) + 'statement|' + chr(39) + '||o_orderkey')} AS ID_STATEMENT, 'Q'||(6000000000+o_orderkey) AS S, 'Q'||(5000000000+o_custkey) AS P FROM orders")
def statement_keys(d):
    from kgspark.functions.ident import statement_id

    return d.orders.select(
        "o_orderkey", statement_id(c("o_orderkey").cast("string"), F.lit(""), F.lit("")).alias("ID_STATEMENT"), qid(ORDER, "o_orderkey").alias("S"), qid(PART, "o_custkey").alias("P")
    )
