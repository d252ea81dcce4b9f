"""Aggregations."""

from pyspark.sql import functions as F

from kgspark.functions import n
from kgspark.catalog.registry import query
from kgspark.functions import text as tx
from kgspark.operators import aggregates as ag



@query("count_by_type_and_rank", 'SELECT VALUE_TYPE, "RANK", count(*) AS N FROM kg_statement GROUP BY 1,2')
def count_by_type_and_rank(d):
    return ag.count_by(d.kg_statement, "VALUE_TYPE", "RANK")


@query(
    "global_counts",
    "SELECT count(*) AS STATEMENTS, count(*) FILTER (VALUE_TYPE='item') AS ITEMS, count(*) FILTER (DELETED=1) AS DELETED_ROWS FROM kg_claim",
)
def global_counts(d):
    return d.kg_claim.agg(
        F.count(F.lit(1)).alias("STATEMENTS"), F.count_if(F.col("VALUE_TYPE") == "item").alias("ITEMS"), F.count_if(F.col("DELETED") == 1).alias("DELETED_ROWS")
    )


@query(
    "distinct_counts",
    "SELECT ID_PROPERTY, count(DISTINCT ID_WIKIDATA) AS SUBJECTS, count(DISTINCT CASE WHEN DELETED=0 THEN ID_ITEM END) AS LIVE_ITEMS FROM kg_claim GROUP BY 1",
)
def distinct_counts(d):
    return d.kg_claim.groupBy("ID_PROPERTY").agg(
        F.count_distinct("ID_WIKIDATA").alias("SUBJECTS"), F.count_distinct(F.when(F.col("DELETED") == 0, F.col("ID_ITEM"))).alias("LIVE_ITEMS")
    )


@query(
    "conditional_sums",
    """SELECT o_orderstatus, sum(CASE WHEN o_totalprice>250000 THEN 1 ELSE 0 END)::BIGINT AS BIG, sum(CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END)::BIGINT AS URGENT,
       round(100.0::DOUBLE*sum(CASE WHEN o_totalprice>250000 THEN 1 ELSE 0 END)/count(*),1) AS PCT_BIG FROM orders GROUP BY 1""",
)
def conditional_sums(d):
    big = F.count_if(F.col("o_totalprice") > 250000)
    return d.orders.groupBy("o_orderstatus").agg(
        big.alias("BIG"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("URGENT"), tx.safe_pct(big, F.count(F.lit(1))).alias("PCT_BIG")
    )


@query(
    "having_two_awards",
    "SELECT ID_WIKIDATA, count(*) AS AWARDS FROM kg_claim WHERE ID_PROPERTY='P166' AND ID_ITEM IS NOT NULL GROUP BY 1 HAVING count(*) >= 2",
)
def having_two_awards(d):
    won = d.kg_claim.filter((F.col("ID_PROPERTY") == "P166") & F.col("ID_ITEM").isNotNull())
    return won.groupBy("ID_WIKIDATA").agg(F.count(F.lit(1)).alias("AWARDS")).filter(F.col("AWARDS") >= 2)


@query(
    "occurrences_per_value",
    """SELECT ID_QUALIFIER_PROPERTY, count(*) AS "ROWS", count(DISTINCT VALUE_TEXT) AS DISTINCT_VALUES, round(count(*)/count(DISTINCT VALUE_TEXT),2) AS PER_VALUE,
       CASE WHEN count(*)=count(DISTINCT VALUE_TEXT) THEN 'ALERT' ELSE 'ok' END AS VERDICT FROM kg_qualifier GROUP BY 1""",
)
def occurrences_per_value(d):
    return ag.occurrences(d.kg_qualifier, ["ID_QUALIFIER_PROPERTY"], "VALUE_TEXT")


@query(
    "collapse_verdict_per_batch",
    """SELECT IMPORT_BATCH_ID, ID_PROPERTY, count(*) AS "ROWS", count(DISTINCT ID_WIKIDATA) AS DISTINCT_VALUES, round(count(*)/count(DISTINCT ID_WIKIDATA),2) AS PER_VALUE,
       CASE WHEN count(*)=count(DISTINCT ID_WIKIDATA) THEN 'ALERT' ELSE 'ok' END AS VERDICT FROM kg_statement GROUP BY 1,2""",
)
def collapse_verdict_per_batch(d):
    return ag.occurrences(d.kg_statement, ["IMPORT_BATCH_ID", "ID_PROPERTY"], "ID_WIKIDATA")


@query(
    "batch_span",
    """SELECT event_type, count(*) AS N, strftime(min(ts),'%Y-%m-%d %H:%M:%S') AS FIRST_AT, strftime(max(ts),'%Y-%m-%d %H:%M:%S') AS LAST_AT, datesub('hour',min(ts),max(ts)) AS HOURS FROM events GROUP BY 1""",
)
def batch_span(d):
    return ag.batch_span(d.events, "event_type", "ts")


@query("hourly_histogram", "SELECT strftime(date_trunc('hour',ts),'%Y-%m-%d %H:00') AS HOUR, count(*) AS N FROM events GROUP BY 1")
def hourly_histogram(d):
    return ag.hourly(d.events, "ts")


@query("yearly_histogram_top", "SELECT year(l_shipdate)::INT AS YEAR, count(*) AS N FROM lineitem GROUP BY 1 ORDER BY N DESC, YEAR LIMIT 5")
def yearly_histogram_top(d):
    return ag.yearly_top(d.lineitem, "l_shipdate", 5)


@query(
    "table_counts",
    """SELECT 'region' AS TABLE_NAME, count(*) AS N FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier
       UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'none', count(*) FROM orders WHERE o_orderkey<0""",
)
def table_counts(d):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    return ag.table_counts({**{n: d.table(n) for n in names}, "none": d.orders.filter(F.col("o_orderkey") < 0)})


@query(
    "alias_volume",
    """SELECT count(*) FILTER (a<>'') AS ROWS_WITH_ALIASES, sum(CASE WHEN a<>'' THEN strlen(a)-strlen(replace(a,'|',''))+1 END)::BIGINT AS ALIASES
       FROM (SELECT CASE WHEN p_size>10 THEN p_name||'|'||p_type||'|'||p_brand WHEN p_size>5 THEN p_name ELSE '' END AS a FROM part)""",
)
def alias_volume(d):
    size = F.col("p_size")
    a = F.when(size > 10, F.concat_ws("|", "p_name", "p_type", "p_brand")).when(size > 5, F.col("p_name")).otherwise("")
    return ag.alias_volume(d.part.select(a.alias("a")), "a")


@query(
    "pipe_lists",
    """SELECT conv_id, '|'||string_agg(role,'|' ORDER BY t, role)||'|' AS LIST FROM (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY 1,2) GROUP BY 1""",
)
def pipe_lists(d):
    return ag.pipe_lists(d.conversations, "conv_id", "role", "turn")


@query("top_parts", "SELECT l_partkey, count(*) AS N FROM lineitem GROUP BY 1 ORDER BY N DESC, l_partkey LIMIT 25")
def top_parts(d):
    return ag.top_by_count(d.lineitem, "l_partkey", 25)


@query("deprecated_share", """SELECT count(*) AS TOTAL, count(*) FILTER ("RANK"='deprecated') AS PART, round(100.0::DOUBLE*count(*) FILTER ("RANK"='deprecated')/count(*),1) AS PCT FROM kg_statement""")
def deprecated_share(d):
    return ag.share(d.kg_statement, F.col("RANK") == "deprecated")
