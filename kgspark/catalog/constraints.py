"""Constraint checks and gates."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.catalog.writes import collapsed_qualifiers, flipped_parents
from kgspark.operators import checks

c = F.col


def typed_children(d):
    """Typed value rows of all statements, plus a second row for each line of every seventh order."""
    own = d.kg_claim.select("ID_STATEMENT", c("VALUE_TYPE").alias("CHILD_TABLE"))
    stray = d.kg_claim.filter(c("l_orderkey") % 7 == 0).select("ID_STATEMENT", F.lit("string").alias("CHILD_TABLE"))
    return own.union(stray)


def children(d):
    """Typed value rows, and a row for each order, whose parent is missing."""
    lost = d.orders.select(c("o_orderkey").alias("ID_STATEMENT"), F.lit("item").alias("CHILD_TABLE"))
    return typed_children(d).union(lost)


@query(
    "check_parent_type",
    """SELECT ID_STATEMENT, VALUE_TYPE AS CHILD_TABLE, 'parent has another type' AS PROBLEM FROM kg_claim WHERE l_quantity::INT%2=0
       UNION ALL SELECT ID_STATEMENT, 'string', 'parent has another type' FROM kg_claim WHERE l_orderkey%7=0 AND NOT (l_quantity::INT%2=0 AND VALUE_TYPE='item')
       UNION ALL SELECT o_orderkey, 'item', 'parent missing' FROM orders""",
)
def check_parent_type(d):
    return checks.check_parent_type(children(d), flipped_parents(d), "ID_STATEMENT")


@query("check_single_child", "SELECT ID_STATEMENT, 2 AS TABLES FROM kg_claim WHERE l_orderkey%7=0")
def check_single_child(d):
    return checks.check_single_child(children(d), "ID_STATEMENT")


@query(
    "check_foreign_keys",
    """SELECT 'line to part' AS FK, count(*) AS N FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size<=40)
       UNION ALL SELECT 'order to customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal>0)""",
)
def check_foreign_keys(d):
    a = checks.check_foreign_key(d.lineitem, "l_partkey", d.part.filter(c("p_size") <= 40), "p_partkey")
    b = checks.check_foreign_key(d.orders, "o_custkey", d.customer.filter(c("c_acctbal") > 0), "c_custkey")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("N")).select(F.lit(name).alias("FK"), "N")
    return count(a, "line to part").union(count(b, "order to customer"))


@query(
    "check_named_foreign_keys",
    """WITH st AS (SELECT ID_STATEMENT, ID_PROPERTY FROM kg_claim WHERE DELETED=0), p AS (SELECT unnest(['P166','P585','P805']) AS ID_PROPERTY), q AS (SELECT * FROM kg_qualifier),
       m AS (SELECT ID_STATEMENT, ID_STATEMENT + 1 AS r FROM kg_claim WHERE VALUE_TYPE='item' AND l_quantity::INT % 2 = 0)
       SELECT 'statement to property' AS FK, count(*) AS N FROM st WHERE ID_PROPERTY NOT IN (SELECT ID_PROPERTY FROM p)
       UNION ALL SELECT 'value to statement', count(*) FROM kg_claim WHERE ID_STATEMENT NOT IN (SELECT ID_STATEMENT FROM st)
       UNION ALL SELECT 'qualifier to statement', count(*) FROM q WHERE ID_STATEMENT NOT IN (SELECT ID_STATEMENT FROM st)
       UNION ALL SELECT 'qualifier to property', count(*) FROM q WHERE ID_QUALIFIER_PROPERTY NOT IN (SELECT ID_PROPERTY FROM p)
       UNION ALL SELECT 'media to statement', count(*) FROM m WHERE ID_STATEMENT NOT IN (SELECT ID_STATEMENT FROM st)
       UNION ALL SELECT 'url to resource', count(*) FROM kg_claim WHERE VALUE_TYPE='item' AND ID_STATEMENT + 1 NOT IN (SELECT r FROM m)""",
)
def check_named_foreign_keys(d):
    """Live claims are the statements; items of even quantity have a resource, all items an address."""
    item = d.kg_claim.filter(c("VALUE_TYPE") == "item").withColumn("ID_MEDIA_RESOURCE", c("ID_STATEMENT") + 1)
    return checks.check_foreign_keys(
        {
            "STATEMENT": d.kg_claim.filter(c("DELETED") == 0).select("ID_STATEMENT", "ID_PROPERTY"),
            "PROPERTY_METADATA": d.spark.createDataFrame([("P166",), ("P585",), ("P805",)], "ID_PROPERTY string"),
            "VALUE": d.kg_claim.select("ID_STATEMENT"),
            "STATEMENT_QUALIFIER": d.kg_qualifier.select("ID_STATEMENT", "ID_QUALIFIER_PROPERTY"),
            "MEDIA_RESOURCE": item.filter(c("l_quantity").cast("int") % 2 == 0).select("ID_STATEMENT", "ID_MEDIA_RESOURCE"),
            "MEDIA_RESOURCE_URL": item.select("ID_MEDIA_RESOURCE"),
        }
    )


@query("check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS N FROM lineitem GROUP BY 1,2 HAVING count(*)>1")
def check_unique(d):
    return checks.check_unique(d.lineitem, ["l_orderkey", "l_linenumber"])


@query("check_unique_hash", "SELECT 'qualifier|'||SNAK_HASH AS QUALIFIER_HASH, count(*) AS N FROM kg_qualifier GROUP BY 1 HAVING count(*)>1")
def check_unique_hash(d):
    return checks.check_unique(collapsed_qualifiers(d), ["QUALIFIER_HASH"])


@query(
    "orphan_statements",
    "SELECT ID_STATEMENT FROM kg_claim WHERE ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM v2_entity)",
)
def orphan_statements(d):
    return checks.orphan_statements(d.kg_claim.select("ID_STATEMENT", "ID_WIKIDATA"), d.v2_entity.select("ID_WIKIDATA")).select("ID_STATEMENT")


@query(
    "pass_gate",
    """SELECT 'PARSE_ERRORS' AS METRIC, count(*) FILTER (event_type='error') AS "VALUE", '== 0' AS RULE, count(*) FILTER (event_type='error')=0 AS OK FROM events
       UNION ALL SELECT 'CORE_ENTITIES', count(*), '>= 1', count(*)>=1 FROM customer UNION ALL SELECT 'STATEMENTS', count(*), '>= 1', count(*)>=1 FROM lineitem""",
)
def pass_gate(d):
    tags = (
        d.events.filter(c("event_type") == "error").select(F.lit("e").alias("t"))
        .union(d.customer.select(F.lit("c"))).union(d.lineitem.select(F.lit("s")))
    )
    summary = tags.agg(
        F.count_if(c("t") == "e").alias("PARSE_ERRORS"), F.count_if(c("t") == "c").alias("CORE_ENTITIES"), F.count_if(c("t") == "s").alias("STATEMENTS")
    )
    return checks.pass_gate(summary)


@query(
    "staging_gate",
    """SELECT 'STAGED' AS METRIC, count(*) AS "VALUE", '>= 1' AS RULE, count(*)>=1 AS OK FROM kg_statement UNION ALL
       SELECT 'NULL_BATCH', count(*) FILTER (DELETED=1), '== 0', count(*) FILTER (DELETED=1)=0 FROM kg_statement""",
)
def staging_gate(d):
    from kgspark.catalog.writes import maybe_batch

    return checks.staging_gate(maybe_batch(d))


@query(
    "target_gate",
    """SELECT 'STATEMENTS' AS METRIC, count(*) AS "VALUE", '>= 1' AS RULE, count(*)>=1 AS OK FROM lineitem UNION ALL
       SELECT 'LOADED_ROWS', count(*), '>= 1', count(*)>=1 FROM kg_statement WHERE IMPORT_BATCH_ID='batch_1997' AND VALUE_TYPE='item'""",
)
def target_gate(d):
    staged = d.kg_statement.withColumn("ROW_STATUS", F.when(c("VALUE_TYPE") == "item", "LOADED").otherwise("NEW"))
    return checks.target_gate(d.lineitem, staged, "batch_1997")


@query(
    "payload_validation",
    """SELECT doc_id, n>0 AND NOT dup AS VALID FROM (SELECT doc_id, len(w) AS n, len(w)<>len(list_distinct(w)) AS dup FROM (SELECT doc_id, list_transform(string_split(lang||' '||source||' '||text,' '), lambda x: length(x)) AS w FROM documents))""",
)
def payload_validation(d):
    from kgspark.plans.snapshots import valid_provider_catalog

    words = F.split(F.concat_ws(" ", "lang", "source", "text"), " ")
    # One catalogue per document: provider ids are word lengths, so equal lengths clash.
    results = F.transform(words, lambda w: F.struct((F.length(w) + 1).alias("provider_id"), F.create_map(F.lit("FR"), F.lit(1)).alias("display_priorities")))
    payload = F.to_json(F.struct(results.alias("results")))
    return d.documents.select("doc_id", payload.alias("payload")).select("doc_id", valid_provider_catalog(F.col("payload")).alias("VALID"))


@query(
    "run_summary",
    """SELECT (SELECT count(*) FROM lineitem) AS ENTITIES_SEEN, (SELECT count(*) FROM lineitem) AS ITEMS_SEEN, 0 AS PROPERTIES_SEEN, (SELECT count(*) FROM events WHERE event_type='error') AS PARSE_ERRORS""",
)
def run_summary(d):
    from kgspark.sources import dump

    broken = d.events.filter(c("event_type") == "error").select(F.regexp_replace("props", r"\}$", "").alias("value"))
    return checks.lines_summary(dump.parse_marked(dump.clean_lines(d.dump_lines.union(broken)), ("id", "type")))
