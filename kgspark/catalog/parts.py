"""Sinks, staging files, partial loads, guards and exact identities."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgspark.catalog.mixed import ME, parsed
from kgspark.catalog.registry import query
from kgspark.catalog.twins import stable_bigint
from kgspark.functions import ident
from kgspark.operators import claims, merge
from kgspark.plans import refresh as rf
from kgspark.plans import reports
from kgspark.plans import snapshots as sn
from kgspark.session import cut, cut_path
from kgspark.sources import staging, tables
from kgspark.sources.driver import CUSTOMER, ORDER, qid

c = F.col
n = lambda: F.count(F.lit(1)).alias("N")


@query(
    "written_tables",
    """SELECT 'MOVIE' AS TABLE_NAME, o_orderstatus AS PART, count(*) AS N FROM orders GROUP BY 2 UNION ALL SELECT 'PERSON', c_mktsegment, count(*) FROM customer GROUP BY 2""",
)
def written_tables(d):
    """Two tables written by one call, partitioned, and read back."""
    folder = cut_path(d.spark, "tables")
    tables.write_tables({"MOVIE": d.orders.withColumn("PART", c("o_orderstatus")), "PERSON": d.customer.withColumn("PART", c("c_mktsegment"))}, folder, partition_by=["PART"])
    return merge.union_rows(*[d.spark.read.parquet(f"{folder}/{t}").select(F.lit(t).alias("TABLE_NAME"), "PART") for t in ("MOVIE", "PERSON")]).groupBy("TABLE_NAME", "PART").agg(n())


@query(
    "staged_files",
    """SELECT 'PERSON' AS TABLE_NAME, 'pass2' AS PASS, count(*) AS N, sum(c_custkey)::BIGINT AS KEYS FROM customer WHERE c_acctbal>0 UNION ALL SELECT 'PERSON', 'item_cache', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_acctbal<=0
       UNION ALL SELECT 'SUBCLASS', 'pass1', count(*), sum(n_nationkey)::BIGINT FROM nation""",
)
def staged_files(d):
    """Staging files laid down where their specs say, and read by table: persons come from two passes, series from none."""
    root, schema = cut_path(d.spark, "staging"), T.StructType.fromDDL("ID_WIKIDATA string, K long")
    rows = {
        ("PERSON", "pass2"): d.customer.filter(c("c_acctbal") > 0).select(qid(CUSTOMER, "c_custkey").alias("ID_WIKIDATA"), c("c_custkey").alias("K")),
        ("PERSON", "item_cache"): d.customer.filter(c("c_acctbal") <= 0).select(qid(CUSTOMER, "c_custkey").alias("ID_WIKIDATA"), c("c_custkey").alias("K")),
        ("SUBCLASS", "pass1"): d.nation.select(qid(2, "n_nationkey").alias("ID_WIKIDATA"), c("n_nationkey").alias("K")),
    }
    for spec in staging.select_specs(["PERSON", "SUBCLASS"]):
        rows[(spec.table.removeprefix("STG_"), spec.folder)].write.json(f"{root}/{spec.folder}/{spec.file}")
    read = [staging.read_staging_table(d.spark, root, f"STG_{t}", schema, "b1").withColumn("TABLE_NAME", F.lit(t)) for t in ("PERSON", "SUBCLASS")]
    of_pass = F.regexp_extract("SOURCE_FILE", r"/(pass1|pass2|item_cache)/", 1).alias("PASS")
    return merge.union_rows(*read).groupBy("TABLE_NAME", of_pass).agg(n(), F.sum("K").alias("KEYS"))


@query(
    "cached_claims",
    f"""SELECT {ME} AS ID_WIKIDATA, 'P31' AS ID_PROPERTY, 'Q5' AS ID_ITEM, {stable_bigint("'statement|'||c_custkey||'$a'")} AS ID_STATEMENT FROM customer
        UNION ALL SELECT {ME}, 'P345', NULL, {stable_bigint("'statement|'||c_custkey||'$b'")} FROM customer WHERE c_acctbal>0""",
)
def cached_claims(d):
    """Of label-only entities the class facts and database ids stay; names and pictures do not."""
    return claims.cached_claims(parsed(d).filter(c("type") == "item")).select("ID_WIKIDATA", "ID_PROPERTY", "v.ID_ITEM", "ID_STATEMENT")


@query(
    "prune_guard",
    """SELECT 'batch_1995' AS BATCH, NOT EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey=o_orderkey WHERE year(o_orderdate)=1995) AS REFUSED, (SELECT count(*) FROM orders JOIN lineitem ON l_orderkey=o_orderkey WHERE year(o_orderdate)>=1995) AS N
       UNION ALL SELECT 'batch_2999', true, (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey=o_orderkey)""",
)
def prune_guard(d):
    """A prune around a batch without statements is refused and leaves all rows."""
    rows = []
    for batch in ("batch_1995", "batch_2999"):
        try:
            merge.prune_guard(d.kg_statement, batch)
            rows.append(merge.prune_older(d.kg_statement, batch).agg(n()).select(F.lit(batch).alias("BATCH"), F.lit(False).alias("REFUSED"), "N"))
        except merge.GuardError:
            rows.append(d.kg_statement.agg(n()).select(F.lit(batch).alias("BATCH"), F.lit(True).alias("REFUSED"), "N"))
    return merge.union_rows(*rows)


@query("reset_and_load", """SELECT VALUE_TYPE, count(*) AS N, 'new' AS SOURCE FROM kg_statement WHERE IMPORT_BATCH_ID='batch_1996' GROUP BY 1""")
def reset_and_load(d):
    """Tables are emptied, schemas kept, and take the next load."""
    old = {"STATEMENT": d.kg_statement.select("ID_STATEMENT", "VALUE_TYPE", "IMPORT_BATCH_ID", F.lit("old").alias("SOURCE"))}
    empty = merge.reset_all(old)["STATEMENT"]
    fresh = d.kg_statement.filter(c("IMPORT_BATCH_ID") == "batch_1996").select("ID_STATEMENT", "VALUE_TYPE", "IMPORT_BATCH_ID", F.lit("new").alias("SOURCE"))
    return merge.upsert(empty, fresh, ["ID_STATEMENT"]).groupBy("VALUE_TYPE", "SOURCE").agg(n())


@query(
    "schema_gap",
    """WITH a AS (SELECT column_name, column_type FROM (DESCRIBE SELECT * FROM orders)), b AS (SELECT column_name FROM (DESCRIBE SELECT * FROM lineitem))
       SELECT 'ORDERS' AS TABLE_NAME, column_name AS COLUMN_NAME, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' ELSE 'timestamp_ntz' END AS DATA_TYPE FROM a WHERE column_name<>'o_custkey'
       UNION ALL SELECT 'LINES', column_name, 'bigint' FROM b WHERE column_name='l_linenumber'""",
)
def schema_gap(d):
    """Columns that the new tables lack: all of the orders but one, and the line number."""
    old = {"ORDERS": d.orders, "LINES": d.lineitem.withColumn("l_linenumber", c("l_linenumber").cast("bigint"))}
    return reports.schema_gap(old, {"ORDERS": d.orders.select("o_custkey"), "LINES": d.lineitem.drop("l_linenumber")})


def staged(rows, batch):
    return rows.select("*", F.lit(batch).alias("IMPORT_BATCH_ID"), F.lit("NEW").alias("ROW_STATUS"), F.lit(None).cast("string").alias("ERROR_MESSAGE"), F.lit(1).cast("long").alias("ID_STG_ROW"))


@query(
    "qualifier_value_tables_load",
    """WITH q AS (SELECT ID_STATEMENT_QUALIFIER AS i, VALUE_TYPE AS t, ID_ITEM AS x, DISPLAY_ORDER AS o, VALUE_TEXT AS v FROM kg_qualifier)
       SELECT 'QUALIFIER_ITEM_VALUE' AS TABLE_NAME, i AS ID, x AS "VALUE", '2024-02-01' AS TIM_UPDATED FROM q WHERE t='item' UNION ALL SELECT 'QUALIFIER_STRING_VALUE', i, v, '2024-02-01' FROM q WHERE t='string' AND o=1
       UNION ALL SELECT 'QUALIFIER_STRING_VALUE', i, 'old', '2020-01-01' FROM q WHERE t='string' AND o=2""",
)
def qualifier_value_tables_load(d):
    """A load of qualifiers alone: their typed values enter, and values of another type leave first (every item was a string before)."""
    # Written once: targets and staging are all read from it.
    q = cut(d.kg_qualifier.select("ID_STATEMENT_QUALIFIER", "VALUE_TYPE", "ID_ITEM", "VALUE_TEXT", "DISPLAY_ORDER"), "qualifiers")
    key, old = "ID_STATEMENT_QUALIFIER", F.lit("2020-01-01").alias("TIM_UPDATED")
    fresh = q.filter((c("VALUE_TYPE") != "string") | (c("DISPLAY_ORDER") == 1))
    targets = {
        "STATEMENT_QUALIFIER": q.select(key, "VALUE_TYPE", old).limit(0), "QUALIFIER_ITEM_VALUE": q.select(key, "ID_ITEM", old).limit(0),
        "QUALIFIER_STRING_VALUE": q.filter(c("VALUE_TYPE").isin("string", "item")).select(key, F.lit("old").alias("VALUE_STRING"), old),
    }
    load = {
        "STATEMENT_QUALIFIER": staged(fresh.select(key, "VALUE_TYPE"), "b"), "QUALIFIER_ITEM_VALUE": staged(fresh.filter(c("VALUE_TYPE") == "item").select(key, "ID_ITEM"), "b"),
        "QUALIFIER_STRING_VALUE": staged(fresh.filter(c("VALUE_TYPE") == "string").select(key, c("VALUE_TEXT").alias("VALUE_STRING")), "b"),
    }
    out, _ = rf.full_load(targets, load, "b", F.lit("2024-02-01"), rf.QUALIFIERS_ONLY)
    shown = {"QUALIFIER_ITEM_VALUE": "ID_ITEM", "QUALIFIER_STRING_VALUE": "VALUE_STRING"}
    return merge.union_rows(*[out[t].select(F.lit(t).alias("TABLE_NAME"), c(key).alias("ID"), c(v).alias("VALUE"), "TIM_UPDATED") for t, v in shown.items()])


@query(
    "subclass_only_load",
    """SELECT ID_CHILD, ID_PARENT, CASE WHEN ID_CHILD LIKE 'Q2%' THEN 'b1' ELSE 'b0' END AS IMPORT_BATCH_ID, false AS REFUSED FROM kg_subclass UNION ALL SELECT NULL, NULL, 'b9', true""",
)
def subclass_only_load(d):
    """A load of the class graph alone; a batch with no rows is refused."""
    edges = d.kg_subclass.select("ID_CHILD", "ID_PARENT")
    target = edges.withColumn("IMPORT_BATCH_ID", F.lit("b0")).withColumn("TIM_UPDATED", F.lit("2020-01-01")).withColumn("DAT_CREAT", F.lit("2020-01-01"))
    load = {"SUBCLASS": staged(edges.filter(c("ID_CHILD").startswith("Q2")), "b1"), "STATEMENT": staged(d.kg_statement.select("ID_STATEMENT"), "b1")}
    out, _ = rf.full_load({"SUBCLASS": target}, load, "b1", F.lit("2024-02-01"), rf.SUBCLASS_ONLY)
    try:
        rf.full_load({"SUBCLASS": target}, load, "b9", F.lit("2024-02-01"), rf.SUBCLASS_ONLY)
        refused = False
    except merge.GuardError:
        refused = True
    rows = out["SUBCLASS"].select("ID_CHILD", "ID_PARENT", "IMPORT_BATCH_ID", F.lit(False).alias("REFUSED"))
    none = F.lit(None).cast("string")
    return rows.union(d.region.limit(1).select(none, none, F.lit("b9"), F.lit(refused)))


# Claims without a GUID whose canonical text is not obvious: (raw text, canonical text), %s is the order's key.
HARD = (
    ('{"b":1.50,"a":"é%s"}', '{"a":"é%s","b":1.5}'), ('{"a":1,"b":%s,"a":2}', '{"a":2,"b":%s}'), ('{"n":12345678901234567890123456789012345678901%s}', '{"n":12345678901234567890123456789012345678901%s}'),
    ('{ "z" : [ 1e3 , -0 ] , "a" : "\\u00fc%s" }', '{"a":"ü%s","z":[1000.0,0]}'), ("{broken %s", "{broken %s"),
)


def _filled(text):
    head, tail = text.split("%s")
    return F.concat(F.lit(head), c("o_orderkey").cast("string"), F.lit(tail))


def _sql(text):
    head, tail = text.split("%s")
    return f"'{head}'||o_orderkey||'{tail}'"


@query(
    "exact_identities",
    "SELECT o_orderkey, k AS CASE_NO, t AS CANONICAL, " + stable_bigint("'statement|Q'||(6000000000+o_orderkey)||'|P1|'||t") + " AS ID_STATEMENT FROM ("
    + " UNION ALL ".join(f"SELECT o_orderkey, {k} AS k, {_sql(want)} AS t FROM orders" for k, (_, want) in enumerate(HARD)) + ")",
)
def exact_identities(d):
    """Fractions, repeated keys, long integers, escapes and text that is no JSON: every claim has one identity."""
    cases = F.explode(F.array(*[F.struct(F.lit(k).alias("CASE_NO"), _filled(raw).alias("raw")) for k, (raw, _) in enumerate(HARD)])).alias("x")
    rows = d.orders.select("o_orderkey", cases).select("o_orderkey", "x.CASE_NO", ident.canonical_json(c("x.raw")).alias("CANONICAL"))
    return rows.withColumn("ID_STATEMENT", ident.statement_id(F.lit(""), qid(ORDER, "o_orderkey"), F.lit("P1"), c("CANONICAL")))


@query(
    "statement_values_all_types",
    """WITH s AS (SELECT ID_STATEMENT, VALUE_TYPE, VALUE_TEXT FROM kg_claim UNION ALL SELECT c_custkey*3+n, t, c_name||n FROM customer, (VALUES (0,'string'),(1,'external_id'),(2,'media')) v(n,t))
       SELECT ID_STATEMENT, VALUE_TEXT, VALUE_TYPE AS VALUE_TABLE FROM s UNION ALL SELECT -1-c_custkey, NULL, NULL FROM customer""",
)
def statement_values_all_types(d):
    """All six typed tables, and statements without a value."""
    kinds = {"string": (0, "VALUE_STRING"), "external_id": (1, "VALUE_EXTERNAL_ID"), "media": (2, "FILE_NAME")}
    own = lambda k, name: d.customer.select((c("c_custkey") * 3 + k).alias("ID_STATEMENT"), F.concat("c_name", F.lit(str(k))).alias(name))
    values = {t: own(k, name) for t, (k, name) in kinds.items()}
    values |= {t: d.kg_claim.filter(c("VALUE_TYPE") == t).select("ID_STATEMENT", name) for t, name in (("item", "ID_ITEM"), ("time", "RAW_TIME_VALUE"), ("quantity", "AMOUNT"))}
    ids = merge.union_rows(*[v.select("ID_STATEMENT") for v in values.values()], d.customer.select((-1 - c("c_custkey")).alias("ID_STATEMENT")))
    parents = ids.withColumn("RANK", F.lit("normal")).withColumn("DELETED", F.lit(0))
    return claims.statement_values(parents, values).select("ID_STATEMENT", "VALUE_TEXT", "VALUE_TABLE")


@query(
    "localized_of_every_kind",
    """SELECT k AS KIND, o_orderkey AS ID, 'fr' AS LANG, CASE WHEN o_orderstatus='F' THEN NULL ELSE left(repeat(o_orderpriority,30),250) END AS TITLE, 'o'||o_orderkey AS OVERVIEW, '' AS TAGLINE FROM orders, (VALUES ('movie'),('serie'),('season'),('episode'),('collection')) v(k)""",
)
def localized_of_every_kind(d):
    """Title (named so for films only) and overview of all localised kinds; an empty title is not written."""
    title = F.when(c("o_orderstatus") == "F", "").otherwise(F.repeat("o_orderpriority", F.lit(30)))
    out = []
    for kind in ("movie", "serie", "season", "episode", "collection"):
        body = F.to_json(F.struct(title.alias("title" if kind == "movie" else "name"), F.concat(F.lit("o"), "o_orderkey").alias("overview")))
        rows = d.orders.select(F.lit(kind).alias("entity"), c("o_orderkey").alias("id"), F.lit("details").alias("endpoint"), F.lit("fr").alias("lang"), F.lit("2024-02-01").alias("fetched_at"), body.alias("payload"))
        out.append(sn.localized(rows, kind).select(F.lit(kind).alias("KIND"), c(f"ID_{kind.upper()}").alias("ID"), "LANG", "TITLE", "OVERVIEW", "TAGLINE"))
    return merge.union_rows(*out)


@query(
    "simple_details_of_every_kind",
    """SELECT k AS KIND, p_partkey AS ID, nullif(CASE WHEN p_size<10 THEN '' ELSE p_name END,'') AS NAME, CASE WHEN k IN ('company','network') THEN left(repeat(p_type,60), CASE k WHEN 'company' THEN 200 ELSE 5000 END) END AS HEADQUARTERS, CASE WHEN k='company' THEN p_size END::BIGINT AS ID_PARENT
       FROM part, (VALUES ('collection'),('company'),('network'),('keyword')) v(k)""",
)
def simple_details_of_every_kind(d):
    """Collections, companies, networks and keywords; companies cut their headquarters and name their parent."""
    out = []
    for kind in ("collection", "company", "network", "keyword"):
        parent = F.struct(c("p_size").cast("bigint").alias("id"))
        body = F.to_json(F.struct(F.when(c("p_size") < 10, "").otherwise(c("p_name")).alias("name"), F.repeat("p_type", F.lit(60)).alias("headquarters"), parent.alias("parent_company")))
        rows = d.part.select(F.lit(kind).alias("entity"), c("p_partkey").alias("id"), F.lit("details").alias("endpoint"), F.lit("en").alias("lang"), F.lit("2024-02-01").alias("fetched_at"), body.alias("payload"))
        found = sn.simple_details(rows, kind)
        have = lambda name, t, found=found: (c(name) if name in found.columns else F.lit(None)).cast(t).alias(name)
        out.append(found.select(F.lit(kind).alias("KIND"), c(f"ID_{kind.upper()}").alias("ID"), "NAME", have("HEADQUARTERS", "string"), have("ID_PARENT", "bigint")))
    return merge.union_rows(*out)
