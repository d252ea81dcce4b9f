"""A second driver dump: customers as people with every textual datatype, nations as property entities."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.catalog.twins import stable_bigint
from kgspark.operators import checks, claims, merge, scope
from kgspark.plans.job import run_batch
from kgspark.plans.refresh import empty_targets, full_load, refresh, staged_tables
from kgspark.sources import dump
from kgspark.sources.driver import CUSTOMER, qid

c = F.col
ROOTS = {"person": ("Q5",)}


def text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def claim(datatype, value, guid=None, given=None):
    """One claim; where ``given`` is false its snak has no value."""
    have = text('{"mainsnak":{"snaktype":"value","datatype":"', datatype, '","datavalue":{"value":', value, "}}")
    none = text('{"mainsnak":{"snaktype":"novalue","datatype":"', datatype, '"}')
    snak = have if given is None else F.when(given, have).otherwise(none)
    return text(snak, ',"rank":"normal"', *([',"id":"', guid, '"'] if guid is not None else []), "}")


def lines(d, customers=None, named="string"):
    """People: class, database id (none for customers in debt), name as text, picture without a GUID. Properties: two formatters, the first empty."""
    key = c("c_custkey").cast("string")
    name, segment = text('"', c("c_name"), '"'), text('"', c("c_mktsegment"), '"')
    person = text(
        '{"type":"item","id":"', qid(CUSTOMER, "c_custkey"), '","labels":{"en":{"language":"en","value":', name, '}},"descriptions":{},"claims":{"P31":[',
        claim("wikibase-item", F.lit('{"id":"Q5"}'), text(key, "$a")), '],"P345":[', claim("external-id", text('"nm', key, '"'), text(key, "$b"), c("c_acctbal") > 0),
        '],"P1448":[', claim(named, segment, text(key, "$c")), '],"P18":[', claim("commonsMedia", text('"', c("c_name"), '.jpg"')), "]}}",
    )
    formatter = text('"https://x.example/', c("n_name"), '/$1"')
    prop = text(
        '{"type":"property","id":"P9', c("n_nationkey").cast("string"), '","datatype":"', F.when(c("n_regionkey") == 0, "external-id").otherwise("string"),
        '","labels":{"en":{"language":"en","value":"', c("n_name"), '"}},"descriptions":{},"claims":{"P1630":[', claim("string", F.lit('""')), ",", claim("string", formatter), "]}}",
    )
    return (d.customer if customers is None else customers).select(person.alias("value")).union(d.nation.select(prop.alias("value")))


def parsed(d):
    return dump.parse_entities(lines(d))[0]


ME = "'Q'||(3000000000+c_custkey)"
PICTURE = """'{"mainsnak":{"datatype":"commonsMedia","datavalue":{"value":"'||c_name||'.jpg"},"snaktype":"value"},"rank":"normal"}'"""


@query(
    "textual_values",
    f"""SELECT {ME} AS ID_WIKIDATA, 'P345' AS ID_PROPERTY, 'external_id' AS VALUE_TYPE, 'nm'||c_custkey AS VALUE_TEXT, {stable_bigint("'statement|'||c_custkey||'$b'")} AS ID_STATEMENT FROM customer WHERE c_acctbal > 0
        UNION ALL SELECT {ME}, 'P1448', 'string', c_mktsegment, {stable_bigint("'statement|'||c_custkey||'$c'")} FROM customer
        UNION ALL SELECT {ME}, 'P18', 'media', c_name||'.jpg', {stable_bigint(f"'statement|'||{ME}||'|P18|'||{PICTURE}")} FROM customer""",
)
def textual_values(d):
    """Strings, external ids and media files of the dump; a claim without GUID is known by its canonical text."""
    stmts = claims.statements(claims.explode_claims(parsed(d).filter(c("type") == "item"), ["P345", "P1448", "P18"]))
    tables, rows = claims.value_tables(stmts), stmts.select("ID_STATEMENT", "ID_WIKIDATA", "ID_PROPERTY", "VALUE_TYPE")
    column = {"string": "VALUE_STRING", "external_id": "VALUE_EXTERNAL_ID", "media": "FILE_NAME"}
    values = None
    for kind, name in column.items():
        part = tables[kind].select("ID_STATEMENT", c(name).alias("VALUE_TEXT"))
        values = part if values is None else values.union(part)
    return rows.join(values, "ID_STATEMENT").select("ID_WIKIDATA", "ID_PROPERTY", "VALUE_TYPE", "VALUE_TEXT", "ID_STATEMENT")


@query("entity_rows", f"SELECT {ME} AS ID_WIKIDATA, c_name AS LABEL_EN, NULL::VARCHAR AS DESCRIPTION_EN, 1 AS LANGUAGES FROM customer")
def entity_rows(d):
    rows = dump.entity_row(parsed(d).filter(c("type") == "item"))
    return rows.select("ID_WIKIDATA", "LABEL_EN", "DESCRIPTION_EN", F.size("LABELS").alias("LANGUAGES"))


@query(
    "property_rows",
    """SELECT 'P9'||n_nationkey AS ID_PROPERTY, n_name AS PROPERTY_LABEL, CASE WHEN n_regionkey=0 THEN 'external_id' ELSE 'string' END AS LOCAL_VALUE_TYPE,
       CASE WHEN n_regionkey=0 THEN 'EXTERNAL_ID_VALUE' ELSE 'STRING_VALUE' END AS EXPECTED_CHILD_TABLE, 'https://x.example/'||n_name||'/$1' AS FORMATTER_URL FROM nation""",
)
def property_rows(d):
    return claims.property_metadata(parsed(d)).select("ID_PROPERTY", "PROPERTY_LABEL", "LOCAL_VALUE_TYPE", "EXPECTED_CHILD_TABLE", "FORMATTER_URL")


@query("class_sidecar", f"SELECT {ME} AS ID_WIKIDATA, 'Q5' AS CLASSES, c_acctbal > 0 AS HAS_IMDB FROM customer")
def class_sidecar(d):
    return scope.p31_sidecar(parsed(d)).select("ID_WIKIDATA", F.array_join("P31", "|").alias("CLASSES"), "HAS_IMDB")


@query(
    "refresh_summary",
    """WITH n AS (SELECT count(*) AS people, count(*) FILTER (c_acctbal > 0) AS core FROM customer), p AS (SELECT count(*) AS k FROM nation)
       SELECT people+k AS ENTITIES_SEEN, people AS ITEMS_SEEN, k AS PROPERTIES_SEEN, 0 AS PARSE_ERRORS, core AS CORE_ENTITIES, 4*core AS STATEMENTS, 0 AS QUALIFIERS, true AS PASSED FROM n, p""",
)
def refresh_summary(d):
    """A whole run over the dump, its counters and the verdict of the gate on them."""
    summary = refresh(dump.clean_lines(lines(d)), ROOTS).summary
    passed = checks.pass_gate(summary).agg(F.every("OK").alias("PASSED"), F.lit(1).alias("one"))
    return summary.drop("CORE_BY_CLASS", "VALUES_BY_TYPE").withColumn("one", F.lit(1)).join(passed, "one").drop("one")


@query(
    "loaded_tables",
    """WITH n AS (SELECT count(*) AS core FROM customer WHERE c_acctbal > 0)
       SELECT 'PERSON' AS TABLE_NAME, core AS N FROM n UNION ALL SELECT 'STATEMENT', 4*core FROM n UNION ALL SELECT 'ITEM_VALUE', core FROM n UNION ALL SELECT 'EXTERNAL_ID_VALUE', core FROM n
       UNION ALL SELECT 'STRING_VALUE', core FROM n UNION ALL SELECT 'MEDIA_VALUE', core FROM n UNION ALL SELECT 'PROPERTY_METADATA', count(*) FROM nation""",
)
def loaded_tables(d):
    """From dump text to loaded target tables: rows by table, empty ones left out."""
    staging = staged_tables(refresh(dump.clean_lines(lines(d)), ROOTS), "b1")
    targets, _ = full_load(empty_targets(staging), staging, "b1", F.lit("2024-05-01").cast("timestamp"))
    out = None
    for name, table in targets.items():
        part = table.select(F.lit(name).alias("TABLE_NAME"))
        out = part if out is None else out.union(part)
    return out.groupBy("TABLE_NAME").agg(F.count(F.lit(1)).alias("N"))


def counted(tables):
    """Rows by table, empty ones left out."""
    return merge.union_rows(*[t.select(F.lit(name).alias("TABLE_NAME")) for name, t in tables.items()]).groupBy("TABLE_NAME").agg(F.count(F.lit(1)).alias("N"))


@query(
    "two_batches",
    """WITH n AS (SELECT count(*) FILTER (c_acctbal > 0) AS first, count(*) FILTER (c_acctbal > 0 AND c_custkey%3<>0) AS core, count(*) FILTER (c_acctbal > 0 AND c_custkey%3<>0 AND c_custkey%5=0) AS flipped FROM customer),
         t AS (SELECT unnest([{'t': 'PERSON', 'n': first}, {'t': 'STATEMENT', 'n': 4*core}, {'t': 'ITEM_VALUE', 'n': core}, {'t': 'EXTERNAL_ID_VALUE', 'n': core+flipped}, {'t': 'STRING_VALUE', 'n': core-flipped}, {'t': 'MEDIA_VALUE', 'n': core},
           {'t': 'MEDIA_RESOURCE', 'n': core}, {'t': 'MEDIA_RESOURCE_URL', 'n': 3*core}, {'t': 'PROPERTY_METADATA', 'n': (SELECT count(*) FROM nation)}]) AS r FROM n)
       SELECT r.t AS TABLE_NAME, r.n::BIGINT AS N FROM t WHERE r.n > 0""",
)
def two_batches(d):
    """Two dumps through one job: in the second a third of the people is missing, and for some a statement's type changed. Rows by table after the prune."""
    now = F.lit("2024-05-01").cast("timestamp")
    first = run_batch(dump.clean_lines(lines(d)), {}, "b1", now, ROOTS)
    second = d.customer.filter(c("c_custkey") % 3 != 0)
    flipped = F.when(c("c_custkey") % 5 == 0, "external-id").otherwise("string")
    return counted(run_batch(dump.clean_lines(lines(d, second, flipped)), first.tables, "b2", now, ROOTS).tables)


@query(
    "job_verdicts",
    """WITH n AS (SELECT count(*) FILTER (c_acctbal > 0) AS core FROM customer) SELECT STEP, METRIC, VALUE::BIGINT AS "VALUE", RULE, true AS OK FROM n, LATERAL (VALUES ('pass','PARSE_ERRORS',0,'== 0'), ('pass','CORE_ENTITIES',core,'>= 1'), ('pass','STATEMENTS',4*core,'>= 1'),
         ('staging','STAGED',4*core,'>= 1'), ('staging','NULL_BATCH',0,'== 0'), ('target','STATEMENTS',4*core,'>= 1'), ('target','LOADED_ROWS',4*core,'>= 1'), ('media','URLS of commons',3*core,'> 0')) v(STEP, METRIC, VALUE, RULE)""",
)
def job_verdicts(d):
    """What the gates of one run said."""
    return run_batch(dump.clean_lines(lines(d)), {}, "b1", F.lit("2024-05-01").cast("timestamp"), ROOTS).verdicts
