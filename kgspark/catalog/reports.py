"""Reconciliation and audit reports."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.operators import aggregates as ag
from kgspark.plans import reports as rp

c = F.col
ID = "ID_WIKIDATA"
A = "(SELECT * FROM v1_entity WHERE DELETED=0)"
B = "(SELECT * FROM v2_entity WHERE DELETED=0)"
MISSING = f"(SELECT * FROM {A} a WHERE NOT EXISTS (SELECT 1 FROM {B} b WHERE a.ID_WIKIDATA=b.ID_WIKIDATA AND a.ENTITY_CLASS=b.ENTITY_CLASS))"


def labels(d):
    """Labels of the class values used as INSTANCE_OF."""
    return d.orders.select(c("o_orderpriority").alias(ID), F.upper("o_orderpriority").alias("LABEL_EN")).distinct()


@query(
    "inclusion",
    f"""SELECT ENTITY_CLASS, count(*) FILTER (s<>2) AS V1_ACTIVE, count(*) FILTER (s<>1) AS V2_ACTIVE, count(*) FILTER (s=1) AS V1_MISSING, round(100.0::DOUBLE*count(*) FILTER (s=1)/nullif(count(*) FILTER (s<>2),0),2) AS PCT_MISSING,
        count(*) FILTER (s<>2)-count(*) FILTER (s<>1) AS RAW_GAP FROM (SELECT ENTITY_CLASS, ID_WIKIDATA, sum(s) AS s FROM (SELECT ENTITY_CLASS, ID_WIKIDATA, 1 AS s FROM {A} UNION ALL SELECT ENTITY_CLASS, ID_WIKIDATA, 2 FROM {B}) GROUP BY 1,2) GROUP BY 1""",
)
def inclusion(d):
    return rp.inclusion(d.v1_entity, d.v2_entity)


@query(
    "missing_elsewhere",
    f"""SELECT ENTITY_CLASS, count(*) AS MISSING, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM v2_entity)) AS IN_ANOTHER_TABLE, count(*) FILTER (ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM v2_entity)) AS NOWHERE FROM {MISSING} GROUP BY 1""",
)
def missing_elsewhere(d):
    return rp.missing_elsewhere(d.v1_entity, d.v2_entity)


@query(
    "destination",
    f"""SELECT a.ENTITY_CLASS, coalesce(b.ENTITY_CLASS,'nowhere') AS DESTINATION, count(*) AS N FROM {A} a LEFT JOIN v2_entity b ON a.ID_WIKIDATA=b.ID_WIKIDATA GROUP BY 1,2""",
)
def destination(d):
    return rp.destination(d.v1_entity, d.v2_entity, ["MOVIE", "SERIE", "PERSON", "ITEM"])


@query(
    "missing_by_class",
    f"""SELECT INSTANCE_OF, count(*) AS N, CASE WHEN INSTANCE_OF IN (SELECT o_orderpriority FROM orders) THEN upper(INSTANCE_OF) END AS LABEL FROM {MISSING} GROUP BY 1 ORDER BY N DESC, INSTANCE_OF LIMIT 25""",
)
def missing_by_class(d):
    return rp.missing_by_class(d.v1_entity, d.v2_entity, labels(d))


@query(
    "class_used_flag",
    """SELECT CLASS_ID AS INSTANCE_OF, count(*) AS N, CLASS_ID IN (SELECT ID_ITEM FROM kg_fact WHERE ID_PROPERTY='P31') AS USED_AS_CLASS FROM (SELECT CLASS_ID FROM kg_entity UNION ALL SELECT o_orderpriority FROM orders) GROUP BY 1""",
)
def class_used_flag(d):
    classes = d.kg_entity.select(c("CLASS_ID").alias("INSTANCE_OF")).union(d.orders.select("o_orderpriority"))
    return rp.class_used_flag(classes, d.kg_fact)


@query(
    "value_gap",
    f"""SELECT ID_ITEM, count(*) AS N FROM v1_triple t WHERE ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM {A} WHERE ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM {B}))
        AND NOT EXISTS (SELECT 1 FROM v2_triple n WHERE n.ID_WIKIDATA=t.ID_WIKIDATA AND n.ID_PROPERTY=t.ID_PROPERTY AND n.ID_ITEM=t.ID_ITEM) GROUP BY 1 ORDER BY N DESC, ID_ITEM LIMIT 25""",
)
def value_gap(d):
    return rp.value_gap(d.v1_entity, d.v2_entity, d.v1_triple, d.v2_triple)


@query(
    "missing_by_bucket",
    f"""SELECT coalesce(ID_EXTERNAL,'')<>'' AS HAS_EXTERNAL, CASE WHEN ID_EXTERNAL IS NULL THEN 'empty' WHEN ID_EXTERNAL LIKE 'nm%' THEN 'nm_digits' ELSE 'tt_digits' END AS SHAPE,
        CASE WHEN substr(ID_WIKIDATA,2)::BIGINT < 3000001000 THEN 'old' WHEN substr(ID_WIKIDATA,2)::BIGINT < 6000005000 THEN 'middle' ELSE 'recent' END AS AGE, count(*) AS N, min(ID_EXTERNAL) AS EXAMPLE FROM {MISSING} GROUP BY 1,2,3""",
)
def missing_by_bucket(d):
    return rp.missing_by_bucket(d.v1_entity, d.v2_entity, [(3_000_001_000, "old"), (6_000_005_000, "middle")], "recent")


@query(
    "fill_rate",
    """SELECT ENTITY_CLASS, count(*) AS "ROWS", count(*) FILTER (coalesce(LABEL_EN,'')<>'') AS LABEL_EN, count(*) FILTER (coalesce(ID_EXTERNAL,'')<>'') AS ID_EXTERNAL FROM v1_entity GROUP BY 1""",
)
def fill_rate(d):
    return ag.fill_rate(d.v1_entity, ["LABEL_EN", "ID_EXTERNAL"], ["ENTITY_CLASS"])


RECOVER_SQL = """SELECT 'ID_EXTERNAL' AS COLUMN_NAME, 'P166' AS ID_PROPERTY, count(*) AS FILLED, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_claim WHERE ID_PROPERTY='P166')) AS RECOVERABLE,
    round(100.0::DOUBLE*count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_claim WHERE ID_PROPERTY='P166'))/count(*),1) AS PCT FROM {src} WHERE coalesce(ID_EXTERNAL,'')<>''
    UNION ALL SELECT 'LABEL_EN', 'P1411', count(*), count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_claim WHERE ID_PROPERTY='P1411')),
    round(100.0::DOUBLE*count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_claim WHERE ID_PROPERTY='P1411'))/count(*),1) FROM {src} WHERE coalesce(LABEL_EN,'')<>''"""
RECOVER = {"ID_EXTERNAL": "P166", "LABEL_EN": "P1411"}


@query("column_recoverable", RECOVER_SQL.format(src=A))
def column_recoverable(d):
    return rp.column_recoverable(d.v1_entity, RECOVER, d.kg_claim)


@query("column_recoverable_sample", RECOVER_SQL.format(src=f"(SELECT * FROM {A} ORDER BY ID_WIKIDATA DESC LIMIT 2000)"))
def column_recoverable_sample(d):
    return rp.column_recoverable(d.v1_entity, RECOVER, d.kg_claim, 2000)


TEXT_SQL = """(SELECT source AS ID_WIKIDATA, lang AS LANG, min(text) AS LABEL FROM documents GROUP BY 1,2)"""


def texts(d):
    return d.documents.groupBy(c("source").alias(ID), c("lang").alias("LANG")).agg(F.min("text").alias("LABEL"))


@query(
    "label_coverage",
    f"""SELECT a.LANG, count(*) AS V1_FILLED, count(b.LABEL) AS ALSO_V2, count(*)-count(b.LABEL) AS LOST FROM {TEXT_SQL} a
        LEFT JOIN (SELECT source AS ID_WIKIDATA, lang AS LANG, min(text) AS LABEL FROM documents WHERE source NOT LIKE '%7' GROUP BY 1,2) b ON a.ID_WIKIDATA=b.ID_WIKIDATA AND a.LANG=b.LANG WHERE a.LANG IN ('fr','de') AND a.LABEL<>'' GROUP BY 1""",
)
def label_coverage(d):
    rows = d.documents.filter(~c("source").endswith("7")).groupBy(c("source").alias(ID), c("lang").alias("LANG")).agg(F.min("text").alias("LABEL"))
    # One map per id, of at most one entry per language.
    maps = rows.groupBy(ID).agg(F.map_from_entries(F.collect_list(F.struct("LANG", "LABEL"))).alias("LABELS"))
    return rp.label_coverage(texts(d), maps, ["fr", "de"])


@query(
    "translation_real",
    """SELECT count(*) AS PAIRS, count(*) FILTER (a=b) AS FALLBACK, count(*) FILTER (a<>b) AS TRANSLATED FROM (SELECT CASE WHEN o_orderkey%3=0 THEN o_orderpriority ELSE 'fr '||o_orderpriority END AS a, o_orderpriority AS b FROM orders)""",
)
def translation_real(d):
    fr = d.orders.select(
        c("o_orderkey").alias(ID), F.lit("fr").alias("LANG"), F.when(c("o_orderkey") % 3 == 0, c("o_orderpriority")).otherwise(F.concat(F.lit("fr "), c("o_orderpriority"))).alias("LABEL")
    )
    en = d.orders.select(c("o_orderkey").alias(ID), F.lit("en").alias("LANG"), c("o_orderpriority").alias("LABEL"))
    return rp.translation_real(fr.unionByName(en), "fr")


@query(
    "reverse_links",
    """WITH l AS (SELECT o_orderkey AS i, o_custkey AS f FROM orders), m AS (SELECT o_orderkey AS i, CASE WHEN o_orderstatus='O' THEN o_custkey+1 ELSE o_custkey END AS f FROM orders WHERE o_totalprice > 100000)
       SELECT count(*) AS LINKS, count(*) FILTER (b) AS RECIPROCAL, count(*) FILTER (NOT b AND (x OR y)) AS OTHER_PARTNER, count(*) FILTER (NOT x AND NOT y) AS UNKNOWN FROM
       (SELECT EXISTS (SELECT 1 FROM m WHERE m.i=l.i AND m.f=l.f) AS b, EXISTS (SELECT 1 FROM m WHERE m.i=l.i) AS x, EXISTS (SELECT 1 FROM m WHERE m.f=l.f) AS y FROM l)""",
)
def reverse_links(d):
    links = d.orders.select(c("o_orderkey").alias(ID), c("o_custkey").alias("ID_FOREIGN"))
    partner = F.when(c("o_orderstatus") == "O", c("o_custkey") + 1).otherwise(c("o_custkey"))
    mirror = d.orders.filter(c("o_totalprice") > 100000).select(c("o_orderkey").alias(ID), partner.alias("ID_FOREIGN"))
    return rp.reverse_links(links, mirror)


@query(
    "recovery_paths",
    """WITH l AS (SELECT o_orderkey AS i, o_custkey AS f, o_totalprice AS p, o_orderpriority AS q FROM orders) SELECT count(*) AS LINKS, count(*) FILTER (p>200000) AS PATH_A, count(*) FILTER (q<>'5-LOW') AS PATH_B, count(*) FILTER (p>200000 OR q<>'5-LOW') AS EITHER_PATH,
       count(*) FILTER (NOT (p>200000 OR q<>'5-LOW')) AS NO_PATH FROM l""",
)
def recovery_paths(d):
    o = d.orders.select(c("o_orderkey").alias(ID), c("o_custkey").alias("ID_FOREIGN"), "o_totalprice", "o_orderpriority")
    by_property = o.filter(c("o_totalprice") > 200000).select(ID, c("ID_FOREIGN").cast("string").alias("VALUE_TEXT"))
    return rp.recovery_paths(o.select(ID, "ID_FOREIGN"), by_property, o.filter(c("o_orderpriority") != "5-LOW").select(ID, "ID_FOREIGN"))


@query(
    "image_coverage",
    """SELECT count(*) AS WITH_IMAGE, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM media_statement)) AS COVERED, round(100.0::DOUBLE*count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM media_statement))/count(*),1) AS PCT FROM v1_entity WHERE coalesce(ID_EXTERNAL,'')<>''""",
)
def image_coverage(d):
    return rp.image_coverage(d.v1_entity, "ID_EXTERNAL", d.media_statement)


@query(
    "silent_entities",
    f"""SELECT ENTITY_CLASS, count(*) AS ENTITIES, count(*) FILTER (ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM kg_claim)) AS SILENT, round(100.0::DOUBLE*count(*) FILTER (ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM kg_claim))/count(*),1) AS PCT_SILENT FROM {B} GROUP BY 1""",
)
def silent_entities(d):
    return rp.silent_entities(d.v2_entity, d.kg_claim)


@query(
    "silent_known",
    f"""SELECT count(*) AS SILENT, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM v1_triple)) AS KNOWN_IN_V1 FROM {B} WHERE ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM kg_claim WHERE VALUE_TYPE='item')""",
)
def silent_known(d):
    return rp.silent_known(d.v2_entity, d.kg_claim.filter(c("VALUE_TYPE") == "item"), d.v1_triple)


@query(
    "reference_origin",
    """SELECT count(*) AS ITEMS, count(*) FILTER (m) AS AS_MAIN_VALUE, count(*) FILTER (NOT m AND q) AS QUALIFIER_ONLY, count(*) FILTER (NOT m AND NOT q) AS NEVER FROM
       (SELECT ID_WIKIDATA IN (SELECT ID_ITEM FROM kg_claim WHERE ID_ITEM IS NOT NULL) AS m, ID_WIKIDATA IN (SELECT ID_ITEM FROM kg_qualifier WHERE ID_ITEM IS NOT NULL) AS q FROM kg_entity)""",
)
def reference_origin(d):
    return rp.reference_origin(d.kg_entity, d.kg_claim, d.kg_qualifier)


LOST = "(SELECT * FROM v1_triple t WHERE NOT EXISTS (SELECT 1 FROM v2_triple n WHERE n.ID_WIKIDATA=t.ID_WIKIDATA AND n.ID_PROPERTY=t.ID_PROPERTY AND n.ID_ITEM=t.ID_ITEM))"


@query(
    "carrier_properties",
    """SELECT ID_PROPERTY, count(DISTINCT ID_ITEM) AS ITEMS, count(*) AS LINKS FROM v1_triple WHERE ID_ITEM NOT IN (SELECT ID_ITEM FROM v2_triple) GROUP BY 1 ORDER BY ITEMS DESC, ID_PROPERTY LIMIT 25""",
)
def carrier_properties(d):
    gone = d.v1_triple.select("ID_ITEM").distinct().join(d.v2_triple.select("ID_ITEM"), "ID_ITEM", "left_anti").select(c("ID_ITEM").alias(ID))
    return rp.carrier_properties(gone, d.v1_triple)


@query(
    "subject_presence",
    f"""SELECT ID_PROPERTY, count(*) AS LINKS, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM v2_entity)) AS SUBJECT_PRESENT, count(*) FILTER (ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM v2_entity)) AS SUBJECT_ABSENT, count(DISTINCT ID_WIKIDATA) AS SUBJECTS FROM {LOST} GROUP BY 1""",
)
def subject_presence(d):
    return rp.subject_presence(rp.lost_triples(d.v1_triple, d.v2_triple), d.v2_entity)


@query(
    "start_set_coverage",
    """SELECT ID_PROPERTY, count(*) AS V1_ITEMS, count(*) FILTER (k) AS COVERED, round(100.0::DOUBLE*count(*) FILTER (k)/count(*),1) AS PCT FROM (SELECT ID_PROPERTY, ID_ITEM,
       bool_or(EXISTS (SELECT 1 FROM v2_triple n WHERE n.ID_WIKIDATA=t.ID_WIKIDATA AND n.ID_PROPERTY=t.ID_PROPERTY AND n.ID_ITEM=t.ID_ITEM)) AS k FROM v1_triple t GROUP BY 1,2) GROUP BY 1""",
)
def start_set_coverage(d):
    return rp.start_set_coverage(d.v1_triple, d.v2_triple)


@query(
    "qualifier_collapse",
    """SELECT ID_QUALIFIER_PROPERTY, VALUE_TYPE, count(*) AS "ROWS", count(DISTINCT VALUE_TEXT) AS DISTINCT_VALUES, round(count(*)/count(DISTINCT VALUE_TEXT),2) AS PER_VALUE, CASE WHEN count(*)=count(DISTINCT VALUE_TEXT) THEN 'ALERT' ELSE 'ok' END AS VERDICT
       FROM (SELECT * FROM kg_qualifier UNION ALL BY NAME SELECT 'P9999' AS ID_QUALIFIER_PROPERTY, 'string' AS VALUE_TYPE, o_orderkey::VARCHAR AS VALUE_TEXT FROM orders) GROUP BY 1,2""",
)
def qualifier_collapse(d):
    kept_once = d.orders.select(F.lit("P9999").alias("ID_QUALIFIER_PROPERTY"), F.lit("string").alias("VALUE_TYPE"), c("o_orderkey").cast("string").alias("VALUE_TEXT"))
    rows = d.kg_qualifier.select("ID_QUALIFIER_PROPERTY", "VALUE_TYPE", "VALUE_TEXT").unionByName(kept_once)
    return ag.occurrences(rows, ["ID_QUALIFIER_PROPERTY", "VALUE_TYPE"], "VALUE_TEXT")


PRESENCE = [("P166", "P585"), ("P166", "P1686"), ("P1411", "P585"), ("P1411", "P805")]


@query(
    "qualifier_presence",
    """SELECT s.ID_PROPERTY, w.q AS ID_QUALIFIER_PROPERTY, count(*) AS STATEMENTS, count(*) FILTER (EXISTS (SELECT 1 FROM kg_qualifier k WHERE k.ID_STATEMENT=s.ID_STATEMENT AND k.ID_QUALIFIER_PROPERTY=w.q)) AS WITH_QUALIFIER,
       round(100.0::DOUBLE*count(*) FILTER (EXISTS (SELECT 1 FROM kg_qualifier k WHERE k.ID_STATEMENT=s.ID_STATEMENT AND k.ID_QUALIFIER_PROPERTY=w.q))/count(*),1) AS PCT
       FROM kg_claim s JOIN (VALUES ('P166','P585'),('P166','P1686'),('P1411','P585'),('P1411','P805')) w(p,q) ON w.p=s.ID_PROPERTY GROUP BY 1,2""",
)
def qualifier_presence(d):
    return rp.qualifier_presence(d.kg_claim, d.kg_qualifier, PRESENCE)


@query(
    "qualifier_only_items",
    """SELECT count(*) AS QUALIFIER_ONLY, count(*) FILTER (i NOT IN (SELECT ID_WIKIDATA FROM kg_entity WHERE ENTITY_CLASS<>'SERIE')) AS IN_NO_TABLE FROM (SELECT DISTINCT ID_ITEM AS i FROM kg_qualifier WHERE ID_ITEM IS NOT NULL)
       WHERE i NOT IN (SELECT ID_ITEM FROM kg_claim WHERE ID_ITEM IS NOT NULL)""",
)
def qualifier_only_items(d):
    return rp.qualifier_only_items(d.kg_qualifier, d.kg_claim, d.kg_entity.filter(c("ENTITY_CLASS") != "SERIE"))


@query("locate", "SELECT ID_WIKIDATA, ENTITY_CLASS, LABEL_EN FROM kg_entity WHERE ID_WIKIDATA='Q5000000007'")
def locate(d):
    return rp.locate(d.kg_entity, "Q5000000007")


@query("qualifier_volume", "SELECT ID_QUALIFIER_PROPERTY, count(*) AS N, count(DISTINCT ID_STATEMENT) AS STATEMENTS FROM kg_qualifier GROUP BY 1 ORDER BY N DESC, 1 LIMIT 25")
def qualifier_volume(d):
    return rp.qualifier_volume(d.kg_qualifier)


@query("qualifier_carriers", "SELECT ID_PROPERTY, count(*) AS N FROM kg_claim WHERE ID_STATEMENT IN (SELECT ID_STATEMENT FROM kg_qualifier WHERE ID_QUALIFIER_PROPERTY='P1686') GROUP BY 1 ORDER BY N DESC, 1 LIMIT 25")
def qualifier_carriers(d):
    return rp.qualifier_carriers(d.kg_claim, d.kg_qualifier, "P1686")


@query(
    "witness",
    """SELECT s.ID_PROPERTY, s.VALUE_TEXT, q.ID_QUALIFIER_PROPERTY, q.VALUE_TEXT AS QUALIFIER_VALUE FROM kg_claim s LEFT JOIN kg_qualifier q ON q.ID_STATEMENT=s.ID_STATEMENT WHERE s.ID_WIKIDATA='Q6000000007'""",
)
def witness(d):
    return rp.witness(d.kg_claim, d.kg_qualifier, "Q6000000007")


@query("property_profile", "SELECT ID_PROPERTY, count(*) AS STATEMENTS, count(DISTINCT ID_WIKIDATA) AS SUBJECTS, ID_PROPERTY IN ('P166','P31') AS ALLOWED FROM kg_claim GROUP BY 1 ORDER BY STATEMENTS DESC, 1 LIMIT 25")
def property_profile(d):
    return rp.property_profile(d.kg_claim, ["P166", "P31"])


@query(
    "type_landing",
    """SELECT VALUE_TYPE, count(*) AS STATEMENTS, count(*) FILTER (VALUE_TYPE='item') AS IN_ITEM, count(*) FILTER (VALUE_TYPE='time') AS IN_TIME, count(*) FILTER (VALUE_TYPE='quantity') AS IN_QUANTITY, count(*) FILTER (l_orderkey%7=0) AS IN_STRING FROM kg_claim GROUP BY 1""",
)
def type_landing(d):
    from kgspark.catalog.constraints import typed_children

    return rp.type_landing(d.kg_claim, typed_children(d), ["item", "time", "quantity", "string"])


@query("freshness", "SELECT count(*) AS \"ROWS\", count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS SINCE, strftime(max(ts),'%Y-%m-%d %H:%M:%S') AS LAST_WRITE FROM events")
def freshness(d):
    return rp.freshness(d.events, "ts", F.lit("2024-01-20").cast("timestamp"))


@query("class_membership", "SELECT CLASS_ID, count(*) AS MEMBERS, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_entity WHERE ENTITY_CLASS='ITEM')) AS IN_TABLE FROM (SELECT DISTINCT ID_WIKIDATA, CLASS_ID FROM kg_class) GROUP BY 1")
def class_membership(d):
    return rp.class_membership(d.kg_fact, d.kg_entity, "ITEM")


@query(
    "occupation_probe",
    f"""SELECT count(*) AS MISSING, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_fact WHERE ID_PROPERTY='P21')) AS WITH_PROPERTY, count(*) FILTER (ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM kg_fact WHERE ID_PROPERTY='P21')) AS WITHOUT FROM (SELECT DISTINCT ID_WIKIDATA FROM {MISSING})""",
)
def occupation_probe(d):
    return rp.occupation_probe(rp.missing(d.v1_entity, d.v2_entity), d.kg_fact, "P21")


@query("top_occupations", f"SELECT ID_ITEM, count(DISTINCT ID_WIKIDATA) AS N FROM kg_fact WHERE ID_PROPERTY='P21' AND ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM {MISSING}) GROUP BY 1 ORDER BY N DESC, 1 LIMIT 20")
def top_occupations(d):
    return rp.top_values(rp.missing(d.v1_entity, d.v2_entity), d.kg_fact, "P21")


@query(
    "batch_progress",
    """SELECT 'staging '||CASE WHEN VALUE_TYPE='item' THEN 'LOADED' ELSE 'NEW' END AS STEP, count(*) AS N FROM kg_statement WHERE IMPORT_BATCH_ID='batch_1997' GROUP BY 1 UNION ALL SELECT 'target '||VALUE_TYPE, count(*) FROM kg_statement WHERE IMPORT_BATCH_ID='batch_1997' GROUP BY 1""",
)
def batch_progress(d):
    staged = d.kg_statement.withColumn("ROW_STATUS", F.when(c("VALUE_TYPE") == "item", "LOADED").otherwise("NEW"))
    return rp.batch_progress(staged, d.kg_statement, "batch_1997")


@query(
    "batch_inventory",
    """SELECT 'statement' AS TABLE_NAME, IMPORT_BATCH_ID, count(*) AS N FROM kg_statement GROUP BY 2 UNION ALL SELECT 'entity', 'batch_'||year(o_orderdate), count(*) FROM orders GROUP BY 2""",
)
def batch_inventory(d):
    entities = d.orders.select(F.concat(F.lit("batch_"), F.year("o_orderdate").cast("string")).alias("IMPORT_BATCH_ID"))
    return rp.batch_inventory({"statement": d.kg_statement, "entity": entities})


@query(
    "award_rows_by_class",
    """SELECT CLASS_ID, count(*) AS AWARD_ROWS, count(DISTINCT s.ID_ITEM) AS AWARDS FROM kg_claim s JOIN (SELECT DISTINCT ID_WIKIDATA, CLASS_ID FROM kg_class) k ON k.ID_WIKIDATA=s.ID_ITEM WHERE s.ID_PROPERTY='P166' GROUP BY 1""",
)
def award_rows_by_class(d):
    return rp.award_rows_by_class(d.kg_claim, d.kg_fact, "P166")


@query("run_status", "SELECT event_type||'.'||user_id AS NAME, count(*) AS N FROM events WHERE event_type LIKE 'p%' GROUP BY 1")
def run_status(d):
    ledger = d.events.select(F.concat_ws(".", "event_type", "user_id").alias("NAME"))
    return rp.run_status(ledger, "p").groupBy("NAME").agg(F.count(F.lit(1)).alias("N"))


@query(
    "differences_sample",
    """SELECT a.ID_WIKIDATA, a.ENTITY_CLASS AS V1_VALUE, b.ENTITY_CLASS AS V2_VALUE FROM v1_entity a JOIN v2_entity b ON a.ID_WIKIDATA=b.ID_WIKIDATA WHERE a.ENTITY_CLASS<>b.ENTITY_CLASS ORDER BY 1 LIMIT 50""",
)
def differences_sample(d):
    return rp.differences_sample(d.v1_entity, d.v2_entity, "ENTITY_CLASS", 50)


@query("lost_sample", f"SELECT ID_WIKIDATA, LABEL_EN FROM {MISSING} ORDER BY ID_WIKIDATA LIMIT 50")
def lost_sample(d):
    return rp.missing(d.v1_entity, d.v2_entity).select(ID, "LABEL_EN").orderBy(ID).limit(50)


@query(
    "probe_coverage",
    """SELECT count(*) AS V1_SUBJECTS, count(*) FILTER (s IN (SELECT ID_WIKIDATA FROM v2_entity)) AS PRESENT, count(*) FILTER (s IN (SELECT ID_WIKIDATA FROM v2_triple WHERE ID_PROPERTY='P166')) AS CARRYING, count(*) FILTER (s NOT IN (SELECT ID_WIKIDATA FROM v2_entity)) AS ABSENT
       FROM (SELECT DISTINCT ID_WIKIDATA AS s FROM v1_triple WHERE ID_PROPERTY='P166')""",
)
def probe_coverage(d):
    return rp.probe_coverage(d.v1_triple, d.v2_triple, d.v2_entity, "P166")


@query(
    "missing_root_kind",
    f"""WITH RECURSIVE below AS (SELECT 'Q1000000001' AS QID UNION SELECT e.ID_CHILD FROM kg_subclass e JOIN below b ON e.ID_PARENT=b.QID)
        SELECT CASE r WHEN 0 THEN 'bare root' WHEN 1 THEN 'subclass' ELSE 'outside' END AS CLASS_KIND, count(*) AS N FROM (SELECT ID_CHILD, min(CASE WHEN ID_PARENT IN ('Q3000000001','Q3000000002') THEN 0 WHEN ID_PARENT IN (SELECT QID FROM below) THEN 1 ELSE 2 END) AS r
        FROM kg_subclass WHERE ID_CHILD IN (SELECT ID_WIKIDATA FROM {MISSING}) GROUP BY 1) GROUP BY 1""",
)
def missing_root_kind(d):
    from kgspark.catalog.graph import root
    from kgspark.operators.scope import closure

    members = d.kg_subclass.select(c("ID_CHILD").alias(ID), c("ID_PARENT").alias("CLASS_ID"))
    pool = closure(d.kg_subclass, root(d, "Q1000000001"))
    return rp.missing_root_kind(rp.missing(d.v1_entity, d.v2_entity), members, ["Q3000000001", "Q3000000002"], pool)
