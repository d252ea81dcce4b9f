"""Class graph: closure, classification, scope."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.operators import scope

CLOSURE_SQL = """WITH RECURSIVE below AS (SELECT 'Q1000000001' AS QID UNION SELECT e.ID_CHILD FROM kg_subclass e JOIN below b ON e.ID_PARENT=b.QID)"""
POOLS_SQL = """WITH RECURSIVE pools AS (SELECT * FROM (VALUES ('person','Q1000000000'),('movie','Q1000000001'),('series','Q2000000002'),('season','Q2000000003')) t(ROOT_TYPE,QID)
    UNION SELECT p.ROOT_TYPE, e.ID_CHILD FROM kg_subclass e JOIN pools p ON e.ID_PARENT=p.QID)"""
ROOTS = {"person": ("Q1000000000",), "movie": ("Q1000000001",), "series": ("Q2000000002",), "season": ("Q2000000003",)}


def root(d, *ids):
    return d.spark.createDataFrame([(i,) for i in ids], "QID string")


def pools(d):
    return scope.closure_multi(d.kg_subclass, scope.root_frame(d.spark, ROOTS))


@query(
    "subclass_edges",
    """SELECT DISTINCT 'Q'||(6000000000+l_orderkey) AS ID_CHILD, 'Q'||(5000000000+l_partkey) AS ID_PARENT FROM lineitem WHERE l_returnflag='A'""",
)
def subclass_edges(d):
    from kgspark.catalog.claims import parsed

    # The award and nomination claims stand in for P279 here.
    entities = parsed(d)
    claim_map = F.create_map(F.lit("P279"), F.coalesce(F.try_element_at("claims", F.lit("P166")), F.try_element_at("claims", F.lit("P1411"))))
    return scope.subclass_edges(entities.withColumn("claims", claim_map))


@query("closure", f"{CLOSURE_SQL} SELECT QID FROM below")
def closure(d):
    return scope.closure(d.kg_subclass, root(d, "Q1000000001"))


@query("closure_multi", f"{POOLS_SQL} SELECT ROOT_TYPE, QID FROM pools")
def closure_multi(d):
    return pools(d)


@query(
    "closure_size_check",
    f"{CLOSURE_SQL} SELECT count(*) AS CLASSES, 167 AS FLOOR, 842 AS REFERENCE, CASE WHEN count(*)<167 THEN 'ALERT' ELSE 'ok' END AS VERDICT, count(*)-842 AS DRIFT FROM below",
)
def closure_size_check(d):
    return scope.closure_size_check(scope.closure(d.kg_subclass, root(d, "Q1000000001")), 167, 842)


@query(
    "classify_entities",
    f"""{POOLS_SQL} SELECT ID_WIKIDATA, CASE min(CASE ROOT_TYPE WHEN 'person' THEN 0 WHEN 'movie' THEN 1 WHEN 'series' THEN 2 ELSE 3 END) WHEN 0 THEN 'person' WHEN 1 THEN 'movie' WHEN 2 THEN 'series' ELSE 'season' END AS ENTITY_CLASS
        FROM (SELECT ID_CHILD AS ID_WIKIDATA, ID_PARENT AS CLASS_ID FROM kg_subclass) m JOIN pools ON QID=CLASS_ID GROUP BY 1""",
)
def classify_entities(d):
    m = d.kg_subclass.select(F.col("ID_CHILD").alias("ID_WIKIDATA"), F.col("ID_PARENT").alias("CLASS_ID"))
    return scope.classify(m, pools(d))


@query(
    "referenced_items",
    """SELECT DISTINCT ID_ITEM FROM (SELECT ID_ITEM FROM kg_claim UNION ALL SELECT ID_ITEM FROM kg_qualifier) WHERE ID_ITEM IS NOT NULL""",
)
def referenced_items(d):
    return scope.referenced_items(d.kg_claim, d.kg_qualifier)


@query(
    "referenced_persons",
    """SELECT DISTINCT ID_ITEM FROM kg_claim WHERE ID_ITEM IN (SELECT 'Q'||(5000000000+p_partkey) FROM part WHERE p_size > 25)""",
)
def referenced_persons(d):
    from kgspark.sources.driver import PART, qid

    return scope.referenced_persons(d.kg_claim, d.part.filter(F.col("p_size") > 25).select(qid(PART, "p_partkey")))


@query(
    "core_and_candidates",
    """SELECT CASE WHEN c_mktsegment='BUILDING' THEN 'person' ELSE 'movie' END AS ENTITY_CLASS, count(*) FILTER (c_mktsegment<>'BUILDING' OR c_acctbal>0) AS CORE,
         count(*) FILTER (c_mktsegment='BUILDING') AS CANDIDATES FROM customer GROUP BY 1""",
)
def core_and_candidates(d):
    person = F.col("c_mktsegment") == "BUILDING"
    rows = d.customer.select(
        F.col("c_custkey").alias("ID_WIKIDATA"),
        F.when(person, "person").otherwise("movie").alias("ENTITY_CLASS"),
        (person & (F.col("c_acctbal") > 0)).alias("HAS_IMDB"),
    )
    core, candidates = scope.core_and_candidates(rows)
    tagged = core.select("ENTITY_CLASS", F.lit(1).alias("c")).union(candidates.select(F.lit("person"), F.lit(0)))
    return tagged.groupBy("ENTITY_CLASS").agg(F.count_if(F.col("c") == 1).alias("CORE"), F.count_if(F.col("c") == 0).alias("CANDIDATES"))


@query(
    "item_cache_rows",
    """SELECT ID_WIKIDATA, CASE WHEN ID_WIKIDATA IN (SELECT 'Q'||(5000000000+p_partkey) FROM part WHERE p_size > 25) THEN 'PERSON' ELSE 'ITEM' END AS TARGET_TABLE
       FROM kg_entity WHERE ID_WIKIDATA IN (SELECT ID_ITEM FROM kg_claim) AND ID_WIKIDATA NOT IN (SELECT 'Q'||(5000000000+p_partkey) FROM part WHERE p_size < 5)""",
)
def item_cache_rows(d):
    from kgspark.sources.driver import PART, qid

    part = d.part.select(qid(PART, "p_partkey").alias("ID_WIKIDATA"), "p_size")
    used = d.kg_claim.filter(F.col("ID_ITEM").isNotNull()).select("ID_ITEM").distinct()
    persons = part.filter(F.col("p_size") > 25).select("ID_WIKIDATA").join(used.withColumnRenamed("ID_ITEM", "ID_WIKIDATA"), "ID_WIKIDATA", "left_semi")
    rows = scope.item_cache_rows(d.kg_entity, part.filter(F.col("p_size") < 5), used, persons)
    return rows.select("ID_WIKIDATA", "TARGET_TABLE")


@query(
    "cone_split",
    f"""{CLOSURE_SQL} SELECT count(*) FILTER (i=1) AS IN_CONE, count(*) FILTER (i=0) AS OUT_OF_CONE, (SELECT count(*) FROM below) AS CONE_SIZE, round(100.0::DOUBLE*count(*) FILTER (i=1)/count(*),2) AS PCT_IN
        FROM (SELECT ID_CHILD, max(CASE WHEN ID_PARENT IN (SELECT QID FROM below) THEN 1 ELSE 0 END) AS i FROM kg_subclass GROUP BY 1)""",
)
def cone_split(d):
    rows = d.kg_subclass.select(F.col("ID_CHILD").alias("ID_WIKIDATA"), F.col("ID_PARENT").alias("CLASS_ID"))
    return scope.cone_split(rows, scope.closure(d.kg_subclass, root(d, "Q1000000001")))


@query(
    "cone_diagnosis",
    f"""{CLOSURE_SQL} SELECT ID_PARENT AS CLASS_ID, count(*) AS N, CASE WHEN ID_PARENT IN (SELECT QID FROM below) THEN 'in pool' ELSE 'out of pool' END AS POOL
        FROM kg_subclass WHERE ID_CHILD LIKE 'Q6%' AND ID_CHILD NOT IN (SELECT ID_WIKIDATA FROM kg_claim) GROUP BY 1 ORDER BY N DESC, CLASS_ID LIMIT 25""",
)
def cone_diagnosis(d):
    rows = d.kg_subclass.filter(F.col("ID_CHILD").like("Q6%")).select(F.col("ID_CHILD").alias("ID_WIKIDATA"), F.col("ID_PARENT").alias("CLASS_ID"))
    missing = rows.join(d.kg_claim.select("ID_WIKIDATA").distinct(), "ID_WIKIDATA", "left_anti")
    return scope.cone_diagnosis(missing, scope.closure(d.kg_subclass, root(d, "Q1000000001")))


@query(
    "closure_drift",
    """WITH RECURSIVE a AS (SELECT 'Q1000000001' AS QID UNION SELECT ID_CHILD FROM kg_subclass JOIN a ON ID_PARENT=QID WHERE ID_CHILD NOT LIKE 'Q4%'),
       b AS (SELECT 'Q1000000001' AS QID UNION SELECT ID_CHILD FROM kg_subclass JOIN b ON ID_PARENT=QID WHERE ID_CHILD NOT LIKE 'Q6%')
       SELECT QID, 'lost' AS CHANGE FROM a WHERE QID NOT IN (SELECT QID FROM b) UNION ALL SELECT QID, 'gained' FROM b WHERE QID NOT IN (SELECT QID FROM a)""",
)
def closure_drift(d):
    start = root(d, "Q1000000001")
    before = scope.closure(d.kg_subclass.filter(~F.col("ID_CHILD").like("Q4%")), start)
    after = scope.closure(d.kg_subclass.filter(~F.col("ID_CHILD").like("Q6%")), start)
    return scope.closure_drift(before, after)
