"""Claim flattening, from dump text to typed tables."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.operators import awards, claims
from kgspark.sources import dump


def parsed(d):
    """Dump text of the lineitem table, parsed; its claims carry GUIDs and snak hashes."""
    good, _ = dump.parse_entities(dump.clean_lines(d.dump_lines), ("id", "type", "claims"))
    return good


def flat(d, qualifiers=False):
    return claims.statements(claims.read_claims(dump.clean_lines(d.dump_lines), exact_ids=False, qualifiers=qualifiers))


def values(d, kind):
    """One typed value table; lines that cannot hold such a value are not parsed. Not for items, which almost every line names."""
    lines = dump.clean_lines(claims.naming(d.dump_lines, kind))
    return claims.value_table(claims.statements(claims.read_claims(lines, exact_ids=False, qualifiers=False)), kind)


def wide_qualifiers(d):
    return claims.qualifiers(flat(d, qualifiers=True), exact_ids=False)


@query(
    "award_count_by_family_from_dump",
    """SELECT s.ID_WIKIDATA, e.LABEL_EN AS LABEL, count(*) AS AWARDS FROM kg_claim s JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_WIKIDATA
       WHERE s.ID_PROPERTY='P166' AND s.ID_ITEM IS NOT NULL AND e.LABEL_EN IS NOT NULL AND EXISTS (SELECT 1 FROM kg_class c WHERE c.ID_WIKIDATA=s.ID_ITEM AND c.CLASS_ID='Q7000000002')
       GROUP BY 1,2""",
)
def award_count_by_family_from_dump(d):
    stmts = flat(d).select("ID_WIKIDATA", "ID_PROPERTY", F.col("v.ID_ITEM").alias("ID_ITEM"))
    out = awards.award_count_by_family(stmts, d.kg_fact, d.kg_entity, "Q7000000002", person="MOVIE")
    return out.select("ID_WIKIDATA", "LABEL", "AWARDS")


@query(
    "claims_exploded",
    "SELECT ID_PROPERTY, count(*) AS CLAIMS, count(DISTINCT ID_WIKIDATA) AS SUBJECTS FROM kg_claim GROUP BY 1",
)
def claims_exploded(d):
    return claims.read_claims(dump.clean_lines(d.dump_lines), exact_ids=False, qualifiers=False).groupBy("ID_PROPERTY").agg(
        F.count(F.lit(1)).alias("CLAIMS"), F.count_distinct("ID_WIKIDATA").alias("SUBJECTS")
    )


@query(
    "claims_of_one_property",
    "SELECT ID_STATEMENT, ID_WIKIDATA FROM kg_claim WHERE ID_PROPERTY='P166'",
)
def claims_of_one_property(d):
    return claims.explode_claims(parsed(d), ["P166"], exact_ids=False, qualifiers=False).select("ID_STATEMENT", "ID_WIKIDATA")


@query(
    "statements_flat",
    "SELECT ID_STATEMENT, ID_WIKIDATA, ID_PROPERTY, STATEMENT_GUID, VALUE_TYPE, 'normal' AS \"RANK\" FROM kg_claim",
)
def statements_flat(d):
    return flat(d).select("ID_STATEMENT", "ID_WIKIDATA", "ID_PROPERTY", "STATEMENT_GUID", "VALUE_TYPE", "RANK")


@query("item_values", "SELECT ID_STATEMENT, ID_ITEM FROM kg_claim WHERE VALUE_TYPE='item'")
def item_values(d):
    return claims.value_table(flat(d), "item")


@query(
    "time_values",
    """SELECT ID_STATEMENT, RAW_TIME_VALUE, 11 AS TIME_PRECISION, 0 AS TIMEZONE_OFFSET, YEAR_VALUE, substr(RAW_TIME_VALUE,7,2)::INT AS MONTH_VALUE, substr(RAW_TIME_VALUE,10,2)::INT AS DAY_VALUE
       FROM kg_claim WHERE VALUE_TYPE='time'""",
)
def time_values(d):
    return values(d, "time").select(
        "ID_STATEMENT", "RAW_TIME_VALUE", "TIME_PRECISION", "TIMEZONE_OFFSET", "YEAR_VALUE", "MONTH_VALUE", "DAY_VALUE"
    )


@query(
    "quantity_values",
    """SELECT ID_STATEMENT, AMOUNT::DECIMAL(30,10) AS AMOUNT FROM kg_claim WHERE VALUE_TYPE='quantity'""",
)
def quantity_values(d):
    return values(d, "quantity").select("ID_STATEMENT", "AMOUNT")


@query(
    "quantity_units",
    """SELECT 'Q'||(4000000000+l_suppkey) AS UNIT_ID_WIKIDATA, count(*) AS N, sum(l_extendedprice::DECIMAL(15,2))::DECIMAL(38,2) AS TOTAL FROM lineitem WHERE l_returnflag='R' GROUP BY 1""",
)
def quantity_units(d):
    q = values(d, "quantity")
    return q.groupBy("UNIT_ID_WIKIDATA").agg(F.count(F.lit(1)).alias("N"), F.sum("AMOUNT").cast("decimal(38,2)").alias("TOTAL"))


@query(
    "time_value_parts",
    r"""SELECT event_id, t AS RAW, CASE WHEN event_type='signup' THEN NULL WHEN event_type='error' THEN NULL WHEN event_type='view' THEN -(100+user_id) ELSE year(ts) END AS Y,
          CASE WHEN event_type='signup' THEN month(ts) WHEN event_type='error' THEN NULL WHEN event_type='click' THEN 0 ELSE month(ts) END AS M,
          CASE WHEN event_type='signup' THEN day(ts) WHEN event_type='error' THEN NULL WHEN event_type='click' THEN 0 WHEN event_type='purchase' THEN NULL ELSE day(ts) END AS D
        FROM (SELECT *, CASE event_type WHEN 'view' THEN '-'||(100+user_id)||strftime(ts,'-%m-%dT00:00:00Z') WHEN 'click' THEN strftime(ts,'+%Y-00-00T00:00:00Z')
          WHEN 'signup' THEN strftime(ts,'+99999999999999999999-%m-%dT00:00:00Z') WHEN 'purchase' THEN strftime(ts,'%Y-%mT') ELSE strftime(ts,'x%Y-%m-%d') END AS t FROM events)""",
)
def time_value_parts(d):
    kind = F.col("event_type")
    f = F.date_format
    year = (F.col("user_id") + 100).cast("string")
    raw = (
        F.when(kind == "view", F.concat(F.lit("-"), year, f("ts", "-MM-dd'T00:00:00Z'")))
        .when(kind == "click", f("ts", "+yyyy'-00-00T00:00:00Z'"))
        .when(kind == "signup", f("ts", "'+99999999999999999999'-MM-dd'T00:00:00Z'"))
        .when(kind == "purchase", f("ts", "yyyy-MM'T'"))
        .otherwise(f("ts", "'x'yyyy-MM-dd"))
    )
    y, m, dd = claims.date_parts(raw)
    return d.events.select("event_id", raw.alias("RAW"), y.alias("Y"), m.alias("M"), dd.alias("D"))


@query(
    "qualifiers_flat",
    "SELECT ID_STATEMENT_QUALIFIER, ID_STATEMENT, ID_QUALIFIER_PROPERTY, QUALIFIER_HASH, VALUE_TYPE, DISPLAY_ORDER FROM kg_qualifier",
)
def qualifiers_flat(d):
    return wide_qualifiers(d).select(
        "ID_STATEMENT_QUALIFIER", "ID_STATEMENT", "ID_QUALIFIER_PROPERTY", "QUALIFIER_HASH", "VALUE_TYPE", "DISPLAY_ORDER"
    )


@query(
    "qualifier_values_by_type",
    """SELECT ID_QUALIFIER_PROPERTY, VALUE_TYPE, count(*) AS N, count(DISTINCT VALUE_TEXT) AS DISTINCT_VALUES, min(VALUE_TEXT) AS SMALLEST, sum(YEAR_VALUE)::BIGINT AS YEARS FROM kg_qualifier GROUP BY 1,2""",
)
def qualifier_values_by_type(d):
    q = wide_qualifiers(d).select("ID_QUALIFIER_PROPERTY", "VALUE_TYPE", "v.*")
    text = F.coalesce("ID_ITEM", "TEXT", F.col("TIME.RAW_TIME_VALUE"))
    return q.groupBy("ID_QUALIFIER_PROPERTY", "VALUE_TYPE").agg(
        F.count(F.lit(1)).alias("N"),
        F.count_distinct(text).alias("DISTINCT_VALUES"),
        F.min(text).alias("SMALLEST"),
        F.sum("TIME.YEAR_VALUE").alias("YEARS"),
    )


@query(
    "statement_values_display",
    """SELECT ID_STATEMENT, VALUE_TEXT, VALUE_TYPE AS VALUE_TABLE, "RANK" FROM kg_statement WHERE DELETED=0 AND "RANK"<>'deprecated'""",
)
def statement_values_display(d):
    tables = {
        "item": d.kg_claim.filter(F.col("VALUE_TYPE") == "item").select("ID_STATEMENT", "ID_ITEM"),
        "time": d.kg_claim.filter(F.col("VALUE_TYPE") == "time").select("ID_STATEMENT", "RAW_TIME_VALUE"),
        "quantity": d.kg_claim.filter(F.col("VALUE_TYPE") == "quantity").select("ID_STATEMENT", "AMOUNT"),
    }
    parents = d.kg_statement.select("ID_STATEMENT", "RANK", "DELETED")
    return claims.statement_values(parents, tables).select("ID_STATEMENT", "VALUE_TEXT", "VALUE_TABLE", "RANK")


@query(
    "qualifiers_grouped",
    """SELECT ID_STATEMENT, ID_QUALIFIER_PROPERTY, (DISPLAY_ORDER-1)//500 AS PAGE, string_agg(VALUE_TEXT, '|' ORDER BY DISPLAY_ORDER) AS VALUE_LIST FROM kg_qualifier GROUP BY 1,2,3""",
)
def qualifiers_grouped(d):
    pages = claims.qualifiers_grouped(d.kg_qualifier)
    return pages.withColumn("VALUE_LIST", F.array_join("VALUES", "|")).drop("VALUES")
