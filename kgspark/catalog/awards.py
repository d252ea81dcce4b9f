"""Award questions."""

from pyspark.sql import functions as F

from kgspark.catalog.registry import query
from kgspark.operators import awards

c = F.col
FAMILY = "Q7000000003"

LABELS = """
  LEFT JOIN kg_entity i ON i.ID_WIKIDATA=s.ID_ITEM AND i.ENTITY_CLASS='ITEM'
  LEFT JOIN kg_qualifier d ON d.ID_STATEMENT=s.ID_STATEMENT AND d.ID_QUALIFIER_PROPERTY='P585'"""
WORK = """
  LEFT JOIN kg_qualifier w ON w.ID_STATEMENT=s.ID_STATEMENT AND w.ID_QUALIFIER_PROPERTY='P1686' LEFT JOIN kg_entity we ON we.ID_WIKIDATA=w.ID_ITEM AND we.ENTITY_CLASS='SERIE'"""
WON = "s.ID_PROPERTY='P166' AND s.ID_ITEM IS NOT NULL"
IN_FAMILY = f"EXISTS (SELECT 1 FROM kg_fact f WHERE f.ID_WIKIDATA=s.ID_ITEM AND f.ID_PROPERTY='P31' AND f.ID_ITEM='{FAMILY}')"
SUBJECT = "Q6000004224"

# A table for each qualifier property and each kind of label; statements meet them by their GUID.
SIDES = """
  won AS MATERIALIZED (SELECT STATEMENT_GUID, l_linestatus, 'Q'||(6000000000+l_orderkey) AS ID_WIKIDATA, 'Q'||(5000000000+l_partkey) AS ID_ITEM FROM kg_line WHERE l_returnflag='A'),
  years AS MATERIALIZED (SELECT STATEMENT_GUID, YEAR_VALUE AS "YEAR" FROM kg_qual0 WHERE ID_QUALIFIER_PROPERTY='P585'),
  works AS MATERIALIZED (SELECT STATEMENT_GUID, ID_ITEM AS WORK_ID FROM kg_qual0 WHERE ID_QUALIFIER_PROPERTY='P1686'),
  shows AS MATERIALIZED (SELECT STATEMENT_GUID, ID_ITEM AS SHOW_ID FROM kg_qual0 WHERE ID_QUALIFIER_PROPERTY='P805'),
  item_names AS MATERIALIZED (SELECT 'Q'||(5000000000+p_partkey) AS ID_ITEM, p_name AS ITEM_NAME FROM part),
  show_names AS MATERIALIZED (SELECT 'Q'||(5000000000+p_partkey) AS SHOW_ID, p_name AS SHOW_NAME FROM part),
  work_names AS MATERIALIZED (SELECT 'Q'||(4000000000+s_suppkey) AS WORK_ID, s_name AS WORK_NAME FROM supplier)"""
ALL_SIDES = "LEFT JOIN years USING (STATEMENT_GUID) LEFT JOIN works USING (STATEMENT_GUID) LEFT JOIN item_names USING (ID_ITEM) LEFT JOIN work_names USING (WORK_ID)"
AWARDS = f"FROM (SELECT * FROM won WHERE l_linestatus='O') {ALL_SIDES} LEFT JOIN shows USING (STATEMENT_GUID) LEFT JOIN show_names USING (SHOW_ID)"


@query(
    "awards_all",
    f"""WITH {SIDES} SELECT ID_WIKIDATA, coalesce(ITEM_NAME, ID_ITEM) AS AWARD, "YEAR", coalesce(WORK_NAME, WORK_ID) AS FOR_WORK, coalesce(SHOW_NAME, SHOW_ID) AS CEREMONY {AWARDS}""",
)
def awards_all(d):
    return awards.awards_all(d.kg_claim, d.kg_qualifier, d.kg_entity, work="SERIE")


@query(
    "awards_of_subject",
    f"""WITH {SIDES} SELECT coalesce(ITEM_NAME, ID_ITEM) AS AWARD, "YEAR", coalesce(WORK_NAME, WORK_ID) AS FOR_WORK, coalesce(SHOW_NAME, SHOW_ID) AS CEREMONY {AWARDS} WHERE ID_WIKIDATA='{SUBJECT}'""",
)
def awards_of_subject(d):
    return awards.awards_of(d.kg_claim, d.kg_qualifier, d.kg_entity, SUBJECT, work="SERIE")


@query(
    "award_count_by_family",
    f"""SELECT s.ID_WIKIDATA, count(*) AS AWARDS, e.LABEL_EN AS LABEL FROM kg_claim s JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_WIKIDATA AND e.LABEL_EN IS NOT NULL WHERE {WON} AND {IN_FAMILY} GROUP BY 1,3""",
)
def award_count_by_family(d):
    return awards.award_count_by_family(d.kg_claim, d.kg_fact, d.kg_entity, FAMILY, person="MOVIE")


@query(
    "award_detail_by_family",
    f"""SELECT s.ID_WIKIDATA, e.LABEL_EN AS LABEL, coalesce(i.LABEL_EN, s.ID_ITEM) AS CATEGORY, d.YEAR_VALUE AS YEAR FROM kg_claim s JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_WIKIDATA AND e.LABEL_EN IS NOT NULL {LABELS} WHERE {WON} AND {IN_FAMILY}""",
)
def award_detail_by_family(d):
    return awards.award_detail_by_family(d.kg_claim, d.kg_qualifier, d.kg_fact, d.kg_entity, FAMILY, person="MOVIE")


@query(
    "award_count_by_label",
    f"""SELECT s.ID_WIKIDATA, count(*) AS AWARDS, e.LABEL_EN AS LABEL FROM kg_claim s JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_WIKIDATA AND e.LABEL_EN IS NOT NULL JOIN kg_entity i ON i.ID_WIKIDATA=s.ID_ITEM WHERE {WON} AND i.LABEL_EN LIKE 'red%' GROUP BY 1,3""",
)
def award_count_by_label(d):
    return awards.award_count_by_label(d.kg_claim, d.kg_entity, "red", person="MOVIE")


@query(
    "silent_category_probe",
    """WITH z AS (SELECT ID_WIKIDATA, count(*) AS n FROM kg_fact GROUP BY 1) SELECT 'Q'||(5000000000+p_partkey) AS CATEGORY, 'Q'||(5000000000+p_partkey//2) AS PARENT, p_name AS LABEL, coalesce(a.n,0) AS STATEMENTS, coalesce(b.n,0) AS PARENT_STATEMENTS
       FROM part LEFT JOIN z a ON a.ID_WIKIDATA='Q'||(5000000000+p_partkey) LEFT JOIN z b ON b.ID_WIKIDATA='Q'||(5000000000+p_partkey//2)""",
)
def silent_category_probe(d):
    from kgspark.sources.driver import PART, qid

    categories = d.part.select(qid(PART, "p_partkey").alias("CATEGORY"), "p_partkey")
    parent = qid(PART, F.floor(c("p_partkey") / 2))
    return awards.silent_category_probe(d.kg_fact, d.kg_entity, categories, parent)


@query(
    "multi_winners",
    f"""SELECT s.ID_WIKIDATA, count(*) AS AWARDS, e.LABEL_EN AS LABEL FROM kg_claim s LEFT JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_WIKIDATA WHERE {WON} AND {IN_FAMILY}
        AND EXISTS (SELECT 1 FROM kg_fact g WHERE g.ID_WIKIDATA=s.ID_WIKIDATA AND g.ID_PROPERTY='P21' AND g.ID_ITEM='Q9000000001') GROUP BY 1,3 HAVING count(*)>=2 ORDER BY AWARDS DESC, s.ID_WIKIDATA LIMIT 40""",
)
def multi_winners(d):
    return awards.multi_winners(d.kg_claim, d.kg_fact, d.kg_entity, FAMILY, "Q9000000001", person="MOVIE")


@query(
    "laureates",
    """SELECT s.ID_STATEMENT, d.YEAR_VALUE AS YEAR, coalesce(e.LABEL_EN, s.ID_WIKIDATA) AS LAUREATE FROM kg_claim s LEFT JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_WIKIDATA LEFT JOIN kg_qualifier d ON d.ID_STATEMENT=s.ID_STATEMENT AND d.ID_QUALIFIER_PROPERTY='P585'
       WHERE s.ID_PROPERTY='P166' AND s.ID_ITEM='Q5000000007' ORDER BY YEAR DESC NULLS LAST, s.ID_STATEMENT LIMIT 40""",
)
def laureates(d):
    return awards.laureates(d.kg_claim, d.kg_qualifier, d.kg_entity, "Q5000000007")


@query(
    "awards_around_work",
    f"""WITH {SIDES}, around AS MATERIALIZED (
          SELECT 'received by the work' AS SENSE, STATEMENT_GUID, ID_ITEM, NULL AS LAUREATE FROM won WHERE l_linestatus='O' AND ID_WIKIDATA='Q4000000003'
          UNION ALL SELECT 'received for the work', STATEMENT_GUID, ID_ITEM, ID_WIKIDATA FROM (SELECT * FROM works WHERE WORK_ID='Q4000000003') JOIN (SELECT * FROM won WHERE l_linestatus='O') USING (STATEMENT_GUID))
        SELECT SENSE, coalesce(ITEM_NAME, ID_ITEM) AS AWARD, "YEAR", LAUREATE FROM around LEFT JOIN years USING (STATEMENT_GUID) LEFT JOIN item_names USING (ID_ITEM)""",
)
def awards_around_work(d):
    return awards.awards_around_work(d.kg_claim, d.kg_qualifier, d.kg_entity, "Q4000000003")


@query(
    "nominated_not_won",
    f"""WITH {SIDES}, lost AS MATERIALIZED (
          SELECT n.* FROM won n LEFT JOIN (SELECT DISTINCT ID_WIKIDATA, ID_ITEM, 1 AS got FROM won WHERE l_linestatus='O') g USING (ID_WIKIDATA, ID_ITEM) WHERE l_linestatus<>'O' AND got IS NULL)
        SELECT ID_WIKIDATA, coalesce(ITEM_NAME, ID_ITEM) AS NOMINATED_FOR, "YEAR", coalesce(WORK_NAME, WORK_ID) AS FOR_WORK FROM lost {ALL_SIDES}""",
)
def nominated_not_won(d):
    return awards.nominated_not_won(d.kg_claim, d.kg_qualifier, d.kg_entity, work="SERIE")


@query(
    "recent_awards",
    f"""SELECT s.ID_STATEMENT, e.LABEL_EN AS LAUREATE, i.LABEL_EN AS AWARD, d.YEAR_VALUE AS YEAR, we.LABEL_EN AS FOR_WORK FROM kg_claim s JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_WIKIDATA AND e.LABEL_EN IS NOT NULL {LABELS} {WORK}
        WHERE {WON} AND d.YEAR_VALUE BETWEEN 1999 AND 2001 AND we.LABEL_EN IS NOT NULL AND i.LABEL_EN IS NOT NULL ORDER BY YEAR DESC, s.ID_STATEMENT LIMIT 100""",
)
def recent_awards(d):
    return awards.recent_awards(d.kg_claim, d.kg_qualifier, d.kg_entity, 1999, 2001, 100, work="SERIE", person="MOVIE")


@query(
    "entity_facts",
    """SELECT s.ID_WIKIDATA, s.ID_PROPERTY, s.VALUE_TYPE, s.VALUE_TEXT, e.LABEL_EN AS TARGET_LABEL, s."RANK" FROM kg_statement s LEFT JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_ITEM WHERE s.DELETED=0 AND s."RANK"<>'deprecated'""",
)
def entity_facts(d):
    return awards.entity_facts(d.kg_statement, d.kg_entity)
