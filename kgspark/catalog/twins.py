"""SQL definitions of the driver views, for the side-by-side check."""

from __future__ import annotations

import re

BIGINT = "(('0x'||substr(sha256({0}),1,16))::UBIGINT & 9223372036854775807::UBIGINT)::BIGINT"


def stable_bigint(sql: str) -> str:
    return BIGINT.format(sql)


VIEWS = {
    "kg_entity": """
        SELECT 'Q'||(1000000000+r_regionkey) AS ID_WIKIDATA, 'CLASS' AS ENTITY_CLASS, r_name AS LABEL_EN, 'Q1' AS CLASS_ID FROM region
        UNION ALL SELECT 'Q'||(2000000000+n_nationkey), 'CLASS', n_name, 'Q2' FROM nation
        UNION ALL SELECT 'Q'||(3000000000+c_custkey), 'PERSON', c_name, 'Q3' FROM customer
        UNION ALL SELECT 'Q'||(4000000000+s_suppkey), 'SERIE', s_name, 'Q4' FROM supplier
        UNION ALL SELECT 'Q'||(5000000000+p_partkey), 'ITEM', p_name, 'Q5' FROM part
        UNION ALL SELECT 'Q'||(6000000000+o_orderkey), 'MOVIE', CASE WHEN o_orderstatus<>'F' THEN 'Order#'||o_orderkey END, 'Q6' FROM orders""",
    "kg_subclass": """
        SELECT 'Q'||(2000000000+n_nationkey) AS ID_CHILD, 'Q'||(1000000000+n_regionkey) AS ID_PARENT FROM nation
        UNION ALL SELECT 'Q'||(3000000000+c_custkey), 'Q'||(2000000000+c_nationkey) FROM customer
        UNION ALL SELECT 'Q'||(4000000000+s_suppkey), 'Q'||(2000000000+s_nationkey) FROM supplier
        UNION ALL SELECT 'Q'||(6000000000+o_orderkey), 'Q'||(3000000000+o_custkey) FROM orders
        UNION ALL SELECT 'Q'||(1000000000+n_regionkey), 'Q'||(2000000000+min(n_nationkey)) FROM nation GROUP BY n_regionkey""",
    "kg_class": """
        SELECT ID_WIKIDATA, CLASS_ID FROM kg_entity WHERE ENTITY_CLASS<>'ITEM'
        UNION ALL SELECT 'Q'||(5000000000+p_partkey), 'Q'||(7000000000+list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type)) FROM part
        UNION ALL SELECT 'Q'||(5000000000+p_partkey), 'Q'||(8000000000+substr(p_brand,7)::BIGINT) FROM part""",
    "kg_fact": """
        SELECT ID_WIKIDATA, 'P31' AS ID_PROPERTY, CLASS_ID AS ID_ITEM FROM kg_class
        UNION ALL SELECT 'Q'||(6000000000+o_orderkey), 'P21', 'Q'||(9000000000+substr(o_orderpriority,1,1)::BIGINT) FROM orders""",
    "kg_line": """
        SELECT *, concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate,'%Y%m%d'), CAST(round(l_extendedprice*100) AS BIGINT)) AS STATEMENT_GUID
        FROM lineitem""",
    "kg_claim": f"""
        SELECT {stable_bigint("'statement|'||STATEMENT_GUID")} AS ID_STATEMENT,
          'Q'||(6000000000+l_orderkey) AS ID_WIKIDATA,
          CASE WHEN l_linestatus='O' THEN 'P166' ELSE 'P1411' END AS ID_PROPERTY,
          STATEMENT_GUID,
          CASE l_returnflag WHEN 'A' THEN 'item' WHEN 'N' THEN 'time' ELSE 'quantity' END AS VALUE_TYPE,
          CASE WHEN l_returnflag='A' THEN 'Q'||(5000000000+l_partkey) END AS ID_ITEM,
          CASE WHEN l_returnflag='N' THEN strftime(l_shipdate,'+%Y-%m-%dT00:00:00Z') END AS RAW_TIME_VALUE,
          CASE WHEN l_returnflag='N' THEN year(l_shipdate) END AS YEAR_VALUE,
          CASE WHEN l_returnflag NOT IN ('A','N') THEN l_extendedprice::DECIMAL(15,2) END AS AMOUNT,
          CASE l_returnflag WHEN 'A' THEN 'Q'||(5000000000+l_partkey) WHEN 'N' THEN strftime(l_shipdate,'+%Y-%m-%dT00:00:00Z')
            ELSE l_extendedprice::DECIMAL(15,2)::VARCHAR END AS VALUE_TEXT,
          CASE WHEN l_tax > 0.075 THEN 1 ELSE 0 END AS DELETED, l_orderkey, l_quantity
        FROM kg_line""",
    "kg_statement": """
        SELECT s.*, CASE o_orderstatus WHEN 'P' THEN 'preferred' WHEN 'O' THEN 'normal' ELSE 'deprecated' END AS "RANK",
          'batch_'||year(o_orderdate) AS IMPORT_BATCH_ID
        FROM kg_claim s JOIN orders ON o_orderkey = l_orderkey""",
    "kg_qual0": """
        SELECT STATEMENT_GUID, 'P585' AS ID_QUALIFIER_PROPERTY, 'time' AS VALUE_TYPE, NULL::VARCHAR AS ID_ITEM, strftime(l_shipdate,'+%Y-%m-%dT00:00:00Z') AS VALUE_TEXT, year(l_shipdate) AS YEAR_VALUE, 1 AS DISPLAY_ORDER FROM kg_line WHERE l_tax >= 0.02
        UNION ALL SELECT STATEMENT_GUID, 'P1686', 'item', 'Q'||(4000000000+l_suppkey), 'Q'||(4000000000+l_suppkey), NULL, 1 FROM kg_line WHERE l_discount >= 0.03
        UNION ALL SELECT STATEMENT_GUID, 'P805', 'item', 'Q'||(5000000000+l_partkey), 'Q'||(5000000000+l_partkey), NULL, 1 FROM kg_line
        UNION ALL SELECT STATEMENT_GUID, 'P1545', 'string', NULL, l_linenumber::VARCHAR, NULL, 1 FROM kg_line
        UNION ALL SELECT STATEMENT_GUID, 'P1545', 'string', NULL, (l_linenumber+1)::VARCHAR, NULL, 2 FROM kg_line WHERE l_quantity::INT % 2 = 0""",
    "kg_qual1": f"""
        SELECT {stable_bigint("'statement|'||STATEMENT_GUID")} AS ID_STATEMENT, * EXCLUDE (STATEMENT_GUID), md5(ID_QUALIFIER_PROPERTY||'|'||VALUE_TEXT) AS SNAK_HASH FROM kg_qual0""",
    "kg_qualifier": f"""
        SELECT *, 'qualifier|'||ID_STATEMENT||'|'||ID_QUALIFIER_PROPERTY||'|'||SNAK_HASH AS QUALIFIER_HASH,
          {stable_bigint("'qualifier|'||ID_STATEMENT||'|'||ID_QUALIFIER_PROPERTY||'|'||SNAK_HASH")} AS ID_STATEMENT_QUALIFIER
        FROM kg_qual1""",
    "v1_entity": """
        SELECT 'Q'||(6000000000+o_orderkey) AS ID_WIKIDATA, 'MOVIE' AS ENTITY_CLASS, 'Order#'||o_orderkey AS LABEL_EN, o_orderpriority AS INSTANCE_OF,
          CASE WHEN o_orderstatus<>'F' THEN 'tt'||o_custkey END AS ID_EXTERNAL, CASE WHEN o_totalprice < 5000 THEN 1 ELSE 0 END AS DELETED
        FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
        UNION ALL SELECT 'Q'||(3000000000+c_custkey), 'PERSON', c_name, c_mktsegment, CASE WHEN c_acctbal > 5000 THEN 'nm'||c_custkey END, 0 FROM customer""",
    "v2_entity": """
        SELECT 'Q'||(6000000000+o_orderkey) AS ID_WIKIDATA, CASE WHEN o_orderstatus='P' THEN 'ITEM' ELSE 'MOVIE' END AS ENTITY_CLASS, 'Order#'||o_orderkey AS LABEL_EN, o_orderpriority AS INSTANCE_OF,
          CASE WHEN o_orderstatus<>'F' THEN 'tt'||o_custkey END AS ID_EXTERNAL, CASE WHEN o_totalprice < 5000 THEN 1 ELSE 0 END AS DELETED
        FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
        UNION ALL SELECT 'Q'||(3000000000+c_custkey), 'PERSON', c_name, c_mktsegment, CASE WHEN c_acctbal > 5000 THEN 'nm'||c_custkey END, 0 FROM customer WHERE c_acctbal > 0""",
    "v1_triple": """
        SELECT 'Q'||(6000000000+l_orderkey) AS ID_WIKIDATA, CASE WHEN l_linestatus='O' THEN 'P166' ELSE 'P1411' END AS ID_PROPERTY, 'Q'||(5000000000+l_partkey) AS ID_ITEM
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')""",
    "v2_triple": """
        SELECT ID_STATEMENT, ID_WIKIDATA, ID_PROPERTY, ID_ITEM FROM kg_statement WHERE VALUE_TYPE='item' AND IMPORT_BATCH_ID >= 'batch_1996'""",
    "media_statement": f"""
        SELECT {stable_bigint("'media|'||doc_id")} AS ID_STATEMENT, 'Q'||(3000000000+doc_id) AS ID_WIKIDATA, 'P18' AS ID_PROPERTY,
          CASE WHEN doc_id%17=0 THEN '  ' WHEN doc_id%19=0 THEN 'plain name '||doc_id
            ELSE ' File '||source||' '||doc_id||'.'||(['jpg','webm','ogg','pdf','PNG','mp4','svg','flac','djvu','tif','mov','opus','gif'])[doc_id%13+1] END AS FILE_NAME,
          NULL::VARCHAR AS VALUE_EXTERNAL_ID,
          CASE WHEN doc_id%11=0 THEN 'deprecated' WHEN doc_id%2=0 THEN 'normal' END AS "RANK", CASE WHEN doc_id%23=0 THEN 1 ELSE 0 END AS DELETED
        FROM documents
        UNION ALL SELECT {stable_bigint("'page|'||page_id")}, 'Q'||(3000000000+page_id), CASE WHEN page_id%2=0 THEN 'P1651' ELSE 'P724' END, NULL,
          list_last(string_split(regexp_replace(url,'[?#].*$',''),'/')), CASE WHEN page_id%7=0 THEN 'deprecated' ELSE 'normal' END, 0
        FROM pages""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the view definitions it uses, dependencies first."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\b(?:kg|v1|v2|media)_[a-z0-9]+\b", text):
            if name in VIEWS and name not in order:
                need(VIEWS[name])
                if name not in order:
                    order.append(name)

    need(sql)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    stripped = sql.strip()
    head = re.match(r"(?is)^WITH\s+(RECURSIVE\s+)?", stripped)
    if head:
        recursive = "RECURSIVE " if head.group(1) else ""
        return f"WITH {recursive}{ctes},\n{stripped[head.end():]}"
    return f"WITH {ctes}\n{stripped}"
