"""Join shapes, ordering and set operations."""

from pyspark.sql import functions as F

from kgspark.functions import n
from kgspark.catalog.registry import query
from kgspark.operators import joins, ranking



def of_class(d, *names):
    return d.kg_entity.filter(F.col("ENTITY_CLASS").isin(*names)).select("ID_WIKIDATA")


@query(
    "join_statement_value",
    """SELECT s.ID_STATEMENT, s.ID_PROPERTY, v.VALUE_TEXT FROM kg_claim s JOIN (SELECT ID_STATEMENT, VALUE_TEXT FROM kg_qualifier WHERE ID_QUALIFIER_PROPERTY='P585') v ON v.ID_STATEMENT=s.ID_STATEMENT""",
)
def join_statement_value(d):
    v = d.kg_qualifier.filter(F.col("ID_QUALIFIER_PROPERTY") == "P585").select("ID_STATEMENT", "VALUE_TEXT")
    return d.kg_claim.select("ID_STATEMENT", "ID_PROPERTY").join(v, "ID_STATEMENT")


@query(
    "label_lookup",
    """SELECT s.ID_WIKIDATA, coalesce(e.LABEL_EN, s.ID_WIKIDATA) AS LABEL, count(*) AS N FROM kg_claim s LEFT JOIN kg_entity e ON e.ID_WIKIDATA=s.ID_WIKIDATA GROUP BY 1,2""",
)
def label_lookup(d):
    counts = d.kg_claim.groupBy("ID_WIKIDATA").agg(n())
    return joins.label_lookup(counts, d.kg_entity.select("ID_WIKIDATA", "LABEL_EN"), "ID_WIKIDATA")


@query(
    "qualifier_pivot",
    """WITH s AS MATERIALIZED (SELECT ID_STATEMENT, STATEMENT_GUID FROM kg_claim WHERE ID_PROPERTY='P166'),
       d AS MATERIALIZED (SELECT STATEMENT_GUID, YEAR_VALUE AS "YEAR" FROM kg_qual0 WHERE ID_QUALIFIER_PROPERTY='P585'),
       w AS MATERIALIZED (SELECT STATEMENT_GUID, ID_ITEM AS WORK FROM kg_qual0 WHERE ID_QUALIFIER_PROPERTY='P1686'),
       o AS MATERIALIZED (SELECT STATEMENT_GUID, VALUE_TEXT AS ORDINAL FROM kg_qual0 WHERE ID_QUALIFIER_PROPERTY='P1545')
       SELECT ID_STATEMENT, "YEAR", WORK, ORDINAL FROM s LEFT JOIN d USING (STATEMENT_GUID) LEFT JOIN w USING (STATEMENT_GUID) LEFT JOIN o USING (STATEMENT_GUID)""",
)
def qualifier_pivot(d):
    from kgspark.operators.awards import qualifier_pivot as pivot

    s = d.kg_claim.filter(F.col("ID_PROPERTY") == "P166").select("ID_STATEMENT")
    return pivot(s, d.kg_qualifier, {"YEAR": ("P585", "YEAR_VALUE"), "WORK": ("P1686", "ID_ITEM"), "ORDINAL": ("P1545", "VALUE_TEXT")})


@query(
    "label_in_several_tables",
    """SELECT t.ID_WIKIDATA, coalesce(m.LABEL_EN, p.LABEL_EN, i.LABEL_EN, t.ID_WIKIDATA) AS LABEL FROM kg_entity t
       LEFT JOIN kg_entity m ON m.ID_WIKIDATA=t.ID_WIKIDATA AND m.ENTITY_CLASS='MOVIE' LEFT JOIN kg_entity p ON p.ID_WIKIDATA=t.ID_WIKIDATA AND p.ENTITY_CLASS='PERSON'
       LEFT JOIN kg_entity i ON i.ID_WIKIDATA=t.ID_WIKIDATA AND i.ENTITY_CLASS='ITEM'""",
)
def label_in_several_tables(d):
    from kgspark.operators.awards import labels_of

    names = labels_of(d.kg_entity, ["MOVIE", "PERSON", "ITEM"], "ID_WIKIDATA", "_l")
    return d.kg_entity.select("ID_WIKIDATA").join(names, "ID_WIKIDATA", "left").select("ID_WIKIDATA", F.coalesce("_l", "ID_WIKIDATA").alias("LABEL"))


@query(
    "semi_join",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey=l_partkey AND p_size<10)""",
)
def semi_join(d):
    small = d.part.filter(F.col("p_size") < 10).select(F.col("p_partkey").alias("l_partkey"))
    return d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(small, "l_partkey", "left_semi")


@query(
    "semi_join_any_table",
    """SELECT ID_WIKIDATA, N FROM (SELECT ID_ITEM AS ID_WIKIDATA, count(*) AS N FROM kg_qualifier WHERE ID_ITEM IS NOT NULL GROUP BY 1) WHERE
       (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_entity WHERE ENTITY_CLASS='SERIE')
        OR ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_entity WHERE ENTITY_CLASS='PERSON'))""",
)
def semi_join_any_table(d):
    used = d.kg_qualifier.filter(F.col("ID_ITEM").isNotNull()).groupBy(F.col("ID_ITEM").alias("ID_WIKIDATA")).agg(n())
    return joins.exists_in_any(used, "ID_WIKIDATA", of_class(d, "SERIE"), of_class(d, "PERSON"))


@query(
    "anti_join_all_tables",
    """SELECT ID_WIKIDATA, ENTITY_CLASS FROM v1_entity WHERE ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM v2_entity)""",
)
def anti_join_all_tables(d):
    v2 = d.v2_entity
    parts = [v2.filter(F.col("ENTITY_CLASS") == c).select("ID_WIKIDATA") for c in ("MOVIE", "ITEM", "PERSON")]
    return joins.missing_from_all(d.v1_entity.select("ID_WIKIDATA", "ENTITY_CLASS"), "ID_WIKIDATA", *parts)


@query(
    "left_join_null_count",
    """SELECT count(*) AS TOTAL, count(*) FILTER (b.ID_WIKIDATA IS NULL) AS ABSENT FROM v1_entity a LEFT JOIN v2_entity b ON a.ID_WIKIDATA=b.ID_WIKIDATA""",
)
def left_join_null_count(d):
    known = d.v2_entity.select("ID_WIKIDATA", F.lit(1).alias("_k"))
    return d.v1_entity.select("ID_WIKIDATA").join(known, "ID_WIKIDATA", "left").agg(
        F.count(F.lit(1)).alias("TOTAL"), F.count_if(F.col("_k").isNull()).alias("ABSENT")
    )


@query(
    "null_aware_not_in",
    """SELECT 'without null' AS LIST, count(*) AS N FROM v1_entity WHERE ID_EXTERNAL NOT IN (SELECT ID_EXTERNAL FROM v2_entity WHERE ID_EXTERNAL IS NOT NULL)
       UNION ALL SELECT 'with null', count(*) FROM v1_entity WHERE ID_EXTERNAL NOT IN (SELECT ID_EXTERNAL FROM v2_entity)""",
)
def null_aware_not_in(d):
    keys, listed = d.v1_entity.select("ID_EXTERNAL"), d.v2_entity.select("ID_EXTERNAL")
    a = joins.not_in(keys, "ID_EXTERNAL", listed.dropna()).agg(n()).select(F.lit("without null").alias("LIST"), "N")
    b = joins.not_in(keys, "ID_EXTERNAL", listed).agg(n()).select(F.lit("with null").alias("LIST"), "N")
    return a.union(b)


@query(
    "existence_flags",
    """SELECT ENTITY_CLASS, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_WIKIDATA FROM kg_claim)) AS WITH_STATEMENT, count(*) FILTER (ID_WIKIDATA IN (SELECT ID_ITEM FROM kg_claim WHERE ID_ITEM IS NOT NULL)) AS AS_VALUE,
       count(*) FILTER (ID_WIKIDATA IN (SELECT ID_ITEM FROM kg_qualifier WHERE ID_ITEM IS NOT NULL)) AS AS_QUALIFIER FROM kg_entity GROUP BY 1""",
)
def existence_flags(d):
    sides = {
        "WITH_STATEMENT": d.kg_claim.select("ID_WIKIDATA"),
        "AS_VALUE": d.kg_claim.select("ID_ITEM").dropna(),
        "AS_QUALIFIER": d.kg_qualifier.select("ID_ITEM").dropna(),
    }
    flagged = joins.existence_flags(d.kg_entity.select("ID_WIKIDATA", "ENTITY_CLASS"), "ID_WIKIDATA", sides)
    return flagged.groupBy("ENTITY_CLASS").agg(*[F.count_if(F.col(n)).alias(n) for n in sides])


@query(
    "scalar_lookup_after_group",
    """SELECT o_orderpriority, N, (SELECT c_name FROM customer WHERE c_custkey=K) AS EXAMPLE FROM (SELECT o_orderpriority, count(*) AS N, min(o_custkey) AS K FROM orders GROUP BY 1)""",
)
def scalar_lookup_after_group(d):
    groups = d.orders.groupBy("o_orderpriority").agg(n(), F.min("o_custkey").alias("c_custkey"))
    names = joins.first_per_key(d.customer.select("c_custkey", "c_name"), "c_custkey", "c_name", ["c_name"])
    return groups.join(names, "c_custkey", "left").select("o_orderpriority", "N", F.col("c_name").alias("EXAMPLE"))


@query(
    "pair_by_language",
    """SELECT a.source AS ID_WIKIDATA, a.t AS LABEL_FR, b.t AS LABEL_EN FROM (SELECT source, min(text) AS t FROM documents WHERE lang='fr' GROUP BY 1) a
       JOIN (SELECT source, min(text) AS t FROM documents WHERE lang='en' GROUP BY 1) b ON a.source=b.source""",
)
def pair_by_language(d):
    texts = d.documents.groupBy(F.col("source").alias("ID_WIKIDATA"), F.col("lang").alias("LANG")).agg(F.min("text").alias("LABEL"))
    return joins.pair_by_language(texts, "fr", "en")


@query(
    "matched_triples",
    """SELECT ID_PROPERTY, count(*) AS N FROM v1_triple a WHERE EXISTS (SELECT 1 FROM v2_triple b WHERE a.ID_WIKIDATA=b.ID_WIKIDATA AND a.ID_PROPERTY=b.ID_PROPERTY AND a.ID_ITEM=b.ID_ITEM) GROUP BY 1""",
)
def matched_triples(d):
    return joins.matched_triples(d.v1_triple, d.v2_triple).groupBy("ID_PROPERTY").agg(n())


@query("cast_key_join", "SELECT event_id, c_name FROM (SELECT event_id, json_extract_string(props,'$.k') AS k FROM events) e JOIN customer ON c_custkey::VARCHAR = k")
def cast_key_join(d):
    ids = d.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))
    return joins.cast_key_join(ids, "k", d.customer.select("c_custkey", "c_name"), "c_custkey").select("event_id", "c_name")


@query(
    "coalesce_sides",
    """SELECT coalesce(a.user_id,b.user_id) AS user_id, coalesce(a.V,b.V) AS V, strftime(greatest(a.T,b.T),'%Y-%m-%d %H:%M:%S') AS T FROM
       (SELECT user_id, max("value") AS V, max(ts) AS T FROM events WHERE event_type='view' GROUP BY 1) a FULL JOIN
       (SELECT user_id, max("value") AS V, max(ts) AS T FROM events WHERE event_type='click' GROUP BY 1) b ON a.user_id=b.user_id""",
)
def coalesce_sides(d):
    from kgspark.operators.merge import coalesce_sides as sides

    def side(kind):
        rows = d.events.filter(F.col("event_type") == kind)
        return rows.groupBy("user_id").agg(F.max("value").alias("V"), F.max("ts").alias("T"))

    out = sides(side("view"), side("click"), "user_id", ["V"], "T")
    return out.withColumn("T", F.date_format("T", "yyyy-MM-dd HH:mm:ss"))


@query(
    "hierarchical_join",
    """SELECT ID_STATEMENT FROM kg_claim s WHERE EXISTS (SELECT 1 FROM kg_fact p WHERE p.ID_WIKIDATA=s.ID_ITEM AND p.ID_PROPERTY='P31' AND p.ID_ITEM='Q7000000003')""",
)
def hierarchical_join(d):
    from kgspark.operators.awards import members_of

    members = members_of(d.kg_fact, "Q7000000003").withColumnRenamed("ID_WIKIDATA", "ID_ITEM")
    return d.kg_claim.select("ID_STATEMENT", "ID_ITEM").join(members, "ID_ITEM", "left_semi").select("ID_STATEMENT")


@query(
    "collation_match",
    """SELECT a.n_nationkey AS A, b.s_nationkey AS B, count(*) AS N FROM nation a JOIN supplier b ON lower(rtrim('nation_'||b.s_nationkey||'  ')) = lower(a.n_name) GROUP BY 1,2""",
)
def collation_match(d):
    names = d.supplier.select("s_nationkey", F.concat(F.lit("natión_"), F.col("s_nationkey").cast("string"), F.lit("  ")).alias("t"))
    pairs = names.join(d.nation, joins.same_text(F.col("t"), F.col("n_name")))
    return pairs.groupBy(F.col("n_nationkey").alias("A"), F.col("s_nationkey").alias("B")).agg(n())


@query(
    "best_of_group",
    """SELECT o_custkey, first(o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1""",
)
def best_of_group(d):
    return joins.best_of(d.orders, "o_custkey", "o_orderpriority", "o_totalprice", "o_orderkey")


@query(
    "overlap",
    """SELECT count(*) FILTER (b.ID_WIKIDATA IS NULL) AS ONLY_LEFT, count(*) FILTER (a.ID_WIKIDATA IS NOT NULL AND b.ID_WIKIDATA IS NOT NULL) AS BOTH_SIDES, count(*) FILTER (a.ID_WIKIDATA IS NULL) AS ONLY_RIGHT
       FROM (SELECT DISTINCT ID_WIKIDATA FROM v1_entity) a FULL JOIN (SELECT DISTINCT ID_WIKIDATA FROM v2_entity) b ON a.ID_WIKIDATA=b.ID_WIKIDATA""",
)
def overlap(d):
    return joins.overlap(d.v1_entity, d.v2_entity, "ID_WIKIDATA")


@query(
    "union_all_tagged",
    "SELECT 'v1' AS GENERATION, ENTITY_CLASS, count(*) AS N FROM v1_entity GROUP BY 2 UNION ALL SELECT 'v2', ENTITY_CLASS, count(*) FROM v2_entity GROUP BY 2",
)
def union_all_tagged(d):
    a = d.v1_entity.select("ENTITY_CLASS", F.lit("v1").alias("GENERATION"))
    b = d.v2_entity.select("ENTITY_CLASS", F.lit("v2").alias("GENERATION"))
    return a.unionByName(b).groupBy("GENERATION", "ENTITY_CLASS").agg(n())


@query("union_distinct", "SELECT ID_WIKIDATA FROM v1_entity UNION SELECT ID_WIKIDATA FROM v2_entity")
def union_distinct(d):
    return d.v1_entity.select("ID_WIKIDATA").union(d.v2_entity.select("ID_WIKIDATA")).distinct()


@query(
    "id_set_minus",
    "SELECT DISTINCT ID_WIKIDATA FROM kg_entity WHERE ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM kg_claim) AND ID_WIKIDATA NOT IN (SELECT ID_ITEM FROM kg_claim WHERE ID_ITEM IS NOT NULL)",
)
def id_set_minus(d):
    return joins.missing_from_all(d.kg_entity.select("ID_WIKIDATA"), "ID_WIKIDATA", d.kg_claim.select("ID_WIKIDATA"), d.kg_claim.select("ID_ITEM").dropna()).distinct()


@query(
    "named_sample",
    """SELECT a.ID_WIKIDATA, coalesce(a.LABEL_EN, a.ID_WIKIDATA) AS LABEL FROM v1_entity a WHERE a.ID_WIKIDATA NOT IN (SELECT ID_WIKIDATA FROM v2_entity) ORDER BY a.ID_WIKIDATA LIMIT 20""",
)
def named_sample(d):
    lost = joins.missing_from_all(d.v1_entity.select("ID_WIKIDATA", "LABEL_EN"), "ID_WIKIDATA", d.v2_entity.select("ID_WIKIDATA"))
    return lost.select("ID_WIKIDATA", F.coalesce("LABEL_EN", "ID_WIKIDATA").alias("LABEL")).orderBy("ID_WIKIDATA").limit(20)


# Ordering semantics


@query(
    "dedupe_keep_first",
    """SELECT ID_WIKIDATA, ID_PROPERTY, ID_ITEM, min(ROW_NO) AS ROW_NO FROM (SELECT 'Q'||(6000000000+l_orderkey) AS ID_WIKIDATA, l_returnflag AS ID_PROPERTY, l_linestatus AS ID_ITEM,
       l_partkey*100000000000+l_suppkey*10000000+l_linenumber*1000000+l_quantity::BIGINT AS ROW_NO FROM lineitem) GROUP BY 1,2,3""",
)
def dedupe_keep_first(d):
    from kgspark.sources.driver import ORDER, qid

    c = F.col
    number = c("l_partkey") * 100000000000 + c("l_suppkey") * 10000000 + c("l_linenumber") * 1000000 + c("l_quantity").cast("bigint")
    rows = d.lineitem.select(qid(ORDER, "l_orderkey").alias("ID_WIKIDATA"), c("l_returnflag").alias("ID_PROPERTY"), c("l_linestatus").alias("ID_ITEM"), number.alias("ROW_NO"))
    return ranking.dedupe_keep_first(rows, ["ID_WIKIDATA", "ID_PROPERTY", "ID_ITEM"], ["ROW_NO"])


@query(
    "display_order",
    "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS DISPLAY_ORDER FROM conversations",
)
def display_order(d):
    rows = d.conversations.select("conv_id", "turn")
    return ranking.display_order(rows, ["conv_id"], ["turn"])


@query(
    "display_order_of_events",
    "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS DISPLAY_ORDER FROM events",
)
def display_order_of_events(d):
    rows = d.events.select("event_id", "user_id", "ts")
    return ranking.display_order(rows, ["user_id"], ["ts", "event_id"]).select("event_id", "DISPLAY_ORDER")


@query(
    "first_position",
    "SELECT conv_id, turn, role, min(turn) OVER (PARTITION BY conv_id, role) AS FIRST_TURN FROM conversations",
)
def first_position(d):
    return ranking.first_position(d.conversations.select("conv_id", "turn", "role"), ["conv_id", "role"], "turn", "FIRST_TURN")


@query(
    "latest_wins",
    """SELECT user_id, event_type, event_id, "value" FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn=1""",
)
def latest_wins(d):
    rows = d.events.select("user_id", "event_type", "event_id", "value", "ts")
    return ranking.latest_wins(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "first_non_empty",
    """SELECT conv_id, first(CASE WHEN role='assistant' THEN text END ORDER BY CASE WHEN role='assistant' AND text<>'' THEN turn ELSE 1000000 END) AS ANSWER,
       first(CASE WHEN role='system' THEN text END ORDER BY CASE WHEN role='system' AND text<>'' THEN turn ELSE 1000000 END) AS SYSTEM FROM conversations GROUP BY 1""",
)
def first_non_empty(d):
    t = F.col("text")
    rows = d.conversations.select("conv_id", "turn", F.when(F.col("role") == "assistant", t).alias("ANSWER"), F.when(F.col("role") == "system", t).alias("SYSTEM"))
    return ranking.first_non_empty(rows, ["conv_id"], ["turn"], ["ANSWER", "SYSTEM"])


@query("pinned_order_of_words", """
    SELECT doc_id, w AS PATH, CASE WHEN w=base THEN 0 WHEN w=loc THEN 1 ELSE i - (SELECT count(*) FROM range(1, i) r(j) WHERE words[j::BIGINT]=base OR words[j::BIGINT]=loc) END AS DISPLAY_ORDER
    FROM (SELECT doc_id, words, words[1] AS base, coalesce(words[2],'') AS loc, unnest(words) AS w, generate_subscripts(words,1) AS i FROM (SELECT doc_id, string_split(source||' '||lang||' '||source||' a b '||lang||' c',' ') AS words FROM documents))
""")
def pinned_order_of_words(d):
    words = F.split(F.concat_ws(" ", "source", "lang", "source", F.lit("a b"), "lang", F.lit("c")), " ")
    images = F.transform(words, lambda w: F.struct(w.alias("path"), F.lit("").alias("lang")))
    placed = ranking.pinned_order(images, F.get(words, F.lit(0)), F.slice(words, 2, 1))
    return d.documents.select("doc_id", F.explode(placed).alias("p")).select(
        "doc_id", F.col("p.image.path").alias("PATH"), F.col("p.position").cast("bigint").alias("DISPLAY_ORDER")
    )
