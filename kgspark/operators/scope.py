"""Class graph: subclass closure, classification, and which entities are in scope."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.functions import once, shuffled
from kgspark.functions.text import safe_pct
from kgspark.operators.claims import item_value, snak_value
from kgspark.session import cut, cut_path

# Root classes of each entity type, in order of precedence.
ROOTS = {
    "person": ("Q5",),
    "movie": ("Q11424", "Q506240"),
    "series": ("Q5398426", "Q1259759", "Q526877", "Q15416"),
    "season": ("Q3464665",),
    "episode": ("Q21191270",),
    "character": ("Q95074",),
}
EXCLUDED_SERIES_ROOTS: tuple[str, ...] = ()
ENTITY_TABLE = {
    "person": "PERSON",
    "movie": "MOVIE",
    "series": "SERIE",
    "season": "SEASON",
    "episode": "EPISODE",
    "character": "CHARACTER",
}

_CLAIM_SNAK = "STRUCT<mainsnak STRUCT<snaktype STRING, datatype STRING, datavalue STRUCT<value VARIANT>>>"


def _main_snaks(prop: str) -> Column:
    """Main snaks of one property's claims: the list is parsed as a whole, and claim by claim only where one has another shape."""
    text = F.try_element_at("claims", F.lit(prop))
    each = F.transform(F.from_json(text, "ARRAY<STRING>"), lambda r: F.from_json(r, _CLAIM_SNAK))
    claims = F.coalesce(F.from_json(text, f"ARRAY<{_CLAIM_SNAK}>"), each)
    return F.transform(claims, lambda c: c.getField("mainsnak"))


def _claim_items(prop: str) -> Column:
    """Item ids of one property's claims, read inside the entity row (no shuffle)."""

    def item(snak: Column) -> Column:
        return F.when(snak.getField("datatype") == "wikibase-item", item_value(snak_value(snak)))

    return F.filter(F.transform(_main_snaks(prop), item), lambda q: q.isNotNull())


def scope_columns(entities: DataFrame, *extra: str) -> DataFrame:
    """What scope needs of every entity, in one narrow row: ids of P279 and P31 (the latter sorted, distinct) and the IMDb flag."""
    has_value = F.exists(_main_snaks("P345"), lambda snak: snak_value(snak).isNotNull())
    return entities.select("id", "type", _claim_items("P279").alias("P279"), F.array_sort(F.array_distinct(_claim_items("P31"))).alias("P31"), F.coalesce(has_value, F.lit(False)).alias("HAS_IMDB"), *extra)


def subclass_edges(entities: DataFrame) -> DataFrame:
    """Distinct (child, parent) pairs of the P279 claims of items."""
    items = entities.filter((F.col("type") == "item") & (F.coalesce("id", F.lit("")) != ""))
    if "P279" not in entities.columns:  # the explode below would parse a list again for its filter
        items = once(items, P279=_claim_items("P279"))
    pairs = items.select(F.col("id").alias("ID_CHILD"), F.explode("P279").alias("ID_PARENT"))
    return pairs.dropDuplicates(["ID_CHILD", "ID_PARENT"])


def p31_sidecar(entities: DataFrame) -> DataFrame:
    """Id, sorted distinct P31 classes and the IMDb flag (of humans) of every item with a class."""
    rows = entities if "P31" in entities.columns else scope_columns(entities)
    known = rows.filter((F.col("type") == "item") & (F.size("P31") > 0))
    return known.select(F.col("id").alias("ID_WIKIDATA"), "P31", (F.array_contains("P31", "Q5") & F.col("HAS_IMDB")).alias("HAS_IMDB"))


def root_frame(spark: SparkSession, roots: Mapping[str, Sequence[str]]) -> DataFrame:
    rows = [(kind, qid) for kind, qids in roots.items() for qid in qids]
    return spark.createDataFrame(rows, "ROOT_TYPE string, QID string")


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucketed(df: DataFrame, keys: Sequence[str], name: str) -> tuple[str, str]:
    """Write ``df`` to the shared folder, dealt by ``keys`` into as many buckets as a shuffle has partitions; (table, path)."""
    spark, path, table = df.sparkSession, cut_path(df.sparkSession, name), f"kg_{uuid.uuid4().hex}"
    n = _buckets(spark)
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return table, path


def _bucketed_edges(edges: DataFrame) -> tuple[str, DataFrame]:
    """The edges bucketed by parent once, and the parents that hold so many that they are spread over several buckets.

    A parent of more than a quarter of a bucket's fair share gets ``PARTS`` salts; there are at most four such parents a bucket.
    """
    spark = edges.sparkSession
    edges = cut(edges.select("ID_PARENT", "ID_CHILD").dropna().distinct(), "edges")
    share = max(1, edges.count() // (4 * _buckets(spark)))
    sizes = edges.groupBy("ID_PARENT").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > share)
    crowded = cut(sizes.select("ID_PARENT", F.ceil(F.col("n") / share).cast("int").alias("PARTS")), "crowded")
    parts = F.coalesce("PARTS", F.lit(1))
    salted = edges.join(F.broadcast(crowded), "ID_PARENT", "left").withColumn("SALT", F.pmod(F.xxhash64("ID_CHILD"), parts).cast("int"))
    return _bucketed(salted.select("ID_PARENT", "SALT", "ID_CHILD"), ["ID_PARENT", "SALT"], "subclass-buckets")[0], crowded


def _below(frontier: DataFrame, edges: DataFrame, crowded: DataFrame) -> DataFrame:
    """Children of the frontier: only the frontier moves, the edges are read where they lie."""
    asked = frontier.select("ROOT_TYPE", F.col("QID").alias("ID_PARENT")).join(F.broadcast(crowded), "ID_PARENT", "left")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("PARTS", F.lit(1)) - 1)).alias("SALT")
    found = asked.select("ROOT_TYPE", "ID_PARENT", salts).join(edges, ["ID_PARENT", "SALT"])
    return found.select("ROOT_TYPE", F.col("ID_CHILD").alias("QID")).distinct()


def closure_multi(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(ROOT_TYPE, QID): every root and everything below it, for all roots at once.

    Breadth first: each round joins the newest nodes with the edges and drops what was seen, so a cycle dies out by itself.
    The edges are bucketed by parent once, so a round shuffles its frontier only. What was seen is bucketed too: the rounds
    since the last folding are few rows, and once they are half of what is folded all is folded anew, so that over the whole
    run every node is written a few times at most. The driver sees one row count per round, never the nodes.
    """
    spark, keys = edges.sparkSession, ["ROOT_TYPE", "QID"]
    edge_table, crowded = _bucketed_edges(edges)
    frontier = cut(roots.select(*keys).distinct(), "roots")
    folded, recent, held, waiting = None, [frontier], 0, frontier.count()
    tables = [edge_table]
    try:
        while True:  # a round only ever adds nodes not seen before, so this ends
            if 2 * waiting > held:
                rows = recent if folded is None else [spark.read.parquet(folded[1]), *recent]
                folded = _bucketed(reduce(DataFrame.union, rows), keys, "seen")
                tables.append(folded[0])
                recent, held, waiting = [], held + waiting, 0
            new = _below(frontier, spark.table(edge_table), crowded).join(spark.table(folded[0]), keys, "left_anti")
            if recent:
                new = new.join(reduce(DataFrame.union, recent), keys, "left_anti")
            frontier = cut(new, "frontier")
            n = frontier.count()
            if not n:
                break
            recent.append(frontier)
            waiting += n
    finally:
        for table in tables:  # the names only: the files stay where they are
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return reduce(DataFrame.union, [spark.read.parquet(folded[1]), *recent])


def closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Distinct ids of ``roots`` (first column) and all their descendants."""
    start = roots.select(F.lit("root").alias("ROOT_TYPE"), F.col(roots.columns[0]).alias("QID"))
    return closure_multi(edges, start).select("QID")


def closure_size_check(members: DataFrame, floor: int, reference: int) -> DataFrame:
    """Size of a closure against a guard floor and the last run's size."""
    size = members.agg(F.count(F.lit(1)).alias("CLASSES"))
    return size.select(
        "CLASSES",
        F.lit(floor).cast("bigint").alias("FLOOR"),
        F.lit(reference).cast("bigint").alias("REFERENCE"),
        F.when(F.col("CLASSES") < floor, "ALERT").otherwise("ok").alias("VERDICT"),
        (F.col("CLASSES") - reference).alias("DRIFT"),
    )


def closure_drift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Classes gained and lost between two closures."""
    old = previous.select("QID").distinct().withColumn("_old", F.lit(True))
    new = current.select("QID").distinct().withColumn("_new", F.lit(True))
    both = old.join(new, "QID", "full_outer")
    return both.filter(F.col("_old").isNull() | F.col("_new").isNull()).select(
        "QID", F.when(F.col("_old").isNull(), "gained").otherwise("lost").alias("CHANGE")
    )


def classify(memberships: DataFrame, pools: DataFrame, order: Sequence[str] = tuple(ROOTS), excluded: Sequence[str] = EXCLUDED_SERIES_ROOTS) -> DataFrame:
    """Entity type of each id: the first type, in ``order``, any of its classes is in.

    ``memberships`` is (ID_WIKIDATA, CLASS_ID), ``pools`` is (ROOT_TYPE, QID). The
    minimum is combined before the shuffle, so a class shared by a third of all
    entities costs no more than any other.
    """
    rank = F.coalesce(*[F.when(F.col("ROOT_TYPE") == t, F.lit(i)) for i, t in enumerate(order)])
    names = F.array(*[F.lit(t) for t in order])
    ranked = pools.filter(F.col("ROOT_TYPE").isin(*order))
    if excluded:
        ranked = ranked.filter(~((F.col("ROOT_TYPE") == "series") & F.col("QID").isin(*excluded)))
    by_class = ranked.groupBy(F.col("QID").alias("CLASS_ID")).agg(F.min(rank).alias("_rank"))
    hits = memberships.join(by_class, "CLASS_ID").groupBy("ID_WIKIDATA").agg(F.min("_rank").alias("_rank"))
    return hits.select("ID_WIKIDATA", F.get(names, F.col("_rank")).alias("ENTITY_CLASS"))


def classify_sidecar(sidecar: DataFrame, pools: DataFrame) -> DataFrame:
    """Sidecar rows with their entity type; unclassified rows are left out."""
    pairs = sidecar.select("ID_WIKIDATA", F.explode("P31").alias("CLASS_ID"))
    return sidecar.join(shuffled(classify(pairs, pools)), "ID_WIKIDATA")


def core_and_candidates(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(core ids, candidate persons): persons are core only with an IMDb id."""
    person = F.col("ENTITY_CLASS") == "person"
    core = classified.filter(~person | F.col("HAS_IMDB")).select("ID_WIKIDATA", "ENTITY_CLASS")
    return core, classified.filter(person).select("ID_WIKIDATA")


def referenced_items(stmts: DataFrame, quals: DataFrame) -> DataFrame:
    """Distinct item ids used as a main value or as a qualifier value."""
    main = stmts.select("ID_ITEM").filter(F.col("ID_ITEM").isNotNull())
    side = quals.select("ID_ITEM").filter(F.col("ID_ITEM").isNotNull())
    return main.union(side).distinct()


def referenced_persons(stmts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidate persons used as a main value (qualifiers do not count)."""
    used = stmts.select("ID_ITEM").filter(F.col("ID_ITEM").isNotNull())
    wanted = candidates.select(F.col(candidates.columns[0]).alias("ID_ITEM"))
    return used.join(shuffled(wanted), "ID_ITEM", "left_semi").distinct()


def item_cache_rows(entities: DataFrame, core: DataFrame, items: DataFrame, persons: DataFrame) -> DataFrame:
    """Label-only entities: not core, referenced; persons win over items."""
    tag = persons.select(F.col(persons.columns[0]).alias("ID_WIKIDATA"), F.lit(0).alias("_p"))
    tag = tag.union(items.select(F.col(items.columns[0]).alias("ID_WIKIDATA"), F.lit(1).alias("_p")))
    target = tag.groupBy("ID_WIKIDATA").agg(F.min("_p").alias("_p"))
    target = target.join(shuffled(core.select("ID_WIKIDATA")), "ID_WIKIDATA", "left_anti")
    return entities.join(shuffled(target), "ID_WIKIDATA").withColumn(
        "TARGET_TABLE", F.when(F.col("_p") == 0, "PERSON").otherwise("ITEM")
    ).drop("_p")


def cone_split(rows: DataFrame, cone: DataFrame) -> DataFrame:
    """Distinct ids whose class lies in / outside a cone, with the cone's size.

    ``rows`` is (ID_WIKIDATA, CLASS_ID); an id with one class inside counts as inside.
    """
    flagged = rows.join(
        cone.select(F.col("QID").alias("CLASS_ID"), F.lit(1).alias("_in")).distinct(), "CLASS_ID", "left"
    )
    per_id = flagged.groupBy("ID_WIKIDATA").agg(F.max(F.coalesce("_in", F.lit(0))).alias("_in"))
    ids = per_id.select("_in", F.lit(None).cast("string").alias("_class"))
    classes = cone.select(F.lit(None).cast("int").alias("_in"), F.col("QID").alias("_class")).distinct()
    return ids.union(classes).agg(
        F.count_if(F.col("_in") == 1).alias("IN_CONE"),
        F.count_if(F.col("_in") == 0).alias("OUT_OF_CONE"),
        F.count("_class").alias("CONE_SIZE"),
    ).withColumn("PCT_IN", safe_pct(F.col("IN_CONE"), F.col("IN_CONE") + F.col("OUT_OF_CONE"), 2))


def cone_diagnosis(missing: DataFrame, pool: DataFrame, top: int = 25) -> DataFrame:
    """Missing entities by class, each class flagged as in or out of the pool."""
    counts = missing.groupBy("CLASS_ID").agg(F.count(F.lit(1)).alias("N"))
    members = pool.select(F.col("QID").alias("CLASS_ID"), F.lit(1).alias("_in")).distinct()
    return (
        counts.join(members, "CLASS_ID", "left")
        .select("CLASS_ID", "N", F.when(F.col("_in") == 1, "in pool").otherwise("out of pool").alias("POOL"))
        .orderBy(F.desc("N"), "CLASS_ID")
        .limit(top)
    )
