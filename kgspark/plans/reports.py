"""Reconciliation and audit reports between two generations of the data.

Entity frames are (ID_WIKIDATA, ENTITY_CLASS, LABEL_EN, INSTANCE_OF, ID_EXTERNAL,
DELETED); triples are (ID_WIKIDATA, ID_PROPERTY, ID_ITEM). Most reports reduce the
entity tables to one row per id first ("which tables hold it") and join that once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions import n
from kgspark.functions.text import active, external_id_shape, filled, id_bucket, not_deprecated, safe_pct
from kgspark.operators.awards import qualifiers_of
from kgspark.operators.joins import existence_flags

ID = "ID_WIKIDATA"


def _ids(df: DataFrame, column: str = ID) -> DataFrame:
    return df.select(F.col(column).alias(ID)).filter(F.col(ID).isNotNull())


def live(entities: DataFrame) -> DataFrame:
    return entities.filter(active(F.col("DELETED")))


def inclusion(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Per entity type: active on both sides, missing from the new one, share, raw gap."""
    tagged = live(v1).select(ID, "ENTITY_CLASS", F.lit(1).alias("_s")).union(live(v2).select(ID, "ENTITY_CLASS", F.lit(2)))
    sides = tagged.groupBy("ENTITY_CLASS", ID).agg(F.bit_or("_s").alias("_s"))
    out = sides.groupBy("ENTITY_CLASS").agg(
        F.count_if(F.col("_s") != 2).alias("V1_ACTIVE"), F.count_if(F.col("_s") != 1).alias("V2_ACTIVE"), F.count_if(F.col("_s") == 1).alias("V1_MISSING")
    )
    return out.withColumn("PCT_MISSING", safe_pct(F.col("V1_MISSING"), F.col("V1_ACTIVE"), 2)).withColumn("RAW_GAP", F.col("V1_ACTIVE") - F.col("V2_ACTIVE"))


def missing(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Active old entities absent from the new table of the same type."""
    return live(v1).join(live(v2).select(ID, "ENTITY_CLASS"), [ID, "ENTITY_CLASS"], "left_anti")


def missing_elsewhere(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Of those missing from their own table: in another table, or nowhere."""
    anywhere = _ids(v2).distinct().withColumn("_k", F.lit(1))
    rows = missing(v1, v2).join(anywhere, ID, "left")
    return rows.groupBy("ENTITY_CLASS").agg(
        n("MISSING"), F.count("_k").alias("IN_ANOTHER_TABLE"), F.count_if(F.col("_k").isNull()).alias("NOWHERE")
    )


def destination(v1: DataFrame, v2: DataFrame, order: Sequence[str]) -> DataFrame:
    """Which table holds each old id now: the first of ``order``, or none."""
    rank = F.coalesce(*[F.when(F.col("ENTITY_CLASS") == t, F.lit(i)) for i, t in enumerate(order)])
    now = v2.groupBy(ID).agg(F.min(rank).alias("_r"))
    names = F.array(*[F.lit(t) for t in order])
    moved = live(v1).select(ID, "ENTITY_CLASS").join(now, ID, "left")
    return moved.groupBy("ENTITY_CLASS", F.coalesce(F.get(names, F.col("_r")), F.lit("nowhere")).alias("DESTINATION")).agg(n("N"))


def missing_by_class(v1: DataFrame, v2: DataFrame, labels: DataFrame, top: int = 25) -> DataFrame:
    """Missing entities per class with the class label, most frequent first.

    Grouped first, labelled after: one label per class, not one per entity.
    """
    counts = missing(v1, v2).groupBy("INSTANCE_OF").agg(n("N"))
    names = labels.groupBy(F.col(ID).alias("INSTANCE_OF")).agg(F.min("LABEL_EN").alias("LABEL"))
    return counts.join(names, "INSTANCE_OF", "left").orderBy(F.desc("N"), "INSTANCE_OF").limit(top)


def class_used_flag(entities: DataFrame, facts: DataFrame) -> DataFrame:
    """Entities per class, and whether that class occurs as a P31 value."""
    counts = entities.groupBy("INSTANCE_OF").agg(n("N"))
    used = _ids(facts.filter(F.col("ID_PROPERTY") == "P31"), "ID_ITEM").distinct().select(F.col(ID).alias("INSTANCE_OF"), F.lit(True).alias("_u"))
    return counts.join(used, "INSTANCE_OF", "left").select("INSTANCE_OF", "N", F.coalesce("_u", F.lit(False)).alias("USED_AS_CLASS"))


def value_gap(v1: DataFrame, v2: DataFrame, old_facts: DataFrame, new_facts: DataFrame, top: int = 25) -> DataFrame:
    """Values of common entities the new statements lack, by value."""
    common = _ids(live(v1)).join(_ids(live(v2)), ID, "left_semi").distinct()
    keys = [ID, "ID_PROPERTY", "ID_ITEM"]
    lost = old_facts.select(*keys).join(common, ID, "left_semi").join(new_facts.select(*keys), keys, "left_anti")
    return lost.groupBy("ID_ITEM").agg(n("N")).orderBy(F.desc("N"), "ID_ITEM").limit(top)


def missing_by_bucket(v1: DataFrame, v2: DataFrame, bounds: Sequence[tuple[int, str]], rest: str) -> DataFrame:
    """Missing entities by presence and shape of an external id, and by id age."""
    return missing(v1, v2).groupBy(
        filled(F.col("ID_EXTERNAL")).alias("HAS_EXTERNAL"), external_id_shape(F.col("ID_EXTERNAL")).alias("SHAPE"), id_bucket(F.col(ID), bounds, rest).alias("AGE")
    ).agg(n("N"), F.min("ID_EXTERNAL").alias("EXAMPLE"))


def schema_gap(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of the old tables the new ones do not have."""
    spark = next(iter(old.values())).sparkSession
    flat = lambda tables: [(t, c.name, c.dataType.simpleString()) for t, df in tables.items() for c in df.schema.fields]
    schema = "TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string"
    a, b = spark.createDataFrame(flat(old), schema), spark.createDataFrame(flat(new), schema)
    return a.join(b, ["TABLE_NAME", "COLUMN_NAME"], "left_anti")


def sample_ids(df: DataFrame, n: int | None) -> DataFrame:
    """All rows, or the ``n`` highest ids where the report is a sample."""
    return df if n is None else df.orderBy(F.desc(ID)).limit(n)


def column_recoverable(v1: DataFrame, columns: Mapping[str, str], facts: DataFrame, sample: int | None = None) -> DataFrame:
    """Per old column: rows filled, and how many have the matching property now."""
    rows = sample_ids(live(v1), sample)
    mapping = F.array(*[F.struct(F.lit(c).alias("COLUMN_NAME"), F.lit(p).alias("ID_PROPERTY"), filled(F.col(c).cast("string")).alias("f")) for c, p in columns.items()])
    long = rows.select(ID, F.explode(mapping).alias("m")).filter("m.f").select(ID, "m.COLUMN_NAME", "m.ID_PROPERTY")
    have = facts.filter(F.col("ID_PROPERTY").isin(*set(columns.values()))).select(ID, "ID_PROPERTY").distinct().withColumn("_k", F.lit(1))
    out = long.join(have, [ID, "ID_PROPERTY"], "left").groupBy("COLUMN_NAME", "ID_PROPERTY").agg(n("FILLED"), F.count("_k").alias("RECOVERABLE"))
    return out.withColumn("PCT", safe_pct(F.col("RECOVERABLE"), F.col("FILLED")))


def label_coverage(v1_texts: DataFrame, v2_labels: DataFrame, langs: Sequence[str]) -> DataFrame:
    """Labels per language filled in the old generation, also in the new, and lost.

    ``v1_texts`` is (id, LANG, LABEL), ``v2_labels`` is (id, LABELS map).
    """
    old = v1_texts.filter(F.col("LANG").isin(*langs) & filled(F.col("LABEL")))
    new = v2_labels.select(ID, F.explode("LABELS").alias("LANG", "_t")).filter(filled(F.col("_t")))
    out = old.join(new, [ID, "LANG"], "left").groupBy("LANG").agg(n("V1_FILLED"), F.count("_t").alias("ALSO_V2"))
    return out.withColumn("LOST", F.col("V1_FILLED") - F.col("ALSO_V2"))


def translation_real(texts: DataFrame, lang: str, fallback: str = "en") -> DataFrame:
    """Texts of a language that only repeat the fallback language, and real translations."""
    a = texts.filter(F.col("LANG") == lang).select(ID, F.col("LABEL").alias("_a"))
    b = texts.filter(F.col("LANG") == fallback).select(ID, F.col("LABEL").alias("_b"))
    return a.join(b, ID).agg(n("PAIRS"), F.count_if(F.col("_a") == F.col("_b")).alias("FALLBACK"), F.count_if(F.col("_a") != F.col("_b")).alias("TRANSLATED"))


def reverse_links(links: DataFrame, mirror: DataFrame) -> DataFrame:
    """Old links (id, foreign id) confirmed by the same pair in the other mirror."""
    both = mirror.select(ID, "ID_FOREIGN").distinct().withColumn("_both", F.lit(1))
    by_id = mirror.select(ID).distinct().withColumn("_id", F.lit(1))
    by_foreign = mirror.select("ID_FOREIGN").distinct().withColumn("_f", F.lit(1))
    rows = links.join(both, [ID, "ID_FOREIGN"], "left").join(by_id, ID, "left").join(by_foreign, "ID_FOREIGN", "left")
    return rows.agg(
        n("LINKS"), F.count("_both").alias("RECIPROCAL"),
        F.count_if(F.col("_both").isNull() & (F.col("_id").isNotNull() | F.col("_f").isNotNull())).alias("OTHER_PARTNER"),
        F.count_if(F.col("_id").isNull() & F.col("_f").isNull()).alias("UNKNOWN"),
    )


def recovery_paths(links: DataFrame, by_property: DataFrame, by_reverse: DataFrame) -> DataFrame:
    """Links found by an equal property value (A), by a reverse link (B), or not at all.

    Foreign ids are numbers on the old side and text in statements.
    """
    text = links.select(ID, F.col("ID_FOREIGN").cast("string").alias("_f"))
    a = by_property.select(ID, F.col("VALUE_TEXT").alias("_f")).distinct().withColumn("_a", F.lit(1))
    b = by_reverse.select(ID, F.col("ID_FOREIGN").cast("string").alias("_f")).distinct().withColumn("_b", F.lit(1))
    rows = text.join(a, [ID, "_f"], "left").join(b, [ID, "_f"], "left")
    return rows.agg(
        n("LINKS"), F.count("_a").alias("PATH_A"), F.count("_b").alias("PATH_B"),
        F.count_if(F.col("_a").isNotNull() | F.col("_b").isNotNull()).alias("EITHER_PATH"), F.count_if(F.col("_a").isNull() & F.col("_b").isNull()).alias("NO_PATH"),
    )


def image_coverage(v1: DataFrame, path: str, pages: DataFrame) -> DataFrame:
    """Old image paths covered by a page row of the same id."""
    known = _ids(pages).distinct().withColumn("_k", F.lit(1))
    rows = v1.filter(filled(F.col(path))).select(ID).join(known, ID, "left")
    out = rows.agg(n("WITH_IMAGE"), F.count("_k").alias("COVERED"))
    return out.withColumn("PCT", safe_pct(F.col("COVERED"), F.col("WITH_IMAGE")))


def silent_entities(entities: DataFrame, stmts: DataFrame) -> DataFrame:
    """Entities without any statement, per type."""
    speaking = _ids(stmts).distinct().withColumn("_k", F.lit(1))
    rows = live(entities).select(ID, "ENTITY_CLASS").join(speaking, ID, "left")
    out = rows.groupBy("ENTITY_CLASS").agg(n("ENTITIES"), F.count_if(F.col("_k").isNull()).alias("SILENT"))
    return out.withColumn("PCT_SILENT", safe_pct(F.col("SILENT"), F.col("ENTITIES")))


def silent_known(entities: DataFrame, stmts: DataFrame, old_triples: DataFrame) -> DataFrame:
    """Silent entities the old generation knew facts about."""
    silent = _ids(live(entities)).join(_ids(stmts), ID, "left_anti")
    known = _ids(old_triples).distinct().withColumn("_k", F.lit(1))
    return silent.join(known, ID, "left").agg(n("SILENT"), F.count("_k").alias("KNOWN_IN_V1"))


def reference_origin(items: DataFrame, stmts: DataFrame, quals: DataFrame) -> DataFrame:
    """Items as a main value, only as a qualifier value, or never referenced."""
    flagged = existence_flags(_ids(items), ID, {"_m": _ids(stmts, "ID_ITEM"), "_q": _ids(quals, "ID_ITEM")})
    return flagged.agg(
        n("ITEMS"), F.count_if(F.col("_m")).alias("AS_MAIN_VALUE"), F.count_if(~F.col("_m") & F.col("_q")).alias("QUALIFIER_ONLY"), F.count_if(~F.col("_m") & ~F.col("_q")).alias("NEVER")
    )


def carrier_properties(items: DataFrame, triples: DataFrame, top: int = 25) -> DataFrame:
    """Properties through which the given items arrived."""
    wanted = items.select(F.col(ID).alias("ID_ITEM")).distinct()
    rows = triples.join(wanted, "ID_ITEM", "left_semi")
    out = rows.groupBy("ID_PROPERTY").agg(F.count_distinct("ID_ITEM").alias("ITEMS"), n("LINKS"))
    return out.orderBy(F.desc("ITEMS"), "ID_PROPERTY").limit(top)


def subject_presence(lost_triples: DataFrame, entities: DataFrame) -> DataFrame:
    """Are the subjects of missing links present in the new tables?"""
    known = entities.groupBy(ID).agg(F.min("ENTITY_CLASS").alias("_t"))
    rows = lost_triples.join(known, ID, "left")
    return rows.groupBy("ID_PROPERTY").agg(
        n("LINKS"), F.count("_t").alias("SUBJECT_PRESENT"), F.count_if(F.col("_t").isNull()).alias("SUBJECT_ABSENT"), F.count_distinct(ID).alias("SUBJECTS")
    )


def lost_triples(old: DataFrame, new: DataFrame) -> DataFrame:
    keys = [ID, "ID_PROPERTY", "ID_ITEM"]
    return old.select(*keys).join(new.select(*keys), keys, "left_anti")


def start_set_coverage(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per property: distinct items of the old triples, and those an equal new triple covers."""
    keys = [ID, "ID_PROPERTY", "ID_ITEM"]
    seen = new.select(*keys).distinct().withColumn("_k", F.lit(1))
    rows = old.select(*keys).join(seen, keys, "left").groupBy("ID_PROPERTY", "ID_ITEM").agg(F.max("_k").alias("_k"))
    out = rows.groupBy("ID_PROPERTY").agg(n("V1_ITEMS"), F.count("_k").alias("COVERED"))
    return out.withColumn("PCT", safe_pct(F.col("COVERED"), F.col("V1_ITEMS")))


def qualifier_presence(stmts: DataFrame, quals: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Statements of a property that carry a given qualifier, for several pairs at once."""
    wanted = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in pairs])
    asked = stmts.select("ID_STATEMENT", "ID_PROPERTY", F.explode(F.filter(wanted, lambda x: x["p"] == F.col("ID_PROPERTY"))).alias("w"))
    asked = asked.select("ID_STATEMENT", "ID_PROPERTY", F.col("w.q").alias("ID_QUALIFIER_PROPERTY"))
    have = quals.select("ID_STATEMENT", "ID_QUALIFIER_PROPERTY").distinct().withColumn("_k", F.lit(1))
    out = asked.join(have, ["ID_STATEMENT", "ID_QUALIFIER_PROPERTY"], "left").groupBy("ID_PROPERTY", "ID_QUALIFIER_PROPERTY").agg(n("STATEMENTS"), F.count("_k").alias("WITH_QUALIFIER"))
    return out.withColumn("PCT", safe_pct(F.col("WITH_QUALIFIER"), F.col("STATEMENTS")))


def qualifier_only_items(quals: DataFrame, stmts: DataFrame, entities: DataFrame) -> DataFrame:
    """Items known only as qualifier values, and how many are in no entity table."""
    side = _ids(quals, "ID_ITEM").distinct().join(_ids(stmts, "ID_ITEM"), ID, "left_anti")
    known = _ids(entities).distinct().withColumn("_k", F.lit(1))
    return side.join(known, ID, "left").agg(n("QUALIFIER_ONLY"), F.count_if(F.col("_k").isNull()).alias("IN_NO_TABLE"))


def locate(entities: DataFrame, qid: str) -> DataFrame:
    """Every entity table an id is in."""
    return entities.filter(F.col(ID) == qid).select(ID, "ENTITY_CLASS", "LABEL_EN")


def qualifier_volume(quals: DataFrame, top: int = 25) -> DataFrame:
    counts = quals.groupBy("ID_QUALIFIER_PROPERTY").agg(n("N"), F.count_distinct("ID_STATEMENT").alias("STATEMENTS"))
    return counts.orderBy(F.desc("N"), "ID_QUALIFIER_PROPERTY").limit(top)


def qualifier_carriers(stmts: DataFrame, quals: DataFrame, qualifier: str, top: int = 25) -> DataFrame:
    """Properties whose statements carry a qualifier."""
    with_it = quals.filter(F.col("ID_QUALIFIER_PROPERTY") == qualifier).select("ID_STATEMENT")
    rows = stmts.select("ID_STATEMENT", "ID_PROPERTY").join(with_it, "ID_STATEMENT", "left_semi")
    return rows.groupBy("ID_PROPERTY").agg(n("N")).orderBy(F.desc("N"), "ID_PROPERTY").limit(top)


def witness(stmts: DataFrame, quals: DataFrame, subject: str) -> DataFrame:
    """All statements of an entity, one row per qualifier (or one without)."""
    mine = stmts.filter(F.col(ID) == subject).select("ID_STATEMENT", "ID_PROPERTY", "VALUE_TEXT")
    q = qualifiers_of(quals, mine).select("ID_STATEMENT", "ID_QUALIFIER_PROPERTY", F.col("VALUE_TEXT").alias("QUALIFIER_VALUE"))
    return mine.join(q, "ID_STATEMENT", "left").select("ID_PROPERTY", "VALUE_TEXT", "ID_QUALIFIER_PROPERTY", "QUALIFIER_VALUE")


def property_profile(stmts: DataFrame, allowed: Sequence[str], top: int = 25) -> DataFrame:
    """Statements and subjects per property, and whether it is in the allowed set."""
    out = stmts.groupBy("ID_PROPERTY").agg(n("STATEMENTS"), F.count_distinct(ID).alias("SUBJECTS"))
    return out.withColumn("ALLOWED", F.col("ID_PROPERTY").isin(*allowed)).orderBy(F.desc("STATEMENTS"), "ID_PROPERTY").limit(top)


def type_landing(parents: DataFrame, children: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Per VALUE_TYPE: statements, and rows in each value table.

    ``children`` is (ID_STATEMENT, CHILD_TABLE): the tables are stacked, joined once.
    """
    flags = children.groupBy("ID_STATEMENT").agg(*[F.max(F.when(F.col("CHILD_TABLE") == k, 1).otherwise(0)).alias(f"_{k}") for k in kinds])
    rows = parents.select("ID_STATEMENT", "VALUE_TYPE").join(flags, "ID_STATEMENT", "left")
    return rows.groupBy("VALUE_TYPE").agg(n("STATEMENTS"), *[F.coalesce(F.sum(f"_{k}"), F.lit(0)).alias(f"IN_{k.upper()}") for k in kinds])


def freshness(df: DataFrame, ts: str, since: Column) -> DataFrame:
    """Rows written since a moment, and the last write."""
    return df.agg(n("ROWS"), F.count_if(F.col(ts) >= since).alias("SINCE"), F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss").alias("LAST_WRITE"))


def class_membership(facts: DataFrame, entities: DataFrame, table: str) -> DataFrame:
    """Per class: entities carrying it as P31, and those of them in a table."""
    held = _ids(entities.filter(F.col("ENTITY_CLASS") == table)).distinct().withColumn("_k", F.lit(1))
    rows = facts.filter(F.col("ID_PROPERTY") == "P31").select(ID, F.col("ID_ITEM").alias("CLASS_ID")).distinct().join(held, ID, "left")
    return rows.groupBy("CLASS_ID").agg(n("MEMBERS"), F.count("_k").alias("IN_TABLE"))


def occupation_probe(missing_ids: DataFrame, facts: DataFrame, prop: str) -> DataFrame:
    """Missing ids with and without a property."""
    have = facts.filter(F.col("ID_PROPERTY") == prop).select(ID).distinct().withColumn("_k", F.lit(1))
    return _ids(missing_ids).distinct().join(have, ID, "left").agg(n("MISSING"), F.count("_k").alias("WITH_PROPERTY"), F.count_if(F.col("_k").isNull()).alias("WITHOUT"))


def top_values(missing_ids: DataFrame, facts: DataFrame, prop: str, top: int = 20) -> DataFrame:
    """Most frequent values of a property among the given ids."""
    rows = facts.filter(F.col("ID_PROPERTY") == prop).join(_ids(missing_ids).distinct(), ID, "left_semi")
    return rows.groupBy("ID_ITEM").agg(F.count_distinct(ID).alias("N")).orderBy(F.desc("N"), "ID_ITEM").limit(top)


def batch_progress(staging: DataFrame, target: DataFrame, batch: str) -> DataFrame:
    """Staged rows by status and loaded rows by value type, for one batch."""
    a = staging.filter(F.col("IMPORT_BATCH_ID") == batch).groupBy(F.concat(F.lit("staging "), F.col("ROW_STATUS")).alias("STEP")).agg(n("N"))
    b = target.filter(F.col("IMPORT_BATCH_ID") == batch).groupBy(F.concat(F.lit("target "), F.col("VALUE_TYPE")).alias("STEP")).agg(n("N"))
    return a.union(b)


def batch_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Batches present in each table and their rows."""
    out = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("TABLE_NAME"), "IMPORT_BATCH_ID")
        out = part if out is None else out.union(part)
    return out.groupBy("TABLE_NAME", "IMPORT_BATCH_ID").agg(n("N"))


def award_rows_by_class(stmts: DataFrame, facts: DataFrame, prop: str) -> DataFrame:
    """Award rows whose value has a class, counted per class."""
    won = stmts.filter((F.col("ID_PROPERTY") == prop) & F.col("ID_ITEM").isNotNull()).select("ID_STATEMENT", "ID_ITEM")
    cls = facts.filter(F.col("ID_PROPERTY") == "P31").select(F.col(ID).alias("ID_ITEM"), F.col("ID_ITEM").alias("CLASS_ID")).distinct()
    return won.join(cls, "ID_ITEM").groupBy("CLASS_ID").agg(n("AWARD_ROWS"), F.count_distinct("ID_ITEM").alias("AWARDS"))


def run_status(ledger: DataFrame, prefix: str) -> DataFrame:
    return ledger.filter(F.col("NAME").startswith(prefix))


def differences_sample(v1: DataFrame, v2: DataFrame, column: str, top: int) -> DataFrame:
    """Named examples of ids whose column differs between the generations."""
    a, b = v1.select(ID, F.col(column).alias("V1_VALUE")), v2.select(ID, F.col(column).alias("V2_VALUE"))
    return a.join(b, ID).filter(~F.col("V1_VALUE").eqNullSafe(F.col("V2_VALUE"))).orderBy(ID).limit(top)


def probe_coverage(old: DataFrame, new: DataFrame, entities: DataFrame, prop: str) -> DataFrame:
    """Subjects of a property before: present as an entity now, and still carrying it."""
    subjects = _ids(old.filter(F.col("ID_PROPERTY") == prop)).distinct()
    flagged = existence_flags(subjects, ID, {"_e": _ids(entities), "_p": _ids(new.filter(F.col("ID_PROPERTY") == prop))})
    return flagged.agg(n("V1_SUBJECTS"), F.count_if(F.col("_e")).alias("PRESENT"), F.count_if(F.col("_p")).alias("CARRYING"), F.count_if(~F.col("_e")).alias("ABSENT"))


def missing_root_kind(missing_ids: DataFrame, memberships: DataFrame, roots: Sequence[str], pool: DataFrame) -> DataFrame:
    """Missing ids whose class is a bare root, a subclass of one, or outside."""
    rank = F.when(F.col("CLASS_ID").isin(*roots), 0).when(F.col("_in") == 1, 1).otherwise(2)
    inside = pool.select(F.col("QID").alias("CLASS_ID"), F.lit(1).alias("_in")).distinct()
    rows = memberships.join(_ids(missing_ids).distinct(), ID, "left_semi").join(inside, "CLASS_ID", "left")
    best = rows.groupBy(ID).agg(F.min(rank).alias("_r"))
    kind = F.when(F.col("_r") == 0, "bare root").when(F.col("_r") == 1, "subclass").otherwise("outside")
    return best.groupBy(kind.alias("CLASS_KIND")).agg(n("N"))


def live_statements(stmts: DataFrame) -> DataFrame:
    return stmts.filter(active(F.col("DELETED")) & not_deprecated(F.col("RANK")))
