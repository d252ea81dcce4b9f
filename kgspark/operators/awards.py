"""Knowledge-graph questions over statements, qualifiers and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AWARD, NOMINATION = "P166", "P1411"
POINT_IN_TIME, FOR_WORK, CEREMONY, INSTANCE_OF, GENDER = "P585", "P1686", "P805", "P31", "P21"


def labels_of(labels: DataFrame, classes: Sequence[str], key: str, name: str) -> DataFrame:
    """(key, name): one label per id, searched in the given entity tables in order.

    ``labels`` is the stacked dimension (ID_WIKIDATA, ENTITY_CLASS, LABEL_EN). The
    search order becomes a minimum, so N lookups are one aggregate and one join.
    """
    rank = F.coalesce(*[F.when(F.col("ENTITY_CLASS") == c, F.lit(i)) for i, c in enumerate(classes)])
    known = labels.filter(F.col("ENTITY_CLASS").isin(*classes) & F.col("LABEL_EN").isNotNull())
    if len(classes) == 1:
        return known.select(F.col("ID_WIKIDATA").alias(key), F.col("LABEL_EN").alias(name))
    return known.groupBy(F.col("ID_WIKIDATA").alias(key)).agg(F.min_by("LABEL_EN", rank).alias(name))


def qualifier_pivot(stmts: DataFrame, quals: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Left join one qualifier property per new column: {name: (property, value column)}.

    The property filter is part of each right side, so statements without the
    qualifier stay; several values of one property fan out, as they must. For a few
    chosen statements pass ``quals`` through ``qualifiers_of`` first.
    """
    out = stmts
    for name, (prop, value) in columns.items():
        side = quals.filter(F.col("ID_QUALIFIER_PROPERTY") == prop).select("ID_STATEMENT", F.col(value).alias(name))
        out = out.join(side, "ID_STATEMENT", "left")
    return out


def qualifiers_of(quals: DataFrame, stmts: DataFrame, properties: Sequence[str] | None = None) -> DataFrame:
    """The qualifiers of the given statements: the large table is filtered where it lies.

    The statements of one subject or award are few, so their ids travel to the
    qualifiers (by broadcast, if Spark finds them small) and not the other way round.
    """
    wanted = quals if properties is None else quals.filter(F.col("ID_QUALIFIER_PROPERTY").isin(*properties))
    return wanted.join(stmts.select("ID_STATEMENT").distinct(), "ID_STATEMENT", "left_semi")


def left_lookup(rows: DataFrame, side: DataFrame, key: str, salt: str = "ID_STATEMENT") -> DataFrame:
    """Left join on a key that is often NULL: each NULL gets a key of its own that matches nothing.

    So rows without a key are dealt out evenly instead of meeting in one partition.
    """
    dealt = F.coalesce(F.col(key), F.concat(F.lit("#"), F.col(salt).cast("string")))
    return rows.withColumn("_key", dealt).join(side.withColumnRenamed(key, "_key"), "_key", "left").drop("_key")


def members_of(facts: DataFrame, family: str, prop: str = INSTANCE_OF) -> DataFrame:
    """Distinct subjects of item statements (prop -> family)."""
    return facts.filter((F.col("ID_PROPERTY") == prop) & (F.col("ID_ITEM") == family)).select("ID_WIKIDATA").distinct()


def _won(stmts: DataFrame, prop: str = AWARD) -> DataFrame:
    return stmts.filter((F.col("ID_PROPERTY") == prop) & F.col("ID_ITEM").isNotNull())


def _of(stmts: DataFrame, subjects: Sequence[str] | None) -> DataFrame:
    return stmts if subjects is None else stmts.filter(F.col("ID_WIKIDATA").isin(*subjects))


def awards_all(stmts: DataFrame, quals: DataFrame, labels: DataFrame, subjects: Sequence[str] | None = None, prop: str = AWARD, work: str = "MOVIE", ceremony: Sequence[str] = ("ITEM", "SERIE")) -> DataFrame:
    """Awards with year, work and ceremony, for all subjects or the given ones."""
    chosen = _of(_won(stmts, prop), subjects).select("ID_STATEMENT", "ID_WIKIDATA", "ID_ITEM")
    wide = qualifier_pivot(
        chosen,
        quals if subjects is None else qualifiers_of(quals, chosen, [POINT_IN_TIME, FOR_WORK, CEREMONY]),
        {"YEAR": (POINT_IN_TIME, "YEAR_VALUE"), "_work": (FOR_WORK, "ID_ITEM"), "_ceremony": (CEREMONY, "ID_ITEM")},
    )
    named = wide.join(labels_of(labels, ["ITEM"], "ID_ITEM", "_award_label"), "ID_ITEM", "left")
    named = left_lookup(named, labels_of(labels, [work], "_work", "_work_label"), "_work")
    named = left_lookup(named, labels_of(labels, ceremony, "_ceremony", "_ceremony_label"), "_ceremony")
    return named.select(
        "ID_WIKIDATA",
        F.coalesce("_award_label", "ID_ITEM").alias("AWARD"),
        "YEAR",
        F.coalesce("_work_label", "_work").alias("FOR_WORK"),
        F.coalesce("_ceremony_label", "_ceremony").alias("CEREMONY"),
    )


def awards_of(stmts: DataFrame, quals: DataFrame, labels: DataFrame, subject: str, **names: object) -> DataFrame:
    return awards_all(stmts, quals, labels, [subject], **names).drop("ID_WIKIDATA")


def _in_family(won: DataFrame, facts: DataFrame, family: str) -> DataFrame:
    """Awards whose value is an instance of ``family``: a semi join, so no fan-out."""
    return won.join(members_of(facts, family).withColumnRenamed("ID_WIKIDATA", "ID_ITEM"), "ID_ITEM", "left_semi")


def award_count_by_family(stmts: DataFrame, facts: DataFrame, labels: DataFrame, family: str, subjects: Sequence[str] | None = None, person: str = "PERSON") -> DataFrame:
    """Awards of a family per subject; grouped by id, so equal names stay apart."""
    counts = _in_family(_of(_won(stmts), subjects), facts, family).groupBy("ID_WIKIDATA").agg(F.count(F.lit(1)).alias("AWARDS"))
    return counts.join(labels_of(labels, [person], "ID_WIKIDATA", "LABEL"), "ID_WIKIDATA")


def award_detail_by_family(stmts: DataFrame, quals: DataFrame, facts: DataFrame, labels: DataFrame, family: str, subjects: Sequence[str] | None = None, person: str = "PERSON") -> DataFrame:
    won = _in_family(_of(_won(stmts), subjects), facts, family).select("ID_STATEMENT", "ID_WIKIDATA", "ID_ITEM")
    dated = qualifier_pivot(won, quals, {"YEAR": (POINT_IN_TIME, "YEAR_VALUE")})
    return (
        dated.join(labels_of(labels, [person], "ID_WIKIDATA", "LABEL"), "ID_WIKIDATA")
        .join(labels_of(labels, ["ITEM"], "ID_ITEM", "_award"), "ID_ITEM", "left")
        .select("ID_WIKIDATA", "LABEL", F.coalesce("_award", "ID_ITEM").alias("CATEGORY"), "YEAR")
    )


def award_count_by_label(stmts: DataFrame, labels: DataFrame, prefix: str, person: str = "PERSON") -> DataFrame:
    """Fallback without a hierarchy: awards whose label starts with ``prefix``."""
    named = labels_of(labels, ["ITEM"], "ID_ITEM", "_award").filter(F.col("_award").startswith(prefix)).select("ID_ITEM")
    counts = _won(stmts).join(named, "ID_ITEM", "left_semi").groupBy("ID_WIKIDATA").agg(F.count(F.lit(1)).alias("AWARDS"))
    return counts.join(labels_of(labels, [person], "ID_WIKIDATA", "LABEL"), "ID_WIKIDATA")


def silent_category_probe(stmts: DataFrame, labels: DataFrame, categories: DataFrame, parent: Column) -> DataFrame:
    """Label and statement count of each category, beside its parent's statement count."""
    sizes = stmts.groupBy("ID_WIKIDATA").agg(F.count(F.lit(1)).alias("_n"))
    own = sizes.select(F.col("ID_WIKIDATA").alias("CATEGORY"), F.col("_n").alias("STATEMENTS"))
    up = sizes.select(F.col("ID_WIKIDATA").alias("PARENT"), F.col("_n").alias("PARENT_STATEMENTS"))
    name = labels_of(labels, ["ITEM"], "CATEGORY", "LABEL")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (
        categories.withColumn("PARENT", parent)
        .join(own, "CATEGORY", "left")
        .join(up, "PARENT", "left")
        .join(name, "CATEGORY", "left")
        .select("CATEGORY", "PARENT", "LABEL", zero("STATEMENTS"), zero("PARENT_STATEMENTS"))
    )


def multi_winners(stmts: DataFrame, facts: DataFrame, labels: DataFrame, family: str, trait: str, trait_property: str = GENDER, minimum: int = 2, top: int = 40, person: str = "PERSON") -> DataFrame:
    """Subjects with a trait and at least ``minimum`` awards of a family."""
    won = _in_family(_won(stmts), facts, family).join(members_of(facts, trait, trait_property), "ID_WIKIDATA", "left_semi")
    counts = won.groupBy("ID_WIKIDATA").agg(F.count(F.lit(1)).alias("AWARDS")).filter(F.col("AWARDS") >= minimum)
    return (
        counts.join(labels_of(labels, [person], "ID_WIKIDATA", "LABEL"), "ID_WIKIDATA", "left")
        .orderBy(F.desc("AWARDS"), "ID_WIKIDATA")
        .limit(top)
    )


def laureates(stmts: DataFrame, quals: DataFrame, labels: DataFrame, award: str, top: int = 40) -> DataFrame:
    """Who received an award, latest first; films, persons and items may."""
    won = _won(stmts).filter(F.col("ID_ITEM") == award).select("ID_STATEMENT", "ID_WIKIDATA")
    dated = qualifier_pivot(won, qualifiers_of(quals, won, [POINT_IN_TIME]), {"YEAR": (POINT_IN_TIME, "YEAR_VALUE")})
    named = dated.join(labels_of(labels, ["MOVIE", "PERSON", "ITEM"], "ID_WIKIDATA", "_label"), "ID_WIKIDATA", "left")
    return (
        named.select("ID_STATEMENT", "YEAR", F.coalesce("_label", "ID_WIKIDATA").alias("LAUREATE"))
        .orderBy(F.desc_nulls_last("YEAR"), "ID_STATEMENT")
        .limit(top)
    )


def awards_around_work(stmts: DataFrame, quals: DataFrame, labels: DataFrame, work: str, received: str = "P166") -> DataFrame:
    """Awards a work received itself, and awards others received for it."""
    own = _won(stmts, received).filter(F.col("ID_WIKIDATA") == work).select("ID_STATEMENT", "ID_ITEM", "ID_WIKIDATA")
    own = own.withColumn("SENSE", F.lit("received by the work")).withColumn("_who", F.lit(None).cast("string"))
    credited = quals.filter((F.col("ID_QUALIFIER_PROPERTY") == FOR_WORK) & (F.col("ID_ITEM") == work)).select("ID_STATEMENT")
    others = _won(stmts, received).select("ID_STATEMENT", "ID_ITEM", "ID_WIKIDATA").join(credited, "ID_STATEMENT")
    others = others.withColumn("SENSE", F.lit("received for the work")).withColumn("_who", F.col("ID_WIKIDATA"))
    both = own.unionByName(others)
    both = qualifier_pivot(both, qualifiers_of(quals, both, [POINT_IN_TIME]), {"YEAR": (POINT_IN_TIME, "YEAR_VALUE")})
    named = both.join(labels_of(labels, ["ITEM"], "ID_ITEM", "_award"), "ID_ITEM", "left")
    named = left_lookup(named, labels_of(labels, ["PERSON"], "_who", "_name"), "_who")
    return named.select("SENSE", F.coalesce("_award", "ID_ITEM").alias("AWARD"), "YEAR", F.coalesce("_name", "_who").alias("LAUREATE"))


def nominated_not_won(stmts: DataFrame, quals: DataFrame, labels: DataFrame, subjects: Sequence[str] | None = None, work: str = "MOVIE") -> DataFrame:
    """Nominations without a matching award, with year and work."""
    won = _won(stmts).select("ID_WIKIDATA", "ID_ITEM")
    lost = _of(_won(stmts, NOMINATION), subjects).select("ID_STATEMENT", "ID_WIKIDATA", "ID_ITEM")
    lost = lost.join(won, ["ID_WIKIDATA", "ID_ITEM"], "left_anti")
    wide = qualifier_pivot(lost, quals, {"YEAR": (POINT_IN_TIME, "YEAR_VALUE"), "_work": (FOR_WORK, "ID_ITEM")})
    named = wide.join(labels_of(labels, ["ITEM"], "ID_ITEM", "_award"), "ID_ITEM", "left")
    named = left_lookup(named, labels_of(labels, [work], "_work", "_work_label"), "_work")
    return named.select("ID_WIKIDATA", F.coalesce("_award", "ID_ITEM").alias("NOMINATED_FOR"), "YEAR", F.coalesce("_work_label", "_work").alias("FOR_WORK"))


def recent_awards(stmts: DataFrame, quals: DataFrame, labels: DataFrame, first: int, last: int, top: int, work: str = "MOVIE", person: str = "PERSON") -> DataFrame:
    """Complete award rows (labelled laureate and award, year, labelled work) of some years."""
    year = quals.filter((F.col("ID_QUALIFIER_PROPERTY") == POINT_IN_TIME) & F.col("YEAR_VALUE").between(first, last))
    year = year.select("ID_STATEMENT", F.col("YEAR_VALUE").alias("YEAR"))
    works = quals.filter(F.col("ID_QUALIFIER_PROPERTY") == FOR_WORK).select("ID_STATEMENT", F.col("ID_ITEM").alias("_work"))
    return (
        _won(stmts).select("ID_STATEMENT", "ID_WIKIDATA", "ID_ITEM")
        .join(year, "ID_STATEMENT")
        .join(works, "ID_STATEMENT")
        .join(labels_of(labels, ["ITEM"], "ID_ITEM", "AWARD"), "ID_ITEM")
        .join(labels_of(labels, [work], "_work", "FOR_WORK"), "_work")
        .join(labels_of(labels, [person], "ID_WIKIDATA", "LAUREATE"), "ID_WIKIDATA")
        .select("ID_STATEMENT", "LAUREATE", "AWARD", "YEAR", "FOR_WORK")
        .orderBy(F.desc("YEAR"), "ID_STATEMENT")
        .limit(top)
    )


def entity_facts(stmts: DataFrame, labels: DataFrame, subjects: Sequence[str] | None = None) -> DataFrame:
    """Facts with their typed value as text and the label of an item value.

    ``stmts`` carries the wide value columns ID_ITEM and VALUE_TEXT.
    """
    live = _of(stmts, subjects).filter((F.coalesce("DELETED", F.lit(0)) == 0) & (F.col("RANK").isNull() | (F.col("RANK") != "deprecated")))
    return left_lookup(live, labels_of(labels, ["ITEM", "MOVIE", "PERSON", "SERIE"], "ID_ITEM", "TARGET_LABEL"), "ID_ITEM").select(
        "ID_WIKIDATA", "ID_PROPERTY", "VALUE_TYPE", "VALUE_TEXT", "TARGET_LABEL", "RANK"
    )
