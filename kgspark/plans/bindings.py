"""Query-result bindings to the flat first-generation tables.

``rows`` come from ``sources.payloads.bindings``: one row per binding, ordered by the
columns named in ``order``. Where each binding used to be written over the one before
it, the last one (by that order) wins; values a binding lacks never overwrite.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions.text import clean_label, filled
from kgspark.operators import merge
from kgspark.operators.aggregates import pipe_lists
from kgspark.operators.ranking import first_non_empty
from kgspark.sources.payloads import entity_of

_ISO_SECOND = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"


def day_of(stamp: Column) -> Column:
    """Date text of a full UTC stamp; any other form gives NULL."""
    ok = F.coalesce(stamp.rlike(_ISO_SECOND), F.lit(False))
    return F.date_format(F.try_to_timestamp(F.when(ok, stamp), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), "yyyy-MM-dd")


def _whole(number: Column) -> Column:
    return F.coalesce(F.btrim(number).try_cast("int"), F.lit(0))


def _last(rows: DataFrame, order: Sequence[str], columns: dict[str, Column], keep: dict[str, Column]) -> DataFrame:
    """Last binding per item; ``keep`` columns take the last value that is there."""
    prepared = rows.select(entity_of(F.col("item")).alias("ID_WIKIDATA"), F.struct(*order).alias("_o"), *[c.alias(n) for n, c in {**columns, **keep}.items()])
    aggs = [F.max_by(n, "_o").alias(n) for n in columns]
    aggs += [F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_o"))).alias(n) for n in keep]
    return prepared.groupBy("ID_WIKIDATA").agg(*aggs)


def _text(name: str, limit: int | None = None) -> Column:
    value = F.coalesce(F.col(name), F.lit(""))
    return F.left(value, F.lit(limit)) if limit else value


def v1_persons(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return _last(
        rows, order,
        {
            "ID_PERSON": _whole(F.col("tmdbID")), "ID_IMDB": _text("imdbID", 10), "NAME": clean_label(_text("itemLabel")),
            "INSTANCE_OF": F.coalesce(entity_of(F.col("instanceOf")), F.lit("")),
        },
        {"BIRTHDAY": day_of(F.col("birthDate")), "DEATHDAY": day_of(F.col("deathDate"))},
    )


def v1_movies(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return _last(
        rows, order,
        {
            "ID_MOVIE": _whole(F.col("tmdbID")), "ID_IMDB": _text("imdbID", 10), "TITLE": clean_label(_text("itemLabel")), "ID_CRITERION": _whole(F.col("criterionFilmID")),
            "ID_CRITERION_SPINE": _whole(F.col("criterionSpine")), "INSTANCE_OF": F.coalesce(entity_of(F.col("type")), F.lit("")),
        },
        {"PLEX_MEDIA_KEY": F.nullif(F.col("plexMediaKey"), F.lit("")), "DAT_RELEASE": day_of(F.col("releaseDate"))},
    )


def v1_series(rows: DataFrame, order: Sequence[str], id_variable: str = "tmdbID") -> DataFrame:
    """Series; ``id_variable`` names the binding that holds the catalogue's series id."""
    return _last(
        rows, order,
        {
            "ID_SERIE": _whole(F.col(id_variable)), "ID_IMDB": _text("imdbID", 10), "TITLE": clean_label(_text("itemLabel")),
            "INSTANCE_OF": F.coalesce(entity_of(F.col("type")), F.lit("")),
        },
        {"PLEX_MEDIA_KEY": F.nullif(F.col("plexMediaKey"), F.lit("")), "DAT_START": day_of(F.col("startTime")), "DAT_END": day_of(F.col("endTime"))},
    )


# Multi-valued variables and the property of their triples.
MULTI_VALUES = {"genres": "P136", "color": "P462"}


def v1_multi_values(rows: DataFrame) -> DataFrame:
    """Distinct (subject, property, item) triples of the multi-valued variables."""
    out = None
    for name, prop in MULTI_VALUES.items():
        part = rows.filter(filled(F.col(name))).select(
            entity_of(F.col("item")).alias("ID_WIKIDATA"), F.lit(prop).alias("ID_PROPERTY"), entity_of(F.col(name)).alias("ID_ITEM")
        )
        out = part if out is None else out.union(part)
    return out.distinct()


def v1_replace_multi_values(triples: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored triples after adding the listed ones and dropping those no longer listed.

    A subject seen without any genre or colour loses all of them.
    """
    keys = ["ID_WIKIDATA", "ID_PROPERTY", "ID_ITEM"]
    listed = v1_multi_values(rows)
    owners = rows.select(entity_of(F.col("item")).alias("ID_WIKIDATA")).distinct()
    mine = F.col("ID_PROPERTY").isin(*MULTI_VALUES.values())
    kept = merge.prune_absent(triples.filter(mine).select(*keys), listed, owners, "ID_WIKIDATA", ["ID_PROPERTY", "ID_ITEM"], "delete")
    return triples.filter(~mine).select(*keys).union(kept).union(listed).distinct()


def v1_properties(rows: DataFrame) -> DataFrame:
    """Distinct item-valued triples of a property query (item, property, value)."""
    return rows.select(
        entity_of(F.col("item")).alias("ID_WIKIDATA"), entity_of(F.col("property")).alias("ID_PROPERTY"), entity_of(F.col("value")).alias("ID_ITEM")
    ).filter(F.col("ID_ITEM").rlike(r"^Q[0-9]+$")).distinct()


def v1_aliases(rows: DataFrame) -> DataFrame:
    """Distinct aliases per item and language as a pipe list, in order of appearance."""
    keyed = rows.filter(filled(F.col("itemAlias"))).withColumn("_k", F.struct(entity_of(F.col("item")).alias("ID_WIKIDATA"), F.col("lang").alias("LANG")))
    lists = pipe_lists(keyed, "_k", "itemAlias", "pos")
    return lists.select("_k.ID_WIKIDATA", "_k.LANG", F.col("LIST").alias("ALIASES"))


def v1_items(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per item and language: first label and description, last class, and the aliases as a pipe list ('' without any)."""
    prepared = rows.select(
        entity_of(F.col("item")).alias("ID_WIKIDATA"), F.col("lang").alias("LANG"), *order,
        clean_label(F.col("itemLabel")).alias("LABEL"), F.col("itemDescription").alias("DESCRIPTION"), entity_of(F.col("instanceOf")).alias("INSTANCE_OF"),
    )
    texts = first_non_empty(prepared, ["ID_WIKIDATA", "LANG"], order, ["LABEL", "DESCRIPTION"])
    has = F.when(filled(F.col("INSTANCE_OF")), F.struct(*order))
    classes = prepared.groupBy("ID_WIKIDATA", "LANG").agg(F.max_by("INSTANCE_OF", has).alias("INSTANCE_OF"))
    named = texts.join(classes, ["ID_WIKIDATA", "LANG"])
    if "itemAlias" in rows.columns:
        named = named.join(v1_aliases(rows), ["ID_WIKIDATA", "LANG"], "left")
    else:
        named = named.withColumn("ALIASES", F.lit(""))
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("LABEL", "DESCRIPTION", "ALIASES", "INSTANCE_OF")]
    return named.select("ID_WIKIDATA", "LANG", *blank)


def v1_unlabelled_items(triples: DataFrame, labelled: Sequence[DataFrame], cursor: str, size: int = 5000) -> DataFrame:
    """Next page of items used in triples that carry a name in none of the tables.

    Each of ``labelled`` is (id, name); their named ids are stacked and joined once.
    """
    named = None
    for t in labelled:
        part = t.filter(filled(F.col(t.columns[1]))).select(F.col(t.columns[0]).alias("ID_ITEM"))
        named = part if named is None else named.union(part)
    used = triples.filter(F.col("ID_ITEM").startswith("Q") & (F.col("ID_ITEM") > cursor)).select("ID_ITEM").distinct()
    return used.join(named, "ID_ITEM", "left_anti").orderBy("ID_ITEM").limit(size)


def v1_fix_class(items: DataFrame, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Fill an empty class from (item, class) pairs; the last pair of an item counts."""
    pairs = rows.select(entity_of(F.col("item")).alias("ID_WIKIDATA"), entity_of(F.col("instanceOf")).alias("INSTANCE_OF"), F.struct(*order).alias("_o"))
    last = pairs.filter(filled(F.col("INSTANCE_OF"))).groupBy("ID_WIKIDATA").agg(F.max_by("INSTANCE_OF", "_o").alias("INSTANCE_OF"))
    return merge.fill_empty(items, last, ["ID_WIKIDATA"], ["INSTANCE_OF"])


def v1_promote_items(items: DataFrame, target: DataFrame, classes: Sequence[str], columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(next items, next target): items of some classes become entities of their own table.

    The English row supplies the values (``columns`` maps item to target columns); it is
    inserted or fills blanks, and all language rows of the id leave the item table.
    """
    chosen = items.filter((F.col("LANG") == "en") & F.col("INSTANCE_OF").isin(*classes))
    source = chosen.select("ID_WIKIDATA", *[F.col(a).alias(b) for a, b in columns.items()]).dropDuplicates(["ID_WIKIDATA"])
    filled_ = merge.fill_empty(target, source, ["ID_WIKIDATA"], list(columns.values()))
    fresh = source.join(target.select("ID_WIKIDATA"), "ID_WIKIDATA", "left_anti")
    left = items.join(source.select("ID_WIKIDATA"), "ID_WIKIDATA", "left_anti")
    return left, filled_.unionByName(fresh, allowMissingColumns=True).select(*target.columns)
