"""Constraint checks as violation tables, and the gates between load steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ValidationError(RuntimeError):
    """A gate between two steps does not hold."""


def stack_keys(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(key, CHILD_TABLE) over all typed tables."""
    out = None
    for kind, table in tables.items():
        part = table.select(key, F.lit(kind).alias("CHILD_TABLE"))
        out = part if out is None else out.union(part)
    return out


def check_parent_type(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children without a parent, or whose parent carries another type.

    ``children`` is (key, CHILD_TABLE) from ``stack_keys``: one join covers all tables.
    """
    known = parents.select(key, F.col("VALUE_TYPE").alias("_type"), F.lit(1).alias("_p"))
    joined = children.join(known, key, "left")
    problem = F.when(F.col("_p").isNull(), "parent missing").when(
        ~F.col("_type").eqNullSafe(F.col("CHILD_TABLE")), "parent has another type"
    )
    return joined.withColumn("PROBLEM", problem).filter(F.col("PROBLEM").isNotNull()).select(key, "CHILD_TABLE", "PROBLEM")


def check_single_child(children: DataFrame, key: str) -> DataFrame:
    """Parents with a value in more than one typed table."""
    return (
        children.groupBy(key)
        .agg(F.count_distinct("CHILD_TABLE").alias("TABLES"))
        .filter(F.col("TABLES") > 1)
    )


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key is set but unknown to the parent."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


#: The relations of the data model, as child column and parent column by tables.
FOREIGN_KEYS = {
    "statement to property": ("STATEMENT", "ID_PROPERTY", "PROPERTY_METADATA", "ID_PROPERTY"),
    "value to statement": ("VALUE", "ID_STATEMENT", "STATEMENT", "ID_STATEMENT"),
    "qualifier to statement": ("STATEMENT_QUALIFIER", "ID_STATEMENT", "STATEMENT", "ID_STATEMENT"),
    "qualifier to property": ("STATEMENT_QUALIFIER", "ID_QUALIFIER_PROPERTY", "PROPERTY_METADATA", "ID_PROPERTY"),
    "media to statement": ("MEDIA_RESOURCE", "ID_STATEMENT", "STATEMENT", "ID_STATEMENT"),
    "url to resource": ("MEDIA_RESOURCE_URL", "ID_MEDIA_RESOURCE", "MEDIA_RESOURCE", "ID_MEDIA_RESOURCE"),
}


def check_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(FK, N): rows without their parent, by relation, for the relations whose tables are given."""
    out = None
    for name, (child, column, parent, parent_column) in FOREIGN_KEYS.items():
        if child in tables and parent in tables:
            lost = check_foreign_key(tables[child], column, tables[parent], parent_column)
            part = lost.agg(F.count(F.lit(1)).alias("N")).select(F.lit(name).alias("FK"), "N")
            out = part if out is None else out.union(part)
    if out is None:
        raise ValueError("no relation has both its tables")
    return out


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values used more than once; keys with a NULL part never clash."""
    complete = df.dropna(subset=list(keys))
    return complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("N")).filter(F.col("N") > 1)


def orphan_statements(statements: DataFrame, entity_ids: DataFrame) -> DataFrame:
    """Statements whose subject is in no entity table."""
    known = entity_ids.select(F.col(entity_ids.columns[0]).alias("ID_WIKIDATA")).distinct()
    return statements.join(known, "ID_WIKIDATA", "left_anti")


def gate(counts: DataFrame, rules: Mapping[str, tuple[str, int]]) -> DataFrame:
    """One row per rule: metric, value, rule and whether it holds.

    ``counts`` is a one-row frame of counters; a rule is ('>=', n) or ('==', n).
    """
    rows = [
        F.struct(
            F.lit(name).alias("METRIC"),
            F.col(name).cast("bigint").alias("VALUE"),
            F.lit(f"{op} {n}").alias("RULE"),
            (F.col(name) >= n if op == ">=" else F.col(name) == n).alias("OK"),
        )
        for name, (op, n) in rules.items()
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def enforce(verdicts: DataFrame) -> None:
    """Raise when any rule of a gate fails (verdicts are one row per rule)."""
    failed = [f"{r.METRIC}={r.VALUE} (needs {r.RULE})" for r in verdicts.filter(~F.col("OK")).collect()]
    if failed:
        raise ValidationError("; ".join(failed))


def pass_gate(summary: DataFrame) -> DataFrame:
    """No parse errors, some core entities, some statements."""
    return gate(summary, {"PARSE_ERRORS": ("==", 0), "CORE_ENTITIES": (">=", 1), "STATEMENTS": (">=", 1)})


def staging_gate(staging: DataFrame) -> DataFrame:
    """Rows are staged and every one carries a batch."""
    counts = staging.agg(
        F.count(F.lit(1)).alias("STAGED"), F.count_if(F.col("IMPORT_BATCH_ID").isNull()).alias("NULL_BATCH")
    )
    return gate(counts, {"STAGED": (">=", 1), "NULL_BATCH": ("==", 0)})


def target_gate(statements: DataFrame, staging: DataFrame, batch: str) -> DataFrame:
    """Statements exist and the batch has loaded rows."""
    loaded = staging.filter((F.col("IMPORT_BATCH_ID") == batch) & (F.col("ROW_STATUS") == "LOADED"))
    both = statements.select(F.lit(1).alias("_s")).union(loaded.select(F.lit(0).alias("_s")))
    counts = both.agg(
        F.count_if(F.col("_s") == 1).alias("STATEMENTS"), F.count_if(F.col("_s") == 0).alias("LOADED_ROWS")
    )
    return gate(counts, {"STATEMENTS": (">=", 1), "LOADED_ROWS": (">=", 1)})


def media_gate(resources: DataFrame, urls: DataFrame) -> DataFrame:
    """Resources and URLs per platform; a platform without URLs fails."""
    per_resource = urls.groupBy("ID_MEDIA_RESOURCE").agg(F.count(F.lit(1)).alias("_n"))
    return (
        resources.join(per_resource, "ID_MEDIA_RESOURCE", "left")
        .groupBy("SOURCE_PLATFORM")
        .agg(F.count(F.lit(1)).alias("RESOURCES"), F.sum(F.coalesce("_n", F.lit(0))).alias("URLS"))
        .withColumn("OK", F.col("URLS") > 0)
    )


def run_summary(good: DataFrame, bad: DataFrame, core: DataFrame | None = None, statements: DataFrame | None = None, qualifiers: DataFrame | None = None) -> DataFrame:
    """Counters of one dump, in one row: entities seen, items, properties and parse errors.

    With the frames of a run also what ``pass_gate`` asks for: core entities, by class too
    (``CORE_BY_CLASS``), statements, by type of value (``VALUES_BY_TYPE``), and qualifiers.
    """
    more = []
    if core is not None:
        by_class = core.groupBy("ENTITY_CLASS").agg(F.count(F.lit(1)).alias("n"))
        more.append(by_class.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("CORE_ENTITIES"), _counted("ENTITY_CLASS").alias("CORE_BY_CLASS")))
    if statements is not None:
        by_type = statements.groupBy("VALUE_TYPE").agg(F.count(F.lit(1)).alias("n"))
        more.append(by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("STATEMENTS"), _counted("VALUE_TYPE").alias("VALUES_BY_TYPE")))
    if qualifiers is not None:
        more.append(qualifiers.agg(F.count(F.lit(1)).alias("QUALIFIERS")))
    out = _lines_summary(good, bad)
    for part in more:  # one row each
        out = out.withColumn("_one", F.lit(1)).join(part.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return out


def _counted(name: str) -> Column:
    """Map from name to count; there are few names."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(name), F.lit("")).alias("k"), "n"))))


def _lines_summary(good: DataFrame, bad: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return lines_summary(good.select("type", none.alias("BAD_LINE")).union(bad.select(none.alias("type"), F.col("value").alias("BAD_LINE"))))


def lines_summary(marked: DataFrame) -> DataFrame:
    """Counters of the lines of ``dump.parse_marked``, good and bad in one pass."""
    is_bad = F.col("BAD_LINE").isNotNull()
    return marked.agg(
        F.count_if(~is_bad).alias("ENTITIES_SEEN"),
        F.count_if(~is_bad & (F.col("type") == "item")).alias("ITEMS_SEEN"),
        F.count_if(~is_bad & (F.col("type") == "property")).alias("PROPERTIES_SEEN"),
        F.count_if(is_bad).alias("PARSE_ERRORS"),
    )
