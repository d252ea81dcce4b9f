"""Full refresh: dump text to scope, statements, cached labels and loaded tables.

An instance may precede its class in the file, so scope needs the whole class graph
first. The first pass over the text keeps a narrow row per entity. The second and the
third parse only what the id gate lets through: the entities in scope, and those that
their statements mention.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions import shuffled
from kgspark.operators import checks, claims, merge, scope
from kgspark.session import cut
from kgspark.sources import dump
from kgspark.sources.staging import as_staging

ENTITY_COLUMNS = ("ID_WIKIDATA", "LABEL_EN", "DESCRIPTION_EN", "LABELS", "DESCRIPTIONS")


@dataclass
class Refresh:
    """Outputs of one run over a dump."""

    entities: DataFrame  # in-scope entities with ENTITY_CLASS, plus cached ones
    statements: DataFrame
    qualifiers: DataFrame
    properties: DataFrame
    subclass: DataFrame
    core: DataFrame
    candidates: DataFrame
    referenced_items: DataFrame
    referenced_persons: DataFrame
    classes: DataFrame  # (ROOT_TYPE, QID)
    summary: DataFrame
    bad_lines: DataFrame
    extra: dict = field(default_factory=dict)


def refresh(lines: DataFrame, roots: Mapping[str, tuple[str, ...]] = scope.ROOTS, exact_ids: bool = True) -> Refresh:
    """All three passes as one job. ``lines`` is the cleaned dump text."""
    spark = lines.sparkSession
    # First pass: a narrow row of every line.
    marked = dump.parse_marked(lines, ("type", "id", "claims"))
    narrow, bad = dump.split_marked(cut(scope.scope_columns(marked, "BAD_LINE"), "scope"))

    # Scope: the closure of the root classes decides which entities are core.
    edges = cut(scope.subclass_edges(narrow), "subclass")
    classes = cut(scope.closure_multi(edges, scope.root_frame(spark, roots)), "classes")
    classified = cut(scope.classify_sidecar(scope.p31_sidecar(narrow), classes), "classified")
    core, candidates = scope.core_and_candidates(classified)

    # Second pass: everything a core entity states, and the properties.
    parsed = gated_entities(lines, core)
    items = parsed.filter(F.col("type") == "item")
    in_scope = items.join(shuffled(core.select(F.col("ID_WIKIDATA").alias("id"), "ENTITY_CLASS")), "id")
    stmts = cut(claims.statements(claims.explode_claims(in_scope, exact_ids=exact_ids)), "statements")
    quals = cut(claims.qualifiers(stmts, exact_ids), "qualifiers")

    # Third pass, the label cache: what the statements mention but the core does not contain.
    used = scope.referenced_items(stmts.select("v.ID_ITEM"), quals.select("v.ID_ITEM"))
    persons = scope.referenced_persons(stmts.select("v.ID_ITEM"), candidates)
    used, persons = cut(used, "used"), cut(persons, "persons")
    mentioned = gated_entities(lines, used.select("ID_ITEM").union(persons.select("ID_ITEM"))).filter(F.col("type") == "item")
    cached = scope.item_cache_rows(mentioned.withColumn("ID_WIKIDATA", F.col("id")), core, used, persons)
    cached_stmts = claims.cached_claims(cached, exact_ids)

    # Referenced persons that are not core are stored as persons, the rest as items.
    tables = F.create_map(*[F.lit(x) for pair in scope.ENTITY_TABLE.items() for x in pair])
    base = dump.entity_row(in_scope, F.try_element_at(tables, F.col("ENTITY_CLASS")).alias("TARGET_TABLE"))
    label_rows = dump.entity_row(cached.drop("ID_WIKIDATA"), "TARGET_TABLE")
    return Refresh(
        entities=base.unionByName(label_rows),
        statements=stmts.unionByName(cached_stmts.withColumn("qualifiers", F.lit(None).cast("map<string,string>"))),
        qualifiers=quals,
        properties=claims.property_metadata(parsed),
        subclass=edges,
        core=core,
        candidates=candidates,
        referenced_items=used.withColumnRenamed("ID_ITEM", "ID_WIKIDATA"),
        referenced_persons=persons.withColumnRenamed("ID_ITEM", "ID_WIKIDATA"),
        classes=classes,
        summary=checks.run_summary(narrow, bad, core, stmts, quals),
        bad_lines=bad,
    )


def gated_entities(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """Parsed entities of the wanted ids and all properties: what is not wanted is dropped as text, before any parse."""
    good, _ = dump.split_marked(cut(dump.parse_marked(dump.idgate(lines, ids)), "gated"))
    return good


STATEMENT_POLICY = {"TIM_UPDATED": "now"}
ENTITY_POLICY = {"TIM_UPDATED": "now", "DAT_CREAT": "insert_only"}


def staged_tables(run: Refresh, batch: str, source: str = "refresh") -> dict[str, DataFrame]:
    """Staging rows of all target tables of a run, ready for ``full_load``."""
    stamped = lambda df: as_staging(df, batch, source)
    statement = run.statements.drop("v", "qualifiers")
    qualifier = run.qualifiers.drop("v")
    names = sorted({*scope.ENTITY_TABLE.values(), "ITEM"})
    return {
        "PROPERTY_METADATA": stamped(run.properties),
        "SUBCLASS": stamped(run.subclass),
        **{t: stamped(run.entities.filter(F.col("TARGET_TABLE") == t).drop("TARGET_TABLE")) for t in names},
        "STATEMENT": stamped(statement),
        **{f"{k.upper()}_VALUE": stamped(v) for k, v in claims.value_tables(run.statements).items()},
        "STATEMENT_QUALIFIER": stamped(qualifier),
        **{f"QUALIFIER_{k.upper()}_VALUE": stamped(v) for k, v in claims.value_tables(run.qualifiers, "ID_STATEMENT_QUALIFIER").items()},
    }


def empty_targets(staging: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Targets for a first load: the staged columns without the staging ones, and the audit columns."""
    stage_only = ("SOURCE_FILE", "ROW_STATUS", "ERROR_MESSAGE", "ID_STG_ROW")
    return {
        t: df.drop(*stage_only).withColumns({"TIM_UPDATED": F.lit(None).cast("timestamp"), "DAT_CREAT": F.lit(None).cast("timestamp")}).filter(F.lit(False))
        for t, df in staging.items()
    }


def load_table(target: DataFrame, staged: DataFrame, batch: str, keys: list[str], policy: Mapping[str, str], now: Column) -> tuple[DataFrame, DataFrame]:
    """(next target, next staging) after loading one table's batch."""
    fresh = merge.loadable(staged, batch)
    return merge.upsert(target, fresh, keys, policy, now, order=["ID_STG_ROW"]), merge.mark_loaded(staged, batch)


# Load order: parents before children, and stale siblings leave before new values enter.
KEYS = {
    "PROPERTY_METADATA": ["ID_PROPERTY"],
    **{t: ["ID_WIKIDATA"] for t in (*scope.ENTITY_TABLE.values(), "ITEM")},
    "STATEMENT": ["ID_STATEMENT"],
    **{f"{k.upper()}_VALUE": ["ID_STATEMENT"] for k in claims.VALUE_COLUMNS},
    "STATEMENT_QUALIFIER": ["ID_STATEMENT_QUALIFIER"],
    **{f"QUALIFIER_{k.upper()}_VALUE": ["ID_STATEMENT_QUALIFIER"] for k in claims.VALUE_COLUMNS},
    "MEDIA_RESOURCE": ["ID_MEDIA_RESOURCE"],
    "MEDIA_RESOURCE_URL": ["ID_MEDIA_RESOURCE_URL"],
    "MEDIA_RESOURCE_CHECK": ["ID_MEDIA_RESOURCE_CHECK"],
    "SUBCLASS": ["ID_CHILD", "ID_PARENT"],
}
QUALIFIERS_ONLY = tuple(t for t in KEYS if "QUALIFIER" in t)
SUBCLASS_ONLY = ("SUBCLASS",)


def full_load(targets: Mapping[str, DataFrame], staging: Mapping[str, DataFrame], batch: str, now: Column, only: tuple[str, ...] | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Load every staged table of a batch in order; returns (targets, staging).

    ``only`` restricts the load to a table subset (see QUALIFIERS_ONLY, SUBCLASS_ONLY).
    A subset with nothing to load is an error: the batch id is then probably wrong.
    """
    new_targets, new_staging = dict(targets), dict(staging)
    names = [t for t in KEYS if t in staging and t in targets and (only is None or t in only)]
    if only is not None and all(merge.loadable(staging[t], batch).isEmpty() for t in names):
        raise merge.GuardError(f"batch {batch} has no rows to load for {', '.join(only)}")
    for parent, key, prefix in (("STATEMENT", "ID_STATEMENT", ""), ("STATEMENT_QUALIFIER", "ID_STATEMENT_QUALIFIER", "QUALIFIER_")):
        if parent not in names:
            continue
        in_batch = staging[parent].filter(F.col("IMPORT_BATCH_ID") == batch)
        for kind in claims.VALUE_COLUMNS:
            table = f"{prefix}{kind.upper()}_VALUE"
            if table in new_targets:
                new_targets[table] = merge.purge_type_flips(new_targets[table], in_batch, kind, key)
    for name in names:
        policy = STATEMENT_POLICY if name.startswith("STATEMENT") else ENTITY_POLICY
        new_targets[name], new_staging[name] = load_table(new_targets[name], staging[name], batch, KEYS[name], policy, now)
    return new_targets, new_staging
