"""One run from dump text to pruned tables: scope, gate, claims, staging, load, media, gates, prune.

Every step is written before the next reads it, so a lost executor costs a stage, and a gate that fails stops the run before
the stored tables are touched: the caller swaps in the returned tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions.text import active
from kgspark.operators import checks, claims, media, merge, scope
from kgspark.plans.refresh import Refresh, empty_targets, full_load, refresh, staged_tables
from kgspark.session import cut

#: Tables whose live rows media are resolved for.
SERVED = ("MOVIE", "SERIE", "PERSON")


@dataclass
class Run:
    """The next state of all tables, what was staged, and the verdicts of the gates (STEP, METRIC, VALUE, RULE, OK)."""

    tables: dict[str, DataFrame]
    staging: dict[str, DataFrame]
    verdicts: DataFrame
    refresh: Refresh


def resolve_media(tables: Mapping[str, DataFrame], batch: str, served: Sequence[str] = SERVED) -> dict[str, DataFrame]:
    """The media tables after this batch's statements: resources by platform, their URLs, merged into what is stored.

    Existing rows are refreshed in the columns that resolution decides; ids are hashes of the unique keys, so a run over the
    same statements changes nothing else.
    """
    live = [tables[t].select("ID_WIKIDATA", *([F.col("DELETED")] if "DELETED" in tables[t].columns else [F.lit(0).alias("DELETED")])) for t in served if t in tables]
    ids = merge.union_rows(*live).filter(active(F.col("DELETED"))).select("ID_WIKIDATA")
    stmts, files, texts = tables["STATEMENT"], tables["MEDIA_VALUE"], tables["EXTERNAL_ID_VALUE"]
    built = {
        "commons": (media.commons_resources(stmts, files, ids, batch), media.commons_urls),
        "youtube": (media.youtube_resources(stmts, texts, ids, batch), media.youtube_urls),
        "internet_archive": (media.internet_archive_resources(stmts, texts, ids, batch), media.internet_archive_urls),
    }
    resources = cut(merge.union_rows(*[r for r, _ in built.values()]), "resources")
    urls = merge.union_rows(*[of(resources.filter(F.col("SOURCE_PLATFORM") == p)) for p, (_, of) in built.items()])
    old = lambda name, like: tables.get(name, like.limit(0))
    return {
        "MEDIA_RESOURCE": cut(media.merge_resolved(old("MEDIA_RESOURCE", resources), resources, "ID_MEDIA_RESOURCE", media.RESOURCE_UPDATES), "MEDIA_RESOURCE"),
        "MEDIA_RESOURCE_URL": cut(media.merge_resolved(old("MEDIA_RESOURCE_URL", urls), urls, "ID_MEDIA_RESOURCE_URL", media.URL_UPDATES), "MEDIA_RESOURCE_URL"),
    }


def pruned(tables: Mapping[str, DataFrame], batch: str) -> dict[str, DataFrame]:
    """All tables without what older batches left: entities stay, statements go with everything below them."""
    merge.prune_guard(tables["STATEMENT"], batch)
    names = {kind: f"{kind.upper()}_VALUE" for kind in claims.VALUE_COLUMNS}
    left = merge.prune_cascade(
        tables["STATEMENT"], {k: tables[n] for k, n in names.items()}, tables["STATEMENT_QUALIFIER"], {k: tables[f"QUALIFIER_{n}"] for k, n in names.items()},
        tables["MEDIA_RESOURCE"], tables["SUBCLASS"], batch, tables["MEDIA_RESOURCE_URL"], tables.get("MEDIA_RESOURCE_CHECK"),
    )
    out = dict(tables) | {"STATEMENT": left["statements"], "STATEMENT_QUALIFIER": left["qualifiers"], "MEDIA_RESOURCE": left["media"], "SUBCLASS": left["subclass"]}
    out |= {names[k]: df for k, df in left["values"].items()} | {f"QUALIFIER_{names[k]}": df for k, df in left["qualifier_values"].items()}
    out["MEDIA_RESOURCE_URL"] = left["media_urls"]
    if "media_checks" in left:
        out["MEDIA_RESOURCE_CHECK"] = left["media_checks"]
    return out


def run_batch(
    lines: DataFrame, tables: Mapping[str, DataFrame], batch: str, now: Column, roots: Mapping[str, tuple[str, ...]] = scope.ROOTS, exact_ids: bool = True
) -> Run:
    """Take one dump in as ``batch``. ``tables`` are the stored ones (none at the first run); raises where a gate fails."""
    run = refresh(lines, roots, exact_ids)
    verdicts = [checks.pass_gate(run.summary).withColumn("STEP", F.lit("pass"))]
    checks.enforce(verdicts[0])

    staging = {t: cut(df, f"staged-{t}") for t, df in staged_tables(run, batch).items()}
    verdicts.append(checks.staging_gate(staging["STATEMENT"]).withColumn("STEP", F.lit("staging")))
    checks.enforce(verdicts[-1])

    targets, staging = full_load(empty_targets(staging) | dict(tables), staging, batch, now)
    targets = {t: cut(df, t) for t, df in targets.items()}
    verdicts.append(checks.target_gate(targets["STATEMENT"], staging["STATEMENT"], batch).withColumn("STEP", F.lit("target")))
    checks.enforce(verdicts[-1])

    targets |= resolve_media(targets, batch)
    per_platform = checks.media_gate(targets["MEDIA_RESOURCE"], targets["MEDIA_RESOURCE_URL"])
    verdicts.append(
        per_platform.select(F.concat(F.lit("URLS of "), "SOURCE_PLATFORM").alias("METRIC"), F.col("URLS").alias("VALUE"), F.lit("> 0").alias("RULE"), "OK", F.lit("media").alias("STEP"))
    )
    checks.enforce(verdicts[-1])
    return Run(pruned(targets, batch), staging, merge.union_rows(*verdicts), run)
