"""Owner-scoped settlement: what becomes of an owner's stored rows once its source has answered, or has not.

A scope is an owner, or an owner in one language or kind. Its outcome is one of

* ``filled``: the answer lists rows. They replace the scope's rows, or join them, by the table's rule;
* ``empty``: the answer is valid and lists nothing. The scope is cleared, or kept where clearing would cost more than
  staleness;
* ``malformed`` and ``failed``: no usable answer. Nothing is touched.

Outcomes of all tables come in one frame, so one pass over the answers settles them all.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.functions import shuffled
from kgspark.operators.ranking import latest_wins

FILLED, EMPTY, MALFORMED, FAILED = "filled", "empty", "malformed", "failed"
OUTCOMES = "TABLE_NAME STRING, ID_OWNER BIGINT, SCOPE STRING, OUTCOME STRING"


@dataclass(frozen=True)
class Rule:
    """How one table follows its owners.

    ``scope`` names the owner column and, after it, at most one column that narrows it. ``keys`` tell the rows of a scope
    apart; without keys a filled scope is replaced whole. With keys an old row keeps the columns that the answer does not
    give, and goes if its ``listed_by`` columns (the keys, if unset) are listed no more, or stays with ``mode="merge"``.
    """

    scope: tuple[str, ...]
    keys: tuple[str, ...] = ()
    on_empty: str = "clear"
    mode: str = "prune"
    listed_by: tuple[str, ...] = ()


def one_outcome(outcomes: DataFrame) -> DataFrame:
    """One outcome per table and scope: if answers disagree, an unusable one protects the rows."""
    weight = F.when(F.col("OUTCOME").isin(FAILED, MALFORMED), 0).when(F.col("OUTCOME") == FILLED, 1).otherwise(2)
    return outcomes.groupBy("TABLE_NAME", "ID_OWNER", "SCOPE").agg(F.min_by("OUTCOME", F.struct(weight, "OUTCOME")).alias("OUTCOME"))


def settle_table(target: DataFrame, fresh: DataFrame, outcomes: DataFrame, rule: Rule) -> DataFrame:
    """The next rows of one table; ``outcomes`` are its own, one per scope. Rows whose owner is NULL stay."""
    scope = list(rule.scope)
    named = shuffled(outcomes.select(*[F.col(o).alias(c) for o, c in zip(("ID_OWNER", "SCOPE"), scope, strict=False)], "OUTCOME"))
    filled = named.filter(F.col("OUTCOME") == FILLED).drop("OUTCOME")
    fresh = fresh.join(filled, scope, "left_semi")
    if not rule.keys:
        rewritten = named.filter(F.col("OUTCOME").isin(FILLED, EMPTY) if rule.on_empty == "clear" else F.col("OUTCOME") == FILLED)
        return target.join(rewritten.drop("OUTCOME"), scope, "left_anti").unionByName(fresh, allowMissingColumns=True).select(*target.columns)
    full = [*scope, *[k for k in rule.keys if k not in scope]]
    order = [c for c in ("DISPLAY_ORDER",) if c in fresh.columns]
    fresh = latest_wins(fresh, full, order) if order else fresh.dropDuplicates(full)
    known = target.join(named, scope, "left")  # the scope's outcome beside every stored row
    untouched = F.col("OUTCOME").isNull() | F.col("OUTCOME").isin(FAILED, MALFORMED)
    if rule.on_empty == "keep" or rule.mode == "merge":
        untouched = untouched | (F.col("OUTCOME") == EMPTY)
    still = known.filter(untouched).drop("OUTCOME")
    met = known.filter(F.col("OUTCOME") == FILLED).drop("OUTCOME")
    gone = met.join(shuffled(fresh.select(*full)), full, "left_anti")
    if rule.mode == "merge":
        still = still.unionByName(gone)
    elif rule.listed_by:
        by = [*scope, *rule.listed_by]
        still = still.unionByName(gone.join(shuffled(fresh.select(*by).distinct()), by, "left_semi"))
    lacking = [c for c in target.columns if c not in fresh.columns]
    if lacking:
        fresh = fresh.join(shuffled(met.select(*full, *lacking)), full, "left")
    return still.unionByName(fresh.select(*target.columns))


def settle(tables: Mapping[str, DataFrame], fresh: Mapping[str, DataFrame], outcomes: DataFrame, rules: Mapping[str, Rule]) -> dict[str, DataFrame]:
    """Every table that has a rule, settled by the outcomes that bear its name. A table that is not stored yet begins empty."""
    out = {}
    for name, rule in rules.items():
        if name in fresh:
            mine = outcomes.filter(F.col("TABLE_NAME") == name).drop("TABLE_NAME")
            out[name] = settle_table(tables.get(name, fresh[name].limit(0)), fresh[name], mine, rule)
    return out


def stamped(table: DataFrame, outcomes: DataFrame, owner: str, columns: Mapping[str, str], now) -> DataFrame:
    """Completion times: ``columns`` maps a table's name to the column that tells when its owner was last answered.

    All columns of an owner are set by one join; an owner without a usable answer keeps its times.
    """
    known = {name: column for name, column in columns.items() if column in table.columns}
    if not known:
        return table
    answered = outcomes.filter(F.col("OUTCOME").isin(FILLED, EMPTY) & F.col("TABLE_NAME").isin(*known))
    flags = {c: [n for n, column in known.items() if column == c] for c in set(known.values())}
    done = answered.groupBy(F.col("ID_OWNER").alias(owner)).agg(*[F.bool_or(F.col("TABLE_NAME").isin(*names)).alias(f"_{c}") for c, names in sorted(flags.items())])
    joined = table.join(shuffled(done), owner, "left")
    return joined.select(*[F.when(F.col(f"_{c}"), now).otherwise(F.col(c)).alias(c) if c in flags else F.col(c) for c in table.columns])
