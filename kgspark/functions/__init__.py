"""Column expressions: identities, predicates and text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with costly columns that are computed exactly once per row.

    The optimizer copies an expression into every filter and projection above it,
    which for a JSON parse means parsing again. A generator over a one-element array
    is not copied, costs no shuffle and stays inside generated code.
    """
    row = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(row))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a join side that grows with the data: merged, never broadcast.

    Before a join's inputs have run, Spark guesses their size from files. Compression, expanded lists and texts built per
    row make that guess far too small, and adaptive execution does not take a broadcast back: the rows would go through
    the driver.
    """
    return df.hint("merge")


def n(name: str = "N") -> Column:
    """Row count of a group. A function, since columns need a running session."""
    return F.count(F.lit(1)).alias(name)
