"""Staging files: which file feeds which table, and how its rows are read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


@dataclass(frozen=True)
class StagingSpec:
    folder: str  # pass folder the file lies in
    file: str
    table: str


_ENTITIES = ("MOVIE", "SERIE", "PERSON", "SEASON", "EPISODE", "CHARACTER")
_VALUES = ("ITEM", "STRING", "EXTERNAL_ID", "MEDIA", "TIME", "QUANTITY")


def _spec(folder: str, table: str, file: str | None = None) -> StagingSpec:
    return StagingSpec(folder, f"{file or table}.jsonl", f"STG_{table}")


# 28 specs. Persons, statements and three value tables are fed by two passes.
STAGING_SPECS = (
    _spec("pass1", "PROPERTY_METADATA"),
    _spec("pass1", "SUBCLASS", "subclass_edges"),
    *[_spec("pass2", t) for t in _ENTITIES],
    _spec("item_cache", "PERSON"),
    _spec("item_cache", "ITEM"),
    _spec("pass2", "STATEMENT"),
    _spec("item_cache", "STATEMENT"),
    *[_spec("pass2", f"{t}_VALUE") for t in _VALUES],
    *[_spec("item_cache", f"{t}_VALUE") for t in ("ITEM", "EXTERNAL_ID", "TIME")],
    _spec("pass2", "STATEMENT_QUALIFIER"),
    *[_spec("pass2", f"QUALIFIER_{t}_VALUE") for t in _VALUES],
)


def select_specs(only: Sequence[str] | None = None) -> tuple[StagingSpec, ...]:
    """Specs of the given tables (with or without the STG_ prefix), or all."""
    if not only:
        return STAGING_SPECS
    wanted = {t if t.startswith("STG_") else f"STG_{t}" for t in only}
    return tuple(s for s in STAGING_SPECS if s.table in wanted)


def as_staging(rows: DataFrame, batch: str, source: object, row: Column | None = None) -> DataFrame:
    """Rows with the staging columns; nested values become compact JSON text.

    ``ID_STG_ROW`` orders the rows: ``row`` if given, else the place in the frame's partitions.
    """
    nested = (T.StructType, T.ArrayType, T.MapType)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in rows.schema.fields
    ]
    return rows.select(
        *flat,
        F.lit(batch).alias("IMPORT_BATCH_ID"),
        (source if not isinstance(source, str) else F.lit(source)).alias("SOURCE_FILE"),
        F.lit("NEW").alias("ROW_STATUS"),
        F.lit(None).cast("string").alias("ERROR_MESSAGE"),
        (F.monotonically_increasing_id() if row is None else row).alias("ID_STG_ROW"),
    )


def read_staging_jsonl(spark: SparkSession, root: str, spec: StagingSpec, schema: T.StructType, batch: str, skip_missing: bool = False) -> DataFrame | None:
    """Rows of one staging file, tagged with batch, file and status NEW.

    Blank lines are ignored; a line that is no JSON object stops the load.
    """
    path = f"{root}/{spec.folder}/{spec.file}"
    try:
        rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException:
        if skip_missing:
            return None
        raise
    located = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    # File, split and place in the split: the same order in every read.
    place = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("n"))
    return as_staging(located, batch, F.col("_file"), place).drop("_file", "_block")


def read_staging_table(spark: SparkSession, root: str, table: str, schema: T.StructType, batch: str) -> DataFrame:
    """All files feeding one staging table, stacked; at least one must exist."""
    out = None
    for spec in select_specs([table]):
        part = read_staging_jsonl(spark, root, spec, schema, batch, skip_missing=True)
        if part is not None:
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(f"no staging file for {table} under {root}")
    return out
