"""What the operators share: table readers and whole-row Arrow maps."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.session import cut

STRETCH = 4 << 20

__all__ = ["cut", "table", "text_or_empty", "keyed_text", "map_rows", "row_key", "ship"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    """The text, or the empty text where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def keyed_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns, ``id`` and ``text``: extra columns, whatever their names, go no further."""
    return df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))


def row_key(docs: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with keys that reading them again does not change: file and place, or a written number where rows are not those of files."""
    if _rows_of_files(docs):
        try:
            place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
            docs.select(place.alias("__row"))
            return docs, place
        except AnalysisException:  # no Parquet file, or a column of that name
            pass
    name = "__number" + "_" * max(map(len, docs.columns))  # no column has this name
    return cut(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), F.col(name)


def _rows_of_files(docs: DataFrame) -> bool:
    """Whether each row is a row of a file: the plan is a scan with projections and filters only."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.children().size() == 1 and plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.children().isEmpty()


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine find the library where the driver found it; a cluster gets it by --py-files."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [x for x in known.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])


def stretches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``STRETCH`` bytes and one row at least."""
    n = batch.num_rows
    step = max(1, min(n, STRETCH * n // max(1, batch.nbytes)))
    for at in range(0, n, step):
        yield batch.slice(at, step)


def map_rows(df: DataFrame, rows: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str) -> DataFrame:
    """Apply ``rows()`` to Arrow batches as lists of Python values by column.

    ``rows`` is called once a task, so that a model is loaded once. Batches are taken in
    stretches of about ``STRETCH`` bytes, so that what a task holds as Python values is bounded.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = None
        for batch in (part for whole in batches for part in stretches(whole)):
            if batch.num_rows:
                apply = apply or rows()
                out = apply({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in ((out[f.name], f) for f in arrow)], schema=arrow)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
