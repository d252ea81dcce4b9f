"""Table sinks: typed outputs, id lists, batch replacement, atomic swap, fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def write_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """One output folder per target table."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(f"{folder}/{name}")


def write_id_set(ids: DataFrame, path: str) -> None:
    """Sorted distinct ids as text; the global order comes from range partitions."""
    column = ids.columns[0]
    ids.select(F.col(column).cast("string").alias("value")).distinct().sort("value").write.mode("overwrite").text(path)


def read_id_set(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a written set; blank lines are skipped, a missing file is the empty set."""
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], "ID string")
    trimmed = lines.select(F.trim("value").alias("ID"))
    return trimmed.filter(F.col("ID") != "")


def replace_batch(df: DataFrame, path: str, batch: str) -> None:
    """Rewrite one batch's partition and leave every other batch alone."""
    tagged = df.withColumn("IMPORT_BATCH_ID", F.lit(batch))
    (
        tagged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("IMPORT_BATCH_ID")
        .parquet(path)
    )


def replaced_batch(staged: DataFrame, incoming: DataFrame, batch: str) -> DataFrame:
    """The same rule as a pure function: the batch's old rows leave, the new ones enter."""
    others = staged.filter(F.col("IMPORT_BATCH_ID").isNull() | (F.col("IMPORT_BATCH_ID") != batch))
    return others.unionByName(incoming.withColumn("IMPORT_BATCH_ID", F.lit(batch)))


def swap_table(df: DataFrame, path: str) -> None:
    """Write the next version beside the table, then rename it into place.

    ``df`` may read from ``path``: the old files stay readable until the new ones are
    complete, and a failed write leaves the table as it was.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    new, old = f"{path}__next", f"{path}__previous"
    df.write.mode("overwrite").parquet(new)
    hadoop = jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop(old), True)
    if fs.exists(hadoop(path)) and not fs.rename(hadoop(path), hadoop(old)):
        raise RuntimeError(f"cannot move {path} aside")
    if not fs.rename(hadoop(new), hadoop(path)):
        fs.rename(hadoop(old), hadoop(path))
        raise RuntimeError(f"cannot move {new} into place")
    fs.delete(hadoop(old), True)
    spark.catalog.refreshByPath(path)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and order-free content hash of a table, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("ROWS"),
        F.coalesce(F.bit_xor(F.xxhash64(*[F.col(c) for c in df.columns])), F.lit(0)).alias("CONTENT"),
    )


def snapshot_changed(df: DataFrame, ledger: DataFrame, name: str) -> DataFrame:
    """Is this snapshot new? Compares its fingerprint with the last one in the ledger."""
    old = ledger.filter(F.col("NAME") == name).agg(
        F.max_by("ROWS", "RUN_NO").alias("ROWS"), F.max_by("CONTENT", "RUN_NO").alias("CONTENT")
    )
    both = fingerprint(df).withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)))
    pick = lambda c, side: F.max(F.when(F.col("_new") == side, F.col(c)))
    sides = both.agg(
        pick("ROWS", 1).alias("ROWS"), pick("ROWS", 0).alias("OLD_ROWS"), pick("CONTENT", 1).alias("_a"), pick("CONTENT", 0).alias("_b")
    )
    same = (F.col("_a") == F.col("_b")) & (F.col("ROWS") == F.col("OLD_ROWS"))
    return sides.select(F.lit(name).alias("NAME"), "ROWS", "OLD_ROWS", (~F.coalesce(same, F.lit(False))).alias("CHANGED"))


def register_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> None:
    """Expose tables of a folder to SQL under their own names."""
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
