"""A table kept by keys, of which a batch rewrites only the parts it touches.

Rows are dealt to a fixed number of parts by a hash of their keys. A batch meets the old rows of its own parts only; their
next versions are written beside the old ones, then a small commit names the version of every part. Readers read what the
newest commit names, so a batch is seen whole or not at all, and one that was committed before changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.operators.ranking import latest_wins
from kgspark.session import cut

Settle = Callable[[DataFrame, DataFrame], DataFrame]


class MergedTable:
    """``folder`` holds ``data/epoch=e/part=p`` and ``commits/epoch=e``; ``schema`` is a DDL string, ``parts`` must not change."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: Sequence[str], parts: int = 64):
        self.spark, self.folder, self.schema, self.keys, self.parts = spark, folder.rstrip("/"), schema, list(keys), parts

    def _hadoop(self, path: str):
        jvm = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm

    def _children(self, path: str) -> list[str]:
        fs, at = self._hadoop(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def epochs(self) -> list[int]:
        """Committed epochs, oldest first: those whose commit was written to its end."""
        found = [int(n.partition("=")[2]) for n in self._children(f"{self.folder}/commits") if n.startswith("epoch=")]
        done = [e for e in sorted(found) if "_SUCCESS" in self._children(f"{self.folder}/commits/epoch={e}")]
        return done

    def versions(self, epoch: int | None = None) -> dict[int, int]:
        """The version of every part that holds rows, at an epoch or the newest; at most ``parts`` entries."""
        epochs = self.epochs()
        if not epochs:
            return {}
        rows = self.spark.read.schema("part INT, version BIGINT").parquet(f"{self.folder}/commits/epoch={epochs[-1] if epoch is None else epoch}")
        return {r.part: r.version for r in rows.collect()}

    def _of(self, versions: dict[int, int]) -> DataFrame:
        paths = [f"{self.folder}/data/epoch={v}/part={p}" for p, v in sorted(versions.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, epoch: int | None = None) -> DataFrame:
        """The table as the newest commit, or that of ``epoch``, names it."""
        return self._of(self.versions(epoch))

    def merge(self, rows: DataFrame, epoch: int, settle: Settle) -> bool:
        """Bring a batch in: the touched parts become ``settle(their old rows, rows)``. False if the epoch or a later one is in already."""
        known = self.epochs()
        if known and known[-1] >= epoch:
            return False
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")
        fields = self.spark.createDataFrame([], self.schema).schema
        rows = cut(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in fields]), "batch")
        touched = {r.part for r in rows.select(part.alias("part")).distinct().collect()}
        before = self.versions()
        old = self._of({p: v for p, v in before.items() if p in touched})
        folder = f"{self.folder}/data/epoch={epoch}"
        after = settle(old, rows).select(*fields.names).withColumn("part", part)
        after.repartition("part", F.pmod(F.xxhash64(*self.keys, F.lit(1)), F.lit(8))).write.mode("overwrite").partitionBy("part").parquet(folder)
        filled = {int(n.partition("=")[2]) for n in self._children(folder) if n.startswith("part=")}
        named = [(p, v) for p, v in before.items() if p not in touched] + [(p, epoch) for p in filled]
        commit = self.spark.createDataFrame(sorted(named), "part INT, version BIGINT")
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/epoch={epoch}")
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Delete versions that none of the last ``keep`` commits names, and the commits before those."""
        epochs = self.epochs()
        named = {(p, v) for e in epochs[-keep:] for p, v in self.versions(e).items()}
        for name in self._children(f"{self.folder}/data"):
            version = int(name.partition("=")[2])
            if not epochs or version > epochs[-1]:  # a batch that is being written
                continue
            parts = [c for c in self._children(f"{self.folder}/data/{name}") if c.startswith("part=")]
            gone = [c for c in parts if (int(c.partition("=")[2]), version) not in named]
            for path in [f"{name}/{c}" for c in gone] if len(gone) < len(parts) else [name]:
                fs, at = self._hadoop(f"{self.folder}/data/{path}")
                fs.delete(at, True)
        for e in epochs[:-keep]:
            fs, at = self._hadoop(f"{self.folder}/commits/epoch={e}")
            fs.delete(at, True)


def newest_row(keys: Sequence[str], order: Sequence[str]) -> Settle:
    """Of old and new rows of a key the last by ``order`` stays, whichever batch it came in."""
    return lambda old, new: latest_wins(old.unionByName(new), list(keys), list(order))


def first_seen(keys: Sequence[str]) -> Settle:
    """A key that is there keeps its row; only new keys come in."""
    return lambda old, new: old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"))
