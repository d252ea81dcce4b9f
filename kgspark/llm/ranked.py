"""Ranked lexical search over an inverted index whose posting lists are blocked by the likeness of their documents.

Documents are gathered into shards of bounded size, each a row. A shard's index holds its documents' terms (those the items
ask for), and, for each term, the list of its documents. A list of some length is clustered: its documents go to the nearest
of pivots drawn from the list, and every cluster becomes a block with a summary, the largest gain of each term over the
block's documents. What an item's terms add up to in a summary is an exact upper bound of its documents' scores, so a block
is left out only when that bound stays below the score that an item's last result must reach. Terms that a large part of a
shard holds share one list, of all its documents, blocked in the same way.

The score to reach comes from a first look at each item's rarest terms in all shards. Lists are taken from the rarest on, as
long as the terms that are left could reach it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kgspark.llm.common import cut, keyed_text, map_rows, ship, text_or_empty

#: Bytes of terms in lower case; whatever ends a term becomes a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclass(frozen=True)
class Settings:
    """Results an item, the size of shards and of blocks of documents and items, and what makes a list long or common."""

    k: int = 50
    shard_bytes: int = 16 << 20
    shard_rows: int = 8192
    block: int = 64
    long_list: int = 128
    common: float = 1 / 16
    sketch: int = 16
    seeds: int = 200
    item_terms: int = 100_000


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: maximal runs of ASCII letters and digits and of all other characters from U+0080."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def packed(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, "<i4").tobytes())


def unpacked(x: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), "<i4").astype(np.int64)


def gathered(starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the chosen rows' entries, and where each row's begin among them."""
    n = starts[chosen + 1] - starts[chosen]
    begin = np.cumsum(n) - n
    return np.repeat(starts[chosen] - begin, n) + np.arange(n.sum()), begin


# Shards of documents

SHARD = "shard long, ids array<long>, lengths array<long>, terms array<string>, held array<int>, starts binary, cols binary, counts binary"


def shards(docs: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """Every document that has terms, in rows of about ``shard_bytes`` bytes of text: ids, lengths, and terms with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, count()

        def row(ids, codes, names):
            lengths = np.array([len(x) for x in codes])
            key, n = np.unique(np.repeat(np.arange(len(codes)), lengths) * len(names) + np.concatenate(codes), return_counts=True)
            doc, col = key // len(names), key % len(names)
            starts = np.searchsorted(doc, np.arange(len(codes) + 1))
            values = base + next(made), ids, lengths, [x.decode("utf-8", "surrogatepass") for x in names], np.bincount(col, minlength=len(names)), packed(starts), packed(col), packed(n)
            types = pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()
            fields = [x.split()[0] for x in SHARD.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], fields)

        ids, codes, size, names = [], [], 0, defaultdict(count().__next__)
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                if parts := terms_of(text.as_py()):
                    ids.append(i.as_py())
                    codes.append(np.fromiter(map(names.__getitem__, parts), np.int64, len(parts)))
                    size += len(text.as_py())
                    if size >= settings.shard_bytes or len(ids) >= settings.shard_rows:
                        yield row(ids, codes, names)
                        ids, codes, size, names = [], [], 0, defaultdict(count().__next__)
        if ids:
            yield row(ids, codes, names)

    ship(docs.sparkSession)
    return keyed_text(docs, id_col, text_col).mapInArrow(run, SHARD)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item`` and ``term``, each pair once."""

    def rows():
        def apply(batch):
            return {"item": batch["item"], "terms": [sorted({x.decode("utf-8", "surrogatepass") for x in terms_of(t)}) for t in batch["text"]]}

        return apply

    found = map_rows(items.select(F.col(id_col).cast("long").alias("item"), text_or_empty(text_col).alias("text")), rows, "item long, terms array<string>")
    return found.select("item", F.explode("terms").alias("term")).distinct()


# The index

PARTS = ("starts", "cols", "gains", "block_list", "block_starts", "block_docs", "summary_starts", "summary_cols", "summary_gains")


def blocks_of(docs: np.ndarray, sketches: np.ndarray, size: int) -> list[np.ndarray]:
    """The documents of a list by their nearest pivot, in blocks of at most twice ``size``."""
    pivots = docs[np.linspace(0, len(docs) - 1, -(-len(docs) // size)).astype(int)]
    nearest = np.argmax(sketches[docs] @ sketches[pivots].T, axis=1)
    order = np.argsort(nearest, kind="stable")
    edges = np.flatnonzero(np.diff(nearest[order])) + 1
    return [part for group in np.split(docs[order], edges) for part in np.array_split(group, -(-len(group) // (2 * size)))]


def build(starts: np.ndarray, cols: np.ndarray, gains: np.ndarray, weights: np.ndarray, settings: Settings) -> dict[str, np.ndarray]:
    """Lists, blocks and summaries of a shard from its documents' columns and gains (document by document)."""
    docs, width = len(starts) - 1, len(weights)
    project = np.random.default_rng(1).standard_normal((width, settings.sketch)).astype(np.float32)
    sketches = np.zeros((docs, settings.sketch), np.float32)
    for a in range(0, docs, 512):
        b = min(docs, a + 512)
        at = slice(starts[a], starts[b])
        sketches[a:b] = np.add.reduceat(project[cols[at]] * (weights[cols[at]] * gains[at]).astype(np.float32)[:, None], starts[a:b] - starts[a])
    sketches /= np.maximum(np.linalg.norm(sketches, axis=1, keepdims=True), 1e-9)
    held = np.bincount(cols, minlength=width)
    of_doc = np.repeat(np.arange(docs), np.diff(starts))
    by_col = of_doc[np.argsort(cols, kind="stable")]
    first = np.cumsum(held) - held
    long = np.flatnonzero((held >= settings.long_list) & (held <= settings.common * docs))
    lists = [(c, by_col[first[c] : first[c] + held[c]]) for c in long] + [(-1, np.arange(docs))]
    owner, parts, places, tops = [], [], [], []
    top = np.zeros(width, np.int64)
    for c, members in lists:
        for part in blocks_of(members, sketches, settings.block):
            at, _ = gathered(starts, part)
            np.maximum.at(top, cols[at], gains[at])
            place = np.flatnonzero(top)
            owner.append(c), parts.append(part), places.append(place), tops.append(top[place])
            top[place] = 0
    ends = lambda x: np.cumsum([0, *map(len, x)])
    return {
        "block_list": np.array(owner), "block_starts": ends(parts), "block_docs": np.concatenate(parts),
        "summary_starts": ends(places), "summary_cols": np.concatenate(places), "summary_gains": np.concatenate(tops),
    }


def gain(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence count is worth in a document of that length, in millionths."""
    m = 50 + 50 * lengths * n_docs // n_terms
    return 1_000_000_000 * counts // (1000 * counts + 20 * m)


INDEX = "shard long, ids array<long>, terms array<string>, weights array<long>, " + ", ".join(f"{p} binary" for p in PARTS)


def index(raw: DataFrame, wanted: DataFrame, n_docs: int, n_terms: int, settings: Settings) -> DataFrame:
    """A shard's index as a row. ``wanted``: ``shard`` and ``found``, its terms that items ask for, as (pos, term, weight)."""

    def rows():
        def apply(batch):
            out = {f.split()[0]: [] for f in INDEX.split(", ")}
            for i, found in enumerate(batch["found"]):
                found = sorted(found, key=lambda x: x["pos"])
                starts, cols, counts = (unpacked(batch[k][i]) for k in ("starts", "cols", "counts"))
                new = np.full(len(batch["held"][i]), -1)
                new[[x["pos"] for x in found]] = np.arange(len(found))
                lengths = np.repeat(np.array(batch["lengths"][i]), np.diff(starts))
                keep = new[cols] >= 0
                doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[keep]
                some = np.unique(doc)  # documents with none of the terms have no score
                made = {"starts": np.r_[np.searchsorted(doc, some), len(doc)], "cols": new[cols[keep]], "gains": gain(counts[keep], lengths[keep], n_docs, n_terms)}
                weights = np.array([x["weight"] for x in found])
                made |= build(made["starts"], made["cols"], made["gains"], weights, settings)
                ids = batch["ids"][i]
                for k, v in {"shard": batch["shard"][i], "ids": [ids[d] for d in some], "terms": [x["term"] for x in found], "weights": weights.tolist(), **{p: packed(made[p]) for p in PARTS}}.items():
                    out[k].append(v)
            return out

        return apply

    return map_rows(raw.drop("terms").join(wanted, "shard"), rows, INDEX)


# Search


class Shard:
    """A shard's index, read to answer items; ``scored`` counts documents, ``skipped`` blocks left out by their bounds."""

    def __init__(self, row: dict, settings: Settings):
        for p in PARTS:
            setattr(self, p, unpacked(row[p]))
        self.settings, self.weights = settings, np.array(row["weights"], np.int64)
        self.docs, width = len(self.starts) - 1, len(self.weights)
        self.held = np.bincount(self.cols, minlength=width)
        order = np.argsort(self.cols, kind="stable")
        self.list_docs = np.repeat(np.arange(self.docs), np.diff(self.starts))[order]
        self.list_starts = np.r_[0, np.cumsum(self.held)]
        self.peak = np.maximum.reduceat(self.gains[order], self.list_starts[:-1]) * self.weights
        self.long = np.isin(np.arange(width), self.block_list)
        self.shared = (self.held >= settings.long_list) & ~self.long
        self.scored = self.skipped = 0

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        at, begin = gathered(self.starts, docs)
        self.scored += len(docs)
        return np.add.reduceat(asked[self.cols[at]] * self.gains[at], begin) if len(docs) else np.zeros(0, np.int64)

    def passing(self, blocks: np.ndarray, asked: np.ndarray, least: int) -> np.ndarray:
        """Documents of the blocks whose summaries could reach ``least``."""
        if not len(blocks):
            return blocks
        at, begin = gathered(self.summary_starts, blocks)
        good = blocks[np.add.reduceat(asked[self.summary_cols[at]] * self.summary_gains[at], begin) >= least]
        self.skipped += len(blocks) - len(good)
        return self.block_docs[gathered(self.block_starts, good)[0]]

    def best(self, cols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that score ``least`` or more, and their scores, without any that could not be among the k best."""
        k = self.settings.k
        cols = cols[np.argsort(self.held[cols], kind="stable")]
        rest = np.cumsum(self.peak[cols][::-1])[::-1]
        asked = np.zeros(len(self.weights), np.int64)
        asked[cols] = self.weights[cols]
        seen, docs, scores = np.zeros(self.docs, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for kind in ("short", "long", "shared"):
            need = cols[: (rest >= least).sum()]  # what stands behind cannot reach it alone
            if kind == "short":
                found = self.list_docs[gathered(self.list_starts, need[self.held[need] < self.settings.long_list])[0]]
            elif kind == "long":
                found = self.passing(np.flatnonzero(np.isin(self.block_list, need[self.long[need]])), asked, least)
            else:
                found = self.passing(np.flatnonzero(self.block_list == -1), asked, least) if self.shared[need].any() else need[:0]
            found = np.unique(found[~seen[found]])
            seen[found] = True
            new = self.scores(found, asked)
            docs, scores = np.concatenate([docs, found[new >= least]]), np.concatenate([scores, new[new >= least]])
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, -k)[-k]))
        return docs[scores >= least], scores[scores >= least]

    def of_lists(self, cols: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """The scores of all documents in the lists of ``seeds``."""
        asked = np.zeros(len(self.weights), np.int64)
        asked[cols] = self.weights[cols]
        return self.scores(np.unique(self.list_docs[gathered(self.list_starts, seeds)[0]]), asked)


def searched(indexed: DataFrame, asked: list[tuple[int | None, list[str], list[str], int]], settings: Settings, first_look: bool) -> DataFrame:
    """One block of items (id, terms, seeds, score to reach) against every shard: ``item``, ``doc``, ``score``, at most ``k`` rows an item and shard."""

    def rows():
        words = {t: i for i, t in enumerate(sorted({t for _, terms, _, _ in asked for t in terms}))}
        coded = [(item, np.array([words[t] for t in terms], int), np.array([words[t] for t in seeds], int), least) for item, terms, seeds, least in asked]

        def apply(batch):
            items, docs, scores = [], [], []
            for i, ids in enumerate(batch["ids"]):
                shard = Shard({k: v[i] for k, v in batch.items()}, settings)
                place = np.full(len(words), -1)
                for c, t in enumerate(batch["terms"][i]):
                    if t in words:
                        place[words[t]] = c
                none = np.array([x is None for x in ids])
                order = np.array([0 if x is None else x for x in ids], np.int64)
                for item, terms, seeds, least in coded:
                    cols = place[terms]
                    cols = cols[cols >= 0]
                    if first_look:
                        got = np.sort(shard.of_lists(cols, place[seeds][place[seeds] >= 0]))[::-1][: settings.k].tolist()
                        found = [None] * len(got)
                    elif len(cols):
                        at, score = shard.best(cols, max(1, least))
                        top = np.lexsort((order[at], none[at], -score))[: settings.k]
                        found, got = [ids[d] for d in at[top]], score[top].tolist()
                    else:
                        continue
                    items += [item] * len(got)
                    docs += found
                    scores += got
            return {"item": items, "doc": docs, "score": scores}

        return apply

    return map_rows(indexed, rows, "item long, doc long, score long")


def ranked(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Each item's ``k`` best documents: the item's id, ``rank`` (from 1), the document's id, ``score``; only scores above 0.

    Terms are maximal runs of ASCII letters and digits and characters from U+0080, with A-Z lower-cased. Null and empty texts
    have none: such documents count nowhere and such items get no rows. Rows that share an item id (a null one, too) are one
    item with all their terms. Equal scores go by ascending id; documents without an id are ranked, after those with one;
    repeated rows are ranked each. Empty tables give no rows; other columns, whatever their names, are ignored.

    Items come in blocks of about ``item_terms`` terms (an item with more is a block), which are sent to all shards.
    """
    spark = docs.sparkSession
    raw = cut(shards(docs, id_col, text_col, settings), "shards")
    asked = cut(item_terms(items, item_col, item_text), "item-terms")
    total = raw.agg(F.sum(F.size("ids")).alias("docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms")).first()
    shape = F.col("item").alias(item_col), F.col("rank"), F.col("doc").alias(id_col), F.col("score")
    if not total.docs:
        return spark.createDataFrame([], "item long, rank int, doc long, score long").select(*shape)
    lists = raw.select("shard", F.posexplode(F.arrays_zip("terms", "held"))).select("shard", "pos", F.col("col.terms").alias("term"), F.col("col.held").alias("held"))
    hits = cut(lists.join(asked.select("term").distinct(), "term"), "hits")
    weight: Column = F.floor(1000 * F.log((2 * total.docs + 2) / (2 * F.col("df") + 1))).cast("long")
    terms = cut(hits.groupBy("term").agg(F.sum("held").alias("df")).withColumn("weight", weight), "weights")
    wanted = hits.join(terms, "term").groupBy("shard").agg(F.collect_list(F.struct("pos", "term", "weight")).alias("found"))
    indexed = cut(index(raw, wanted, total.docs, total.terms, settings), "index")

    rarest = Window.partitionBy("item").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    known = asked.join(terms, "term").withColumn("seed", F.coalesce(F.sum("df").over(rarest), F.lit(0)) < settings.seeds)
    queries = known.groupBy("item").agg(F.collect_list("term").alias("terms"), F.collect_list(F.when(F.col("seed"), F.col("term"))).alias("seeds"))
    parts = -(-asked.count() // settings.item_terms)
    queries = cut(queries.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(max(1, parts)))), "queries")
    best = []
    for part in range(parts):
        block = [(r.item, r.terms, r.seeds) for r in queries.filter(F.col("part") == part).collect()]  # about ``item_terms`` terms
        looked = searched(indexed, [(*b, 0) for b in block], settings, first_look=True)
        nth = Window.partitionBy("item").orderBy(F.desc("score"))
        reach = looked.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") == settings.k)
        least = {r.item: r.score for r in reach.select("item", "score").collect()}  # one row an item of the block
        found = searched(indexed, [(*b, least.get(b[0], 0)) for b in block], settings, first_look=False)
        best.append(cut(found, "found"))
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    union = spark.createDataFrame([], "item long, doc long, score long") if not best else best[0]
    for more in best[1:]:
        union = union.union(more)
    return union.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= settings.k).select(*shape)
