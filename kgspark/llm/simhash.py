"""Near duplicates by SimHash fingerprints, linked through BK-trees.

A text's fingerprint has a bit set where over half of its shingles' 64-bit hashes have it. Equal fingerprints become one
class before anything else, so copies are never compared. Of two fingerprints that differ in at most r bits, r + 1 blocks
of bits hold at least one that agrees; so fingerprints are dealt to a shard for each block's value. A crowded shard is dealt
once more by blocks of its other bits, and what is crowded still is cut into slices.

Every slice becomes one BK-tree: a node's children are keyed by their whole Hamming distance to it. Trees are stored as rows
of bounded size and sent to the slices that have to ask them; a question at distance d from a node follows only the edges
d - r to d + r. A task answers with a spanning forest of the links it finds, so that a dense shard writes no pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.common import cut, keyed_text, map_rows
from kgspark.llm.components import components

STRIDE = 1 << 16


@dataclass(frozen=True)
class Settings:
    """Words a shingle, the bits in which linked fingerprints may differ, the fingerprints of a tree (about), questions at once."""

    words: int = 4
    radius: int = 4
    tree: int = 4096
    block: int = 128
    seed: int = 42
    slots: int = 256


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """Bits set in over half the shingles' hashes; A-Z are lower-cased, words end at white space of ASCII; no words: 0."""
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line, ends = b" ".join(parts), [e + i for i, e in enumerate(accumulate(map(len, parts)))]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    n = max(1, len(parts) - words + 1)
    ends = ends[words - 1 :] or ends[-1:]
    bits, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, STRIDE):
        part = [digest(line[a:b], seed) for a, b in zip(starts[at : at + STRIDE], ends[at : at + STRIDE], strict=False)]
        one = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(one, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``id`` and ``print``, the fingerprint as a signed number, for every row."""

    def rows():
        def apply(batch):
            found = np.array([fingerprint(t, settings.words, settings.seed) for t in batch["text"]], np.uint64)
            return {"id": batch["id"], "print": pa.array(found.view(np.int64))}

        return apply

    return map_rows(keyed_text(docs, id_col, text_col), rows, "id long, print long")


# Shards


def cuts(bits: int, parts: int) -> list[tuple[int, int]]:
    """The lowest bit and the width of ``parts`` blocks that cover ``bits`` bits."""
    edge = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edge, edge[1:], strict=False)]


def _field(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _without(value: Column, low: int, width: int) -> Column:
    """The bits outside a block, moved together."""
    below = value.bitwiseAND(F.lit((1 << low) - 1))
    above = F.shiftrightunsigned(value, low + width) if low + width < 64 else F.lit(0).cast("long")
    return F.shiftleft(above, low).bitwiseOR(below)


def shards(prints: DataFrame, settings: Settings) -> DataFrame:
    """``shard``, ``slice``, ``slices`` and ``print``: two prints within the radius share a shard at least once.

    A shard's number holds the block and its value, and where it was dealt again the inner block (from 1) and that one's value.
    """
    blocks = cuts(64, settings.radius + 1)
    number = lambda field, i: F.shiftleft(field, 4).bitwiseOR(F.lit(i))
    dealt = prints.select("print", F.explode(F.array(*[number(_field(F.col("print"), *b), i) for i, b in enumerate(blocks)])).alias("shard"))
    sizes = cut(dealt.groupBy("shard").agg(F.count("*").alias("size")).filter("size > 1"), "shard-sizes")
    dealt = dealt.join(sizes, "shard")
    calm = dealt.filter(F.col("size") <= settings.tree).select("shard", "print", "size")
    block = F.col("shard").bitwiseAND(F.lit(15))
    rest = F.coalesce(*[F.when(block == i, _without(F.col("print"), *b)) for i, b in enumerate(blocks)])
    inner = cuts(64 - max(w for _, w in blocks), settings.radius + 1)
    inner[-1] = (inner[-1][0], 64 - min(w for _, w in blocks) - inner[-1][0])
    crowded = dealt.filter(F.col("size") > settings.tree).select("shard", "print", rest.alias("rest"))
    again = F.explode(F.array(*[F.shiftleft(number(_field(F.col("rest"), *b), i + 1), 32).bitwiseOR(F.col("shard")) for i, b in enumerate(inner)]))
    finer = crowded.select(again.alias("shard"), "print")
    finer = finer.join(cut(finer.groupBy("shard").agg(F.count("*").alias("size")).filter("size > 1"), "finer-sizes"), "shard")
    slices = F.ceil(F.col("size") / settings.tree).cast("int")
    return calm.unionByName(finer).select("shard", F.pmod(F.xxhash64("print"), slices).cast("int").alias("slice"), slices.alias("slices"), "print")


# Trees


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def grow(values: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of distinct values, all trees at once: the order of the nodes, each one's parent (or -1) and its edge's key.

    ``tree`` tells the tree of each value, in ascending order. Nodes come level by level, children sorted by parent and key.
    """
    order, parents, keys = [], [], []
    left, under, edge, done = np.arange(len(values)), tree.astype(np.int64), np.zeros(len(values), np.int64), 0
    parent = np.full(len(values), -1, np.int64)
    while len(left):
        first = np.flatnonzero(np.r_[True, under[1:] != under[:-1]])  # the first of each subtree becomes its node
        order.append(left[first]), parents.append(parent[first]), keys.append(edge[first])
        group = np.cumsum(np.r_[True, under[1:] != under[:-1]]) - 1
        rest = np.ones(len(left), bool)
        rest[first] = False
        node = group[rest] + done
        d = distance(values[left[rest]], values[left[first]][group[rest]]).astype(np.int64)
        at = np.lexsort((d, node))
        left, parent, edge = left[rest][at], node[at], d[at]
        under = parent * 65 + edge
        done += len(first)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(order), join(parents), join(keys)


class Forest:
    """BK-trees laid out one after another, to be asked together; ``visited`` counts the distances computed."""

    def __init__(self, values: np.ndarray, parents: np.ndarray, keys: np.ndarray):
        self.values, self.visited = values, 0
        self.edges = np.where(parents >= 0, parents * 65 + keys, -1)
        self.order = np.argsort(self.edges, kind="stable")
        self.sorted = self.edges[self.order]

    def within(self, asked: np.ndarray, roots: np.ndarray, radius: int):
        """Yield (question, node) for the nodes within the radius, a level at a time."""
        who, node = np.arange(len(asked)), roots
        while len(who):
            d = distance(asked[who], self.values[node]).astype(np.int64)
            self.visited += len(d)
            near = d <= radius
            yield who[near], node[near]
            low = np.searchsorted(self.sorted, node * 65 + np.maximum(d - radius, 0), "left")
            n = np.searchsorted(self.sorted, node * 65 + np.minimum(d + radius, 64), "right") - low
            who = np.repeat(who, n)
            node = self.order[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index of its set) after linking a with b."""
    while True:
        x, y = labels[a], labels[b]
        if not (other := x != y).any():
            return labels
        a, b, x, y = a[other], b[other], x[other], y[other]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (further := labels[labels] != labels).any():
            labels[further] = labels[labels[further]]


def trees(dealt: DataFrame) -> DataFrame:
    """A stored tree for every slice: ``shard``, ``slice``, ``slices``, ``prints``, ``parents``, ``keys``."""

    def rows():
        def apply(batch):
            flat = np.array([x for row in batch["prints"] for x in sorted(row)], np.int64).view(np.uint64)
            n = [len(row) for row in batch["prints"]]
            of = np.repeat(np.arange(len(n)), n)
            order, parents, keys = grow(flat, of)
            owner = of[order]
            local = np.empty(len(order), np.int64)
            out = {k: [] for k in ("prints", "parents", "keys")}
            by = np.argsort(owner, kind="stable")
            local[by] = np.arange(len(by)) - np.repeat(np.cumsum(n) - n, n)
            up = np.where(parents >= 0, local[parents], -1)
            for a, b in zip(np.cumsum(n) - n, np.cumsum(n), strict=True):
                mine = by[a:b]
                out["prints"].append(flat[order[mine]].view(np.int64)), out["parents"].append(up[mine]), out["keys"].append(keys[mine])
            return {"shard": batch["shard"], "slice": batch["slice"], "slices": batch["slices"], **{k: pa.array(v, pa.list_(t)) for (k, v), t in zip(out.items(), (pa.int64(), pa.int32(), pa.int32()), strict=True)}}

        return apply

    packed = dealt.groupBy("shard", "slice", "slices").agg(F.collect_list("print").alias("prints"))
    return map_rows(packed, rows, "shard long, slice int, slices int, prints array<long>, parents array<int>, keys array<int>")


def links(stored: DataFrame, settings: Settings) -> DataFrame:
    """``u``, ``v``: links that connect what the stored trees show to lie within the radius. A slice asks its own tree and those of lower slices."""
    asks = stored.filter("slices > 1 or size(prints) > 1").select("shard", F.explode(F.sequence(F.lit(0), "slice")).alias("slice"), F.col("prints").alias("asked"))

    def rows():
        def apply(batch):
            n, m = ([len(x) for x in batch[k]] for k in ("prints", "asked"))
            starts = np.cumsum(n) - n
            flat = lambda k, t: np.array([x for row in batch[k] for x in row], t)
            values, asked = flat("prints", np.int64).view(np.uint64), flat("asked", np.int64).view(np.uint64)
            parents = flat("parents", np.int64)
            forest = Forest(values, np.where(parents >= 0, parents + np.repeat(starts, n), -1), flat("keys", np.int64))
            roots, labels = np.repeat(starts, m), np.arange(len(values) + len(asked))
            for at in range(0, len(asked), settings.block):
                for who, node in forest.within(asked[at : at + settings.block], roots[at : at + settings.block], settings.radius):
                    labels = merge(labels, node, len(values) + at + who)
            both = np.concatenate([values, asked]).view(np.int64)
            u, v = both, both[labels]
            return {"u": pa.array(u[u != v]), "v": pa.array(v[u != v])}

        return apply

    return map_rows(stored.drop("slices").join(asks, ["shard", "slice"]), rows, "u long, v long").distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Every row's fingerprint and the smallest id that links of at most ``radius`` differing bits reach.

    Returns the id, ``fingerprint`` (16 lowercase hex digits) and ``component_id``. Null and empty texts have the fingerprint
    zero and link like others. Repeated rows, ids with several texts and rows without an id each count; a null id names a
    component only if no row of it has another. An empty table gives none; other columns, whatever their names, are ignored.
    """
    rows = cut(with_fingerprints(docs, id_col, text_col, settings), "fingerprints")
    classes = cut(rows.groupBy("print").agg(F.min("id").alias("least"), F.count("*").alias("n")), "classes")
    found = components(links(cut(trees(shards(classes, settings)), "trees"), settings))
    named = classes.join(found.withColumnRenamed("id", "print"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    named = cut(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut(named.join(least, "component").select("print", "n", "component_id"), "component-ids")
    # A print of more than one ``slots``-th of the rows, of which there are fewer than ``slots``, is settled where its rows lie.
    most = (named.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n) // settings.slots
    heavy, light = named.filter(F.col("n") > most), named.filter(F.col("n") <= most).drop("n")
    heavy = F.broadcast(heavy.drop("n")) if most else heavy.drop("n")
    settled = rows.join(heavy, "print").unionByName(rows.join(heavy.select("print"), "print", "left_anti").join(light, "print"))
    return settled.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
