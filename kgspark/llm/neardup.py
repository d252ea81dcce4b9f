"""Near duplicates: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidate edges.

One hash pass fills ``bins`` minima; an empty bin copies the bin that its own fixed probe sequence meets first, so small
sets get as many independent bins as large ones. ``rows`` neighbouring bins make a band; equal bands make a bucket.

A bucket of n texts proposes n - 1 edges, from a centre to the others. Edges are confirmed on full shingle sets. A second
star takes as centre the text with most links so far. Buckets that then still hold texts of different components are
searched whole, in tiles of bounded size: a small set is compared as it is, a large one by its sketch, and only what may be
similar enough is proposed. So no link that any bucket shows is lost, and no bucket's pairs are written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.common import cut, map_rows, row_key, ship, text_or_empty
from kgspark.llm.components import components
from kgspark.llm.piece_model import Memo

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Words a shingle, the similarity as a ratio of whole numbers, and the sketch's size.

    At a similarity of 0.75 two sets share none of 64 bands of 5 bins with a probability of 3e-8.
    """

    words: int = 5
    similar: tuple[int, int] = (75, 100)
    bands: int = 64
    rows: int = 5


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(memo: int = 400_000) -> Memo:
    import xxhash

    return Memo(xxhash.xxh3_64_intdigest, memo)


def shingle_set(text: str, of_word: Memo, words: int = 5) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; A-Z are lower-cased, words end at white space of ASCII."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(of_word.__getitem__, parts), dtype=np.uint64, count=n)
    if n < words:  # the whole sequence is one shingle, which no shingle of full length equals
        out = np.full(1, n, dtype=np.uint64)
        for k in range(n):
            out = _mixed(out * MIX + h[k : k + 1])
        return out
    out = h[: n - words + 1].copy()
    for k in range(1, words):
        out = _mixed(out * MIX + h[k : n - words + 1 + k])
    return np.unique(out)


@lru_cache(maxsize=4)
def _probes(bins: int, attempts: int) -> np.ndarray:
    """For each bin the bins to look at when it is empty, one after another (Shrivastava 2017)."""
    with np.errstate(over="ignore"):
        return (_mixed(np.arange(1, bins * attempts + 1, dtype=np.uint64) * MIX) % np.uint64(bins)).astype(np.int64).reshape(attempts, bins)


def sketch(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Densified one-permutation MinHash of a set that isn't empty: ``bins`` 32-bit minima."""
    h = _mixed(shingles ^ MIX)
    place = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    value = (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
    out = np.full(bins, -1, dtype=np.int64)
    order = np.argsort(-value, kind="stable")
    out[place[order]] = value[order]  # the smallest is written last
    filled = out >= 0
    if not filled.all():
        probes, todo = _probes(bins, 64 * 16), np.flatnonzero(~filled)
        start = 0
        while len(todo) and start < len(probes):
            hit = probes[start, todo]
            good = filled[hit]
            out[todo[good]] = out[hit[good]]
            todo = todo[~good]
            start += 1
        if len(todo):  # a probability of e^-3 a bin for one filled bin of 320: it takes the one next above
            full = np.flatnonzero(filled)
            out[todo] = out[full[np.searchsorted(full, todo) % len(full)]]
    return out


def band_keys(bins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band, which tells bands apart."""
    with np.errstate(over="ignore"):
        b = bins.astype(np.uint64).reshape(bands, rows)
        key = _mixed(np.arange(1, bands + 1, dtype=np.uint64) * MIX)
        for k in range(rows):
            key = _mixed(key * MIX + b[:, k])
    return key.view(np.int64)


def sketches(keyed: DataFrame, s: Settings) -> DataFrame:
    """For every row (``row``, ``id``, ``text``): ``row``, ``id``, ``n`` (size of its set), ``class`` (a 128-bit hash of the set; null for the empty one), band ``keys``."""

    def rows():
        import xxhash

        of_word = word_hashes()

        def apply(batch):
            out = {"row": batch["row"], "id": batch["id"], "n": [], "class": [], "keys": []}
            for text in batch["text"]:
                found = shingle_set(text, of_word, s.words)
                out["n"].append(len(found))
                out["class"].append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                out["keys"].append(band_keys(sketch(found, s.bands * s.rows), s.bands, s.rows).tolist() if len(found) else None)
            return out

        return apply

    return map_rows(keyed, rows, f"row {keyed.schema['row'].dataType.simpleString()}, id long, n long, class binary, keys array<long>")


def full_sets(keyed: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """The full sets (``id``, ``set``) of the wanted classes (``id``, ``row``, the one row that stands for it): the one time that texts are read again.

    Both sides grow with the input, so they meet in a sort-merge join at any size.
    """

    def rows():
        of_word = word_hashes()
        return lambda batch: {"id": batch["id"], "set": [shingle_set(x, of_word, s.words).tobytes() for x in batch["text"]]}

    texts = keyed.select("row", "text").join(wanted.hint("merge"), "row").select("id", "text")
    return cut(map_rows(texts, rows, "id long, set binary"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Those of the pairs (u, v) that the full sets confirm."""
    least, of = s.similar

    def compare():
        def apply(batch):
            out = {"u": [], "v": []}
            last, a = None, None
            for u, v, x, y in zip(batch["u"], batch["v"], batch["set_u"], batch["set_v"], strict=True):
                if u != last:
                    last, a = u, np.frombuffer(x, dtype=np.uint64)
                b = np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if of * both >= least * (len(a) + len(b) - both):
                    out["u"].append(u)
                    out["v"].append(v)
            return out

        return apply

    joined = pairs.join(sets.select(F.col("id").alias("v"), F.col("set").alias("set_v")), "v").join(sets.select(F.col("id").alias("u"), F.col("set").alias("set_u")), "u")
    return map_rows(joined.select("u", "v", "set_u", "set_v"), compare, "u long, v long")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """The component of near duplicates of each document: ``doc_id`` (as ``id_col``), ``n_shingles``, ``component_id``, ``kept``.

    Two texts are linked when their sets of word shingles have at least the set similarity; ``component_id`` is the
    smallest id that links reach, and the row with it is ``kept``. Texts with equal sets are one class from the start: one
    of them stands for all. Null, empty and blank texts have no shingles and no links. Rows that repeat an id with equal
    texts share their result; with different texts they link their classes, and what is like either is linked. A row without an id gets its class's component,
    or none, and is kept only if it has none. Other columns are ignored.
    """
    s = settings
    docs, key = row_key(docs)
    keyed = docs.select(key.alias("row"), F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    rows = cut(sketches(keyed, s), "sketches")
    named = rows.filter("id is not null and class is not null")
    merged = named.groupBy("class").agg(F.min("id").alias("least"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    classes = cut(merged.withColumn("number", F.monotonically_increasing_id()), "classes")
    # Ids with several texts link their classes.
    number_of = classes.select("class", "number")
    texts_of = named.select("id", "class").distinct()
    several = texts_of.groupBy("id").agg(F.min("class").alias("class"), F.max("class").alias("b")).filter("class <> b")
    doubled = several.join(number_of, "class").select("id", F.col("number").alias("u")).join(texts_of.join(number_of, "class").select("id", F.col("number").alias("v")), "id").select("u", "v")
    links = _links(classes.select(F.col("number").alias("id"), "row", "n", "keys"), keyed, s)
    found = components(links.union(doubled))
    of_class = classes.select("class", "number", "least").join(found.select(F.col("id").alias("number"), "component"), "number", "left").withColumn("component", F.coalesce("component", "number"))
    of_class = cut(of_class, "class-components")
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    out = rows.select("id", "n", "class").join(of_class.join(least, "component").select("class", "component_id"), "class", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _close(a: Column, b: Column, s: Settings) -> Column:
    """Whether sets of these sizes can have the similarity at all."""
    return F.least(a, b) * s.similar[1] >= F.greatest(a, b) * s.similar[0]


def _links(classes: DataFrame, keyed: DataFrame, s: Settings) -> DataFrame:
    """Confirmed links between classes (``id``, their number): enough of them to join what any bucket would join."""
    entries = classes.select(F.explode("keys").alias("key"), "id", "n")
    stars = entries.groupBy("key").agg(F.min(F.struct("id", "n")).alias("centre"), F.count("*").alias("k")).filter("k > 1").select("key", "centre")
    live = cut(entries.join(stars, "key"), "buckets")
    first = live.filter((F.col("id") != F.col("centre.id")) & _close(F.col("n"), F.col("centre.n"), s)).select(F.col("centre.id").alias("u"), F.col("id").alias("v")).distinct()
    tried = cut(first, "pairs")
    # Whatever is compared from here on lies in a bucket of two texts at least.
    wanted = classes.select("id", "row").join(live.select("id").distinct(), "id", "left_semi")
    sets = full_sets(keyed, wanted, s)
    links = cut(confirmed(tried, sets, s), "links")

    # Second star: the text with most links is the centre for what its bucket has of other components.
    rest = _mixed_buckets(live, links, hubs=True)
    pairs = rest.filter((F.col("component") != F.col("hub.component")) & _close(F.col("n"), F.col("hub.n"), s)).select(
        F.least("hub.id", "id").alias("u"), F.greatest("hub.id", "id").alias("v")
    )
    more = cut(pairs.distinct().join(tried, ["u", "v"], "left_anti"), "pairs")
    links = _added(links, more, sets, s)
    # The rest: what different components of a bucket may have in common, so that nothing is left untried.
    rest = _mixed_buckets(rest.select("key", "id", "n"), links, hubs=False)
    more = cut(_likely(rest, sets, s).distinct().join(tried.union(more), ["u", "v"], "left_anti"), "pairs")
    return _added(links, more, sets, s)


def _added(links: DataFrame, pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The links, with those of the pairs that are confirmed."""
    return links if pairs.isEmpty() else cut(links.union(confirmed(pairs, sets, s)), "links")


def _mixed_buckets(live: DataFrame, links: DataFrame, hubs: bool) -> DataFrame:
    """The entries of buckets that hold several components yet, with ``component`` and, if asked for, the bucket's ``hub``."""
    now = live.select("key", "id", "n").join(components(links), "id", "left").withColumn("component", F.coalesce("component", "id"))
    best = []
    if hubs:
        degree = links.select(F.col("u").alias("id")).union(links.select("v")).groupBy("id").agg(F.count("*").alias("degree"))
        now = now.join(degree, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
        best = [F.max(F.struct("degree", (-F.col("id")).alias("low"), "id", "n", "component")).alias("hub")]
    now = cut(now, "members")
    mixed = now.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("k"), *best).filter("a <> b")
    return cut(now.join(mixed.drop("a", "b"), "key"), "mixed")


#: Sets up to the first size are compared whole, as 32-bit hashes; those beyond the second have a sketch for it. Bins of a tile's
#: sketches are 16 bits. A sketch of a similarity of 0.75 shows less than the last number with a probability of 3e-6.
SMALL, LARGE, TILE, SEEN = 400, 300, 512, 0.64


def prints(shingles: np.ndarray, bins: int) -> tuple[bytes | None, bytes | None]:
    """What stands for a set in a tile: its members, its sketch, or both for sizes that meet either kind."""
    small = np.unique((shingles >> np.uint64(32)).astype(np.uint32)).tobytes() if len(shingles) <= SMALL else None
    large = (sketch(shingles, bins) & 0xFFFF).astype(np.uint16).tobytes() if len(shingles) > LARGE else None
    return small, large


def tile_pairs(rows: list[dict], s: Settings) -> list[tuple[int, int]]:
    """Pairs of a tile's rows, of different components and parts, that may be similar enough."""
    ids, n, component, part = (np.array([r[k] for r in rows]) for k in ("id", "n", "component", "part"))
    across = rows[0]["i"] != rows[0]["j"]
    least = s.similar[0] / s.similar[1]
    small = n <= SMALL
    sets = [np.frombuffer(r["small"], dtype=np.uint32) if r["small"] is not None else np.empty(0, np.uint32) for r in rows]
    names, at = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([len(x) for x in sets])
    owner = np.repeat(np.arange(len(rows)), [len(x) for x in sets])
    bins = np.zeros((len(rows), s.bands * s.rows), dtype=np.uint16)
    for k, r in enumerate(rows):
        if r["large"] is not None:
            bins[k] = np.frombuffer(r["large"], dtype=np.uint16)
    out = []
    for a in range(len(rows) - 1):
        fit = (component != component[a]) & (np.minimum(n, n[a]) >= least * np.maximum(n, n[a]))
        fit[: a + 1] = False
        if across:
            fit &= part != part[a]
        if not fit.any():
            continue
        if small[a] and (one := np.flatnonzero(fit & small)).size:
            mark = np.zeros(len(names), dtype=bool)
            mark[at[ends[a] - len(sets[a]) : ends[a]]] = True
            both = np.bincount(owner[mark[at]], minlength=len(rows))[one]
            likely = both >= (least - 0.01) * (len(sets[a]) + np.array([len(sets[k]) for k in one]) - both)
            out += [(a, b) for b in one[likely]]
        two = np.flatnonzero(fit & ~(small & small[a]))
        if two.size:
            out += [(a, b) for b in two[(bins[two] == bins[a]).mean(axis=1) >= SEEN]]
    return [(int(min(ids[a], ids[b])), int(max(ids[a], ids[b]))) for a, b in out]


def _likely(rest: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs (u, v) of different components of a bucket that may be similar enough: compared in tiles, not written out."""

    def shown():
        def apply(batch):
            both = [prints(np.frombuffer(x, dtype=np.uint64), s.bands * s.rows) for x in batch["set"]]
            return {"id": batch["id"], "small": [x for x, _ in both], "large": [y for _, y in both]}

        return apply

    shown_sets = map_rows(sets.join(rest.select("id").distinct(), "id", "left_semi"), shown, "id long, small binary, large binary")
    parts = F.ceil(F.col("k") / TILE).cast("int")
    mine = F.pmod(F.xxhash64("id"), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), parts - 1))
    tiles = rest.select("key", "id", "n", "component", mine.alias("part"), other.alias("other")).select(
        "key", "id", "n", "component", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    )
    tiles = tiles.join(shown_sets, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []  # a tile's rows: two parts of a bucket at most

        def found(rows):
            return tile_pairs(rows, s) if len(rows) > 1 else []

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and (held[0]["key"], held[0]["i"], held[0]["j"]) != (row["key"], row["i"], row["j"]):
                    out += found(held)
                    held = []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["u", "v"])
        out = found(held)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["u", "v"])

    ship(rest.sparkSession)
    return tiles.mapInArrow(pairs, "u long, v long")
