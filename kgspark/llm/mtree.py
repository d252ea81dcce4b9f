"""Exact top-k search by inner product in M-trees of paged metric nodes.

Inner products become distances in one more dimension: with ``M2`` the largest squared length of any vector,
|q|^2 + M2 - 2 <q, x> is the squared distance of (q, 0) and (x, sqrt(M2 - |x|^2)), so the nearest are those of the
highest product. The top level are regions around pivots, fitted on a bounded sample; every region's rows are dealt to
slices of bounded size, and each slice is bulk-loaded into a tree whose pages hold a routing vector, a covering radius, the
distance to the parent's routing vector and either child pages or entries with their distances.

A query first searches its own region's trees, which gives it a k-th score; then only trees of regions that the triangle
inequality cannot rule out. In a tree pages are visited best first; stored distances to the parent rule out pages and entries
before their own distance is computed. Bounds are floating point with slack; scores are whole numbers.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kgspark.llm.common import cut, map_rows, ship

SLACK = 1e-6


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows that pivots are chosen from; ``slice_rows`` is a tree's usual size; ``page`` a leaf's entries."""

    pivots: int = 48
    sample: int = 4096
    slice_rows: int = 8192
    page: int = 256
    fan_out: int = 24
    block: int = 2048


def lifted(x: np.ndarray, m2: float) -> np.ndarray:
    """Vectors with the extra coordinate that gives all of them the same length."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(m2 - np.square(x).sum(axis=1), 0.0))])


def far_apart(points: np.ndarray, k: int) -> np.ndarray:
    """Places of up to k points, each the furthest from those before it; equal points are chosen once."""
    chosen = [0]
    near = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(k, len(points)):
        i = int(near.argmax())
        if near[i] <= 0:
            break
        chosen.append(i)
        near = np.minimum(near, np.linalg.norm(points - points[i], axis=1))
    return np.array(chosen)


@dataclass
class Page:
    """A node: what it covers, and either children (their routing vectors, radii and distances to this one's) or entries.

    Entries are the tree's rows from ``first`` to ``last``, by their distance to this page's routing vector.
    """

    route: np.ndarray
    radius: float
    children: list[int]
    first: int
    last: int
    distances: np.ndarray | None = None
    routes: np.ndarray | None = None
    radii: np.ndarray | None = None
    to_parent: np.ndarray | None = None


class Tree:
    """A bulk-loaded M-tree over ids and whole-number vectors; a leaf's entries lie together."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m2: float, page: int = 256, fan_out: int = 24):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        self.m2, self.pages = m2, []
        self.computed = 0  # scores of entries computed so far
        self._points, self._order = lifted(vectors, m2), []
        if len(ids):
            self._build(np.arange(len(ids)), page, fan_out)
        laid = np.concatenate(self._order) if self._order else np.arange(0)
        self.ids, self.vectors = ids[laid], vectors[laid].astype(np.float64)  # whole numbers below 2^53: products stay exact
        del self._points, self._order

    def _build(self, own: np.ndarray, page: int, fan_out: int) -> int:
        points = self._points[own]
        route = points[int(np.linalg.norm(points - points.mean(axis=0), axis=1).argmin())]
        distances = np.linalg.norm(points - route, axis=1)
        here, first = len(self.pages), sum(map(len, self._order))
        node = Page(route, float(distances.max()), [], first, first + len(own))
        self.pages.append(node)
        if len(own) <= page:
            order = np.argsort(distances, kind="stable")
            self._order.append(own[order])
            node.distances = distances[order]
            return here
        some = points[:: max(1, len(points) // 1024)]
        seeds = some[far_apart(some, min(fan_out, -(-len(own) // page)))]
        nearest = (np.square(seeds).sum(axis=1)[None] - 2.0 * points @ seeds.T).argmin(axis=1)
        groups = [own[nearest == k] for k in range(len(seeds)) if (nearest == k).any()]
        if len(groups) == 1:  # too alike to tell apart: pages by order
            groups = np.array_split(own, min(fan_out, -(-len(own) // page)))
        node.children = [self._build(group, page, fan_out) for group in groups]
        below = [self.pages[c] for c in node.children]
        node.routes = np.stack([c.route for c in below])
        node.radii = np.array([c.radius for c in below])
        node.to_parent = np.linalg.norm(node.routes - route, axis=1)
        return here

    def search(self, query_id: int, query: np.ndarray, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best of this tree and ``best``, as (-score, id), best first; the query's own id takes no part.

        ``best`` may hold scores of other trees; what can't reach the k-th of them isn't looked at.
        """
        if not self.pages:
            return best
        query = query.astype(np.float64)
        q = np.append(query, 0.0)
        long, slack = float(query @ query) + self.m2, SLACK * (1 + self.m2**0.5)
        found = sorted(best)[:k]

        def reach() -> float:
            """How far the k-th best is; nothing further is wanted, what is as far may win by its id."""
            return np.inf if len(found) < k else max(long + 2.0 * found[-1][0], 0.0) ** 0.5 + slack

        root, limit = self.pages[0], reach()
        to_root = float(np.linalg.norm(q - root.route))
        queue = [(max(0.0, to_root - root.radius), 0, to_root)]
        while queue:
            bound, at, to_route = heapq.heappop(queue)
            if bound > limit:
                break
            node = self.pages[at]
            if node.children:
                # Stored distances to the parent rule children out before their own distance is computed.
                for c in np.flatnonzero(np.abs(to_route - node.to_parent) - node.radii <= limit) if limit < np.inf else range(len(node.children)):
                    away = q - node.routes[c]
                    to_child = float(away @ away) ** 0.5
                    low = max(0.0, to_child - node.radii[c])
                    if low <= limit:
                        heapq.heappush(queue, (low, node.children[c], to_child))
                continue
            # Entries lie by distance: those that the triangle inequality leaves are one stretch.
            a, b = np.searchsorted(node.distances, (to_route - limit, to_route + limit)) if limit < np.inf else (0, len(node.distances))
            b = min(b + 1, len(node.distances))
            if a < b:
                self.computed += b - a
                scores = self.vectors[node.first + a : node.first + b] @ query
                keep = np.flatnonzero(scores >= -found[-1][0]) if len(found) >= k else range(b - a)
                if len(keep):
                    more = [(-int(scores[i]), int(self.ids[node.first + a + i])) for i in keep]
                    found = sorted({*found, *(x for x in more if x[1] != query_id)})[:k]
                    limit = reach()
        return found


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``v``, floor(scale * x) of each component as long; unusable vectors and null ids are left out, an id counts once."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    return rows.groupBy("id").agg(F.min("x").alias("x")).select("id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter ones end in zeros."""
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, x in enumerate(column.to_pylist()):
        out[i, : len(x)] = x
    return out


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """For each row that ``is_query(id column)`` names, its ``k`` highest inner products with the other rows.

    Columns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, a whole number: components are floor(scale * x).
    Ties go to the smaller id; with fewer candidates all are returned. Null vectors, vectors with null, NaN or infinite
    components and rows without an id take no part; rows that repeat an id are one, with the smallest vector; shorter vectors
    are filled up with zeros, an empty one scores 0. An empty table has no rows. Other columns are ignored.
    """
    s, spark = settings, vectors.sparkSession
    ship(spark)
    rows = cut(whole_numbers(vectors, id_col, vector_col, scale), "whole")
    square = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    size = rows.agg(F.max(square).alias("m2"), F.max(F.size("v")).alias("width")).first()
    m2, width = float(size.m2 or 0), max(size.width or 1, 1)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(s.sample).select("v").toArrow()
    taken = lifted(_matrix(sample["v"], width), m2) if sample.num_rows else np.zeros((1, width + 1))
    pivots = taken[far_apart(taken, s.pivots)]

    def to_pivots(points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(np.square(points).sum(1)[:, None] + np.square(pivots).sum(1)[None] - 2.0 * points @ pivots.T, 0.0))

    def assign():
        def apply(batch):
            d = to_pivots(lifted(_matrix(pa.array(batch["v"], pa.list_(pa.int64())), width), m2))
            return {"id": batch["id"], "v": batch["v"], "region": d.argmin(axis=1).tolist(), "far": d.min(axis=1).tolist()}

        return apply

    placed = cut(map_rows(rows, assign, "id long, v array<long>, region int, far double"), "regions")
    regions = {r.region: r for r in placed.groupBy("region").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}  # a row a pivot
    slices = [-(-regions[r].n // s.slice_rows) if r in regions else 0 for r in range(len(pivots))]
    radii = np.array([regions[r].radius if r in regions else -1.0 for r in range(len(pivots))])
    of_region = F.array(*[F.lit(max(1, n)) for n in slices])
    entries = placed.select("id", "v", "region", F.pmod(F.xxhash64("id"), of_region[F.col("region")]).cast("int").alias("slice"))

    queries = placed.filter(is_query(F.col("id"))).select("id", "v", F.col("region").alias("home"))
    blocks = max(1, -(-queries.count() // s.block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    trees = entries.select("id", "v", "region", "slice", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def searched(asked: DataFrame) -> DataFrame:
        """``asked``: id, v, block, region and known (the k-th score so far or null), searched in all trees of the region."""
        wanted = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), of_region[F.col("region")] - 1)))
        key = ("region", "slice", "block")

        def one(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            if left.num_rows and right.num_rows:
                tree = Tree(right["id"].to_numpy(), _matrix(right["v"], width), m2, s.page, s.fan_out)
                for i, q, known in zip(left["id"].to_pylist(), _matrix(left["v"], width), left["known"].to_pylist(), strict=True):
                    # A known k-th score keeps k places that any better or equal row takes; the places themselves are no rows.
                    held = [] if known is None else [(-known, 1 << 62 | n) for n in range(k)]
                    out += [(i, x, -s_) for s_, x in tree.search(i, q, k, held) if x < 1 << 62]
            return pa.table({"query_id": pa.array([x[0] for x in out], pa.int64()), "vec_id": pa.array([x[1] for x in out], pa.int64()), "score": pa.array([x[2] for x in out], pa.int64())})

        return wanted.groupBy(*key).cogroup(trees.groupBy(*key)).applyInArrow(one, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = cut(searched(queries.select("id", "v", "block", F.col("home").alias("region"), F.lit(None).cast("long").alias("known"))), "home")
    kth = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("known"))

    def other_regions():
        def apply(batch):
            v = _matrix(pa.array(batch["v"], pa.list_(pa.int64())), width)
            q = np.column_stack([v.astype(np.float64), np.zeros(len(v))])
            known = np.array([np.nan if x is None else float(x) for x in batch["known"]])
            reach = np.sqrt(np.maximum(np.square(q).sum(1) + m2 - 2.0 * known, 0.0)) + SLACK * (1 + m2**0.5)
            low = to_pivots(q) - radii[None] - SLACK * (1 + m2**0.5)
            wanted = (radii >= 0)[None] & ~(low > reach[:, None])
            return {"id": batch["id"], "regions": [[int(r) for r in np.flatnonzero(w) if r != home] for w, home in zip(wanted, batch["home"], strict=True)]}

        return apply

    asked = cut(queries.join(kth, "id", "left"), "asked")
    routes = map_rows(asked.select("id", "v", "home", "known"), other_regions, "id long, regions array<int>")
    more = searched(asked.join(routes, "id").select("id", "v", "block", F.explode("regions").alias("region"), "known"))
    found = first.union(more).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
