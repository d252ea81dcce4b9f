"""Top-k search against all pairs."""


import numpy as np
from pyspark.sql import functions as F

from kgspark.llm import mtree


def brute(rows, k=5, every=50):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok[i] = min(ok.get(i, v), v)
    whole = {i: [int(np.floor(256 * float(x))) for x in v] for i, v in ok.items()}
    out = set()
    for q, a in whole.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items() if i != q)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def rows_of(seed: int, n: int, size: int = 12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, size))
    v = centres[rng.integers(0, 5, n)] + 0.3 * rng.normal(size=(n, size))
    v[: n // 3] = v[0]  # a hot vector
    v[n // 3 : n // 2] = np.round(v[n // 3 : n // 2])  # ties
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]


def got(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


def test_equals_all_pairs(spark):
    rows = rows_of(1, 900)
    odd = [(1001, None), (1002, [1.0, None] + [0.0] * 10), (1000, [float("nan")] * 12), (1050, [float("inf")] * 12), (None, [1.0] * 12), (1100, [2.0]), (1100, [3.0]), (1150, []), rows[3], rows[3]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("region", F.lit(1))
    small = mtree.Settings(pivots=7, sample=100, slice_rows=100, page=8, fan_out=4, block=10)
    assert got(mtree.top_k(df, lambda i: i % 50 == 0, settings=small)) == brute(rows + odd)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert got(mtree.top_k(df, lambda i: i % 50 == 0)) == brute([tuple(r) for r in df.collect()])
    assert mtree.top_k(df.filter("vec_id < 0"), lambda i: i % 50 == 0).count() == 0
    assert mtree.top_k(df.filter("vec_id = 0"), lambda i: i % 50 == 0).count() == 0


def test_bounds_save_work():
    rows = rows_of(2, 4000)
    v = np.floor(256 * np.array([x for _, x in rows])).astype(np.int64)
    tree = mtree.Tree(np.arange(len(v)), v, float(np.square(v).sum(axis=1).max()))
    best = tree.search(17, v[17], 5, [])
    want = sorted((-int(s), i) for i, s in enumerate(v @ v[17]) if i != 17)[:5]
    assert best == want and tree.computed < len(v) * 0.9

    assert all(p.radius >= 0 and bool(p.children) == (p.distances is None) for p in tree.pages)
