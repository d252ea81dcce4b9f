"""SimHash classes against all pairs, and BK-trees against plain distances."""

import random

import numpy as np
import xxhash
from helpers import no_docs, odd_docs, some_texts

from kgspark.llm import simhash


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints):
    """prints: (id or None, fingerprint) -> smallest id by fingerprint, comparing all pairs."""
    values = sorted({p for _, p in prints})
    to = {p: p for p in values}

    def root(x):
        while to[x] != x:
            x = to[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                to[root(a)] = root(b)
    least = {}
    for i, p in prints:
        r = root(p)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return {p: least[root(p)] for p in values}


def check(spark, rows, settings=simhash.Settings()):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in simhash.near_classes(df, settings=settings).collect()]
    prints = [(i, plain_print(t)) for i, t in rows]
    of = components_of(prints)
    assert sorted(got, key=str) == sorted([(i, f"{p:016x}", of[p]) for i, p in prints], key=str)
    return got


def test_spark_hashes_alike(spark):
    from pyspark.sql import functions as F

    one = spark.createDataFrame([("a b c é",)], "t string").select(F.xxhash64("t")).first()[0]
    assert one % 2**64 == xxhash.xxh64("a b c é".encode(), seed=42).intdigest()


def test_equals_all_pairs(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 40)) for _ in range(rng.randint(20, 300))) for _ in range(60)]
    rows = list(enumerate(base))
    for i in range(60, 300):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "new"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, t) for i, t in enumerate(some_texts(5, 80, ["A ", "b ", "é", " C\n", "\t", "d  "]))]
    got = check(spark, rows)
    assert 1 < len({c for _, _, c in got}) < len(rows)
    check(spark, rows, simhash.Settings(tree=4, block=3, slots=3))


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    df = odd_docs(spark)
    got = sorted(map(tuple, simhash.near_classes(df).collect()), key=str)
    of = components_of([(i, plain_print(t)) for i, t in rows])
    assert got == sorted([(i, f"{plain_print(t):016x}", of[plain_print(t)]) for i, t in rows], key=str)
    assert simhash.near_classes(no_docs(spark)).count() == 0


def test_trees_find_what_distances_find():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([rng.integers(0, 2**63, 500, dtype=np.uint64), np.repeat(centre, 30) ^ (np.uint64(1) << rng.integers(0, 64, 1200, dtype=np.uint64))]))
    tree = np.sort(rng.integers(0, 3, len(values)))
    order, parents, keys = simhash.grow(values, tree)
    kept = values[order]
    assert sorted(order) == list(range(len(values)))
    for i, (p, k) in enumerate(zip(parents, keys)):
        assert p < 0 or (kept[p] ^ kept[i]).item().bit_count() == k
    forest = simhash.Forest(kept, parents, keys)
    roots = np.flatnonzero(parents < 0)
    found = set()
    for who, node in forest.within(kept, roots[tree[order]], 4):
        found |= set(zip(who.tolist(), node.tolist()))
    want = {(a, b) for a in range(len(kept)) for b in range(len(kept)) if tree[order[a]] == tree[order[b]] and (kept[a] ^ kept[b]).item().bit_count() <= 4}
    assert found == want
    assert forest.visited < len(kept) ** 2 / 3


def test_crowded_shards_lose_no_link(spark):
    """Prints that share most bits, in shards that are dealt again and sliced."""
    rng = random.Random(9)
    prints = sorted({(0xF0F0 << 40) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(400)})
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "print long")
    settings = simhash.Settings(tree=16)
    dealt = simhash.shards(df, settings)
    assert dealt.filter("slices > 1").count() > 0
    found = simhash.links(simhash.trees(dealt), settings).collect()
    assert all(((r.u ^ r.v) % 2**64).bit_count() > 0 for r in found)
    to = {p: p for p in prints}

    def root(x):
        while to[x] != x:
            x = to[x]
        return x

    for r in found:
        to[root(r.u % 2**64)] = root(r.v % 2**64)
    want = components_of([(p, p) for p in prints])
    groups = lambda of: {frozenset(p for p in prints if of(p) == x) for x in {of(p) for p in prints}}
    assert groups(root) == groups(want.get)
