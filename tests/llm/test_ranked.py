"""Ranked lexical search against scoring everything."""

import math
import random
import re
from collections import Counter

import numpy as np
from helpers import no_docs, odd_docs
from pyspark.sql import functions as F

from kgspark.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    of_item = {}
    for i, t in items:
        of_item.setdefault(i, set()).update(plain_terms(t))
    out = set()
    for item, terms in of_item.items():
        scored = []
        for place, (i, c, n) in enumerate(counts):
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, place, i))
        out |= {(item, r + 1, x[4], -x[0]) for r, x in enumerate(sorted(scored)[:k])}
    return out


def got(df):
    return {tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()}


def zipf(rng, words, most):
    return " ".join(words[min(int(rng.paretovariate(0.6)), len(words)) - 1] for _ in range(rng.randint(1, most)))


def corpus(seed=4, n=600):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, zipf(rng, words, 120)) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(70)]  # ties
    items = [(i, " ".join(rng.sample(docs[rng.randrange(n)][1].split(), 1) + [zipf(rng, words, 30)])) for i in range(25)]
    return docs, items


def test_equals_scoring_everything(spark):
    docs, items = corpus()
    d, i = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert got(ranked.ranked(d, i)) == brute(docs, items)
    small = ranked.Settings(k=5, shard_rows=150, block=4, long_list=6, common=1 / 4, seeds=8, item_terms=100)
    assert got(ranked.ranked(d, i, settings=small)) == brute(docs, items, 5)


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    items = [(1, "Alpha BETA, x é ﬁ"), (1, "word"), (2, None), (None, "gamma"), (3, "!!"), (4, "nowhere"), (5, "token token abcdef123456")]
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit("clash")).withColumn("shard", F.lit(1))
    assert got(ranked.ranked(odd_docs(spark), i)) == brute(rows, items)
    assert got(ranked.ranked(no_docs(spark), i)) == set()
    assert got(ranked.ranked(odd_docs(spark), i.filter("item_id > 90"))) == set()


def test_bounds_save_work():
    rng = np.random.default_rng(2)
    n, width = 2000, 380
    topic = rng.integers(0, 10, n)
    sets = [np.unique(np.r_[rng.integers(0, 100, 5), 100 + topic[d] * 28 + rng.integers(0, 28, 12)]) for d in range(n)]
    starts, cols = np.cumsum([0, *map(len, sets)]), np.concatenate(sets)
    gains, weights = rng.integers(100_000, 900_000, len(cols)), np.full(width, 3000)
    settings = ranked.Settings(k=10, block=16, long_list=32, common=1 / 8)
    made = {"starts": starts, "cols": cols, "gains": gains} | ranked.build(starts, cols, gains, weights, settings)
    shard = ranked.Shard({p: ranked.packed(v) for p, v in made.items()} | {"weights": weights}, settings)
    asked = sets[7]
    w = np.zeros(width, np.int64)
    w[asked] = weights[asked]
    full = np.add.reduceat(w[cols] * gains, starts[:-1])
    least = int(np.sort(full)[-10])
    docs, scores = shard.best(asked, least)
    assert dict(zip(docs.tolist(), scores.tolist())) == {int(d): int(full[d]) for d in np.flatnonzero(full >= least)}
    assert shard.skipped > 0 and shard.scored < n / 2
    for a, b, c in zip(made["block_starts"], made["block_starts"][1:], range(n)):  # summaries are exact maxima
        top = np.zeros(width, np.int64)
        for d in made["block_docs"][a:b]:
            np.maximum.at(top, cols[starts[d] : starts[d + 1]], gains[starts[d] : starts[d + 1]])
        at = slice(made["summary_starts"][c], made["summary_starts"][c + 1])
        assert (made["summary_cols"][at] == np.flatnonzero(top)).all() and (made["summary_gains"][at] == top[top > 0]).all()
