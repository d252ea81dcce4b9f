"""Collocations against counting every phrase, and tiles against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from helpers import no_docs, odd_docs
from pyspark.sql import functions as F

from kgspark.llm import collocations as co


def brute(docs, least=10, top=2000):
    f, n, out = defaultdict(Counter), Counter(), set()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, of in f.items():
        found = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in found.items():
            if len(p) == 3:
                inside[p[:2]], inside[p[1:]] = max(inside[p[:2]], a), max(inside[p[1:]], a)
        rows = []
        for p, a in found.items():
            if len(p) == 2 and 100 * inside[p] >= 50 * a:
                continue
            s, k = min((1_000_000 * a * a // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), a, of[p[:k]], of[p[k:]]))
        out |= {(lang, i + 1, r[2].decode(), r[3], r[4], r[5], n[lang], -r[0]) for i, r in enumerate(sorted(rows)[:top])}
    return out


def got(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["The", "of", "é", "New", "york", "CITY", "a-b", "x", "y", "z", *[f"w{i}" for i in range(60)]]
    pick = lambda: words[min(int(rng.paretovariate(0.7)), len(words)) - 1]
    make = lambda: "".join((rng.choice(["New York city", "x y", pick()]) if rng.random() < 0.3 else pick()) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rng.randint(0, 80)))
    return [(rng.choice(["en", "en", "en", "de", None]), make()) for _ in range(n)]


def test_equals_counting_every_phrase(spark):
    docs = corpus(5, 400)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    want = brute(docs)
    assert {len(p.split()) for _, _, p, *_ in want} == {2, 3}
    assert got(co.collocations(df)) == want
    small = co.Settings(stretch=500, side=4, dense=0.5)
    assert got(co.collocations(df, settings=small)) == want
    assert got(co.collocations(df, settings=co.Settings(top=7))) == brute(docs, top=7)


def test_odd_rows(spark):
    df = odd_docs(spark).withColumn("stretch", F.lit("clash")).withColumn("key", F.lit("clash"))
    assert got(co.collocations(df)) == brute([(r.lang, r.text) for r in df.collect()])
    assert co.collocations(no_docs(spark)).count() == 0


def test_large_counts_are_exact(spark):
    a, left, right = 9_999_999_999_999_937, 9_999_999_999_999_989, 9_999_999_999_999_961
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(co.score("a", "l", "r")).first()
    assert row[0] == 1_000_000 * a * a // (left * right)


def test_tiles():
    rng = np.random.default_rng(1)
    a, b = (np.minimum(rng.pareto(0.5, 20000).astype(np.int64), 5000) for _ in range(2))
    for side, dense in ((8, 0.1), (64, 0.01), (1024, 0.5), (1024, 0.0)):
        x, y, n = co.tile_counts(a, b, side, dense)
        assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == Counter(zip(a.tolist(), b.tolist()))
    assert len(co.tile_counts(a[:0], b[:0], 8, 0.5)[2]) == 0
