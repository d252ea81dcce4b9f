"""Exact and near duplicates against small models, with hot groups and chains."""

import random
from collections import Counter

import pytest
from helpers import linked, no_docs, odd_docs, shingles
from pyspark.sql import functions as F

from kgspark.llm import exact, neardup
from kgspark.llm.common import row_key
from kgspark.llm.components import components


def test_counters_keep_what_is_frequent():
    rng = random.Random(1)
    values = [rng.choice("abc") if rng.random() < 0.6 else str(rng.random()) for _ in range(5000)]
    state = Counter()
    for k in range(0, len(values), 500):
        state = exact.misra_gries(values[k : k + 500], 8, state)
    assert len(state) <= 8 and {"a", "b", "c"} <= set(state)
    assert all(n <= Counter(values)[v] for v, n in state.items())


@pytest.mark.parametrize("slots", [1, 64])
def test_exact_groups(spark, slots):
    rng = random.Random(2)
    docs = [(i, rng.choice(["same  text", "same text", "other", "", None, f"own {i}", " so\tme thing"])) for i in range(400)]
    norm = lambda t: "".join(c for c in t or "" if c not in exact.WHITE)
    groups = {}
    for i, t in docs:
        groups.setdefault(norm(t), []).append((-len(t or ""), i))
    found = exact.exact_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), slots=slots).collect()
    assert len(found) == len(docs)
    for r in found:
        own = groups[norm(dict(docs)[r.doc_id])]
        assert (r.keep_id, r.group_size, r.kept) == (min(own)[1], len(own), min(own)[1] == r.doc_id)


def test_exact_odd_tables(spark):
    docs = odd_docs(spark)
    found = exact.exact_groups(docs).collect()
    assert len(found) == docs.count() and sum(r.kept for r in found) == len({r.text_sha256 for r in found})
    assert {r.keep_id for r in found if r.doc_id in (1, 6, 7)} == {7}  # the most code points
    assert {r.keep_id for r in found if r.doc_id in (2, 3, 4)} == {4}
    left = exact.drop_exact(docs)
    assert left.columns == docs.columns and left.count() == len({r.text_sha256 for r in found})
    assert exact.exact_groups(no_docs(spark)).count() == 0 == exact.drop_exact(no_docs(spark)).count()


def near_copies(seed: int = 3):
    """Originals with edited copies, a group whose smallest id is a distant copy, a chain, and a shared passage."""
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randint(0, 50_000)}" for _ in range(n)]

    def edit(ws, k):
        ws = list(ws)
        for p in rng.sample(range(len(ws)), k):
            ws[p] = f"e{rng.randint(0, 10**6)}"
        return ws

    docs, i = [], 0
    passage = words(120)
    for _ in range(12):
        original = words(rng.choice([6, 30, 120, 400]))
        for k in range(6):
            docs.append((i := i + 1, " ".join(edit(original, min(len(original) // 40, 4)) if k else original)))
    star = words(300)
    docs += [(i := i + 1, " ".join(edit(star, 5))) for _ in range(40)] + [(i := i + 1, " ".join(star))]
    chain = words(200)
    for _ in range(8):
        docs.append((i := i + 1, " ".join(chain)))
        chain = edit(chain, 4)
    docs += [(i := i + 1, " ".join(words(60) + passage + words(60))) for _ in range(30)]
    return docs + [(i := i + 1, t) for t in ("", None, " \n", "one two", "ONE  two", "one two three")] + [(i := i + 1, docs[0][1].upper()) for _ in range(30)]


def test_near_duplicates(spark):
    docs = near_copies()
    want = linked(docs)
    found = neardup.near_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    assert all(r.n_shingles == len(shingles(dict(docs)[r.doc_id])) and r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_odd_tables(spark):
    found = neardup.near_classes(odd_docs(spark)).collect()
    assert len(found) == odd_docs(spark).count()
    assert {r.component_id for r in found if r.doc_id in (1, 6, 7)} == {1}
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id and r.kept for r in found if r.doc_id in (2, 3, 4))
    assert neardup.near_classes(no_docs(spark)).count() == 0


def test_an_id_with_two_texts_links_them(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "p q r s t u v"), (3, "p q r s t u v"), (None, "p q r s t u v"), (None, "lone words of no id")]
    found = [(r.doc_id, r.component_id, r.kept) for r in neardup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(found, key=str) == sorted([(1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (None, 1, False), (None, None, True)], key=str)


def test_near_copies_of_both_texts_of_an_id_are_linked(spark):
    rng = random.Random(4)
    a, b = ([f"w{rng.randint(0, 9999)}" for _ in range(60)] for _ in range(2))
    near = lambda ws: " ".join([*ws[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, " ".join(f"x{i}" for i in range(60)))]
    for order in (rows, rows[::-1]):
        found = {(r.doc_id, r.component_id) for r in neardup.near_classes(spark.createDataFrame(order, "doc_id long, text string").repartition(3)).collect()}
        assert found == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_long_texts_in_crowded_buckets(spark):
    """Chains of texts of 900 words, in which far ones are unlike: what two stars leave is searched by sketches in tiles."""
    rng = random.Random(6)
    docs = []
    for c in range(3):
        ws = [f"c{c}w{rng.randint(0, 10**6)}" for _ in range(900)]
        for k in range(14):
            docs.append((100 * c + k, " ".join(ws)))
            for p in rng.sample(range(900), 18):
                ws[p] = f"n{c}_{k}_{p}"
    rng.shuffle(docs)
    found = {r.doc_id: r.component_id for r in neardup.near_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert found == linked(docs) and len(set(found.values())) == 3


def test_rows_are_told_apart_however_they_were_made(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta"
    spark.createDataFrame([(1, [words, words, "x y z"]), (2, [f"{words} eta theta iota kappa"])], "doc_id long, texts array<string>").write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    docs = stored.select("doc_id", F.explode("texts").alias("text"))  # three rows of one row of a file
    assert row_key(stored.filter("doc_id = 1"))[0] is not None and row_key(docs)[0] is not docs
    assert sorted(r.text for r in exact.drop_exact(docs).collect()) == sorted([words, "x y z", f"{words} eta theta iota kappa"])
    assert sorted((r.doc_id, r.component_id, r.kept) for r in neardup.near_classes(docs).collect()) == [(1, 1, True)] * 3 + [(2, 2, True)]
    assert row_key(stored)[0] is stored and row_key(stored.select("doc_id").filter("doc_id > 0"))[1] is not None


def test_components(spark):
    path = [(k + 1, k) for k in range(50)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(51)} | {100: 100, 101: 100}
