"""The pipeline's stages, one after another, against small models."""

import re

import corpus_pipeline
from helpers import linked, no_docs, odd_docs, secret

from kgspark.llm import quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    good = corpus_pipeline.cut(stages[0](spark, docs, SF), "t")
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
    left = {r.doc_id for r in good.select("doc_id").collect()}
    assert len(left & bad) <= 0.2 * len(bad) and good.count() >= 0.8 * docs.count()
    unlike = corpus_pipeline.cut(stages[1](spark, good, SF), "t")
    bare = lambda t: "".join(c for c in t if c not in " \t\n\x0b\x0c\r")
    assert sorted(bare(r.text) for r in unlike.collect()) == sorted({bare(r.text) for r in good.collect()})
    single = corpus_pipeline.cut(stages[2](spark, unlike, SF), "t")
    want = linked([(r.doc_id, r.text) for r in unlike.collect()])
    assert {r.doc_id for r in single.collect()} == {i for i, to in want.items() if i == to}
    safe = corpus_pipeline.cut(stages[3](spark, single, SF), "t")
    assert safe.columns == docs.columns and safe.count() == single.count()
    assert not any(secret(r.text) or r.n_chars != len(r.text) for r in safe.collect())
    assert {r.doc_id for r in stages[4](spark, safe, SF).collect()} == {r.doc_id for r in safe.collect()}


def stages_of(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, SF), "t")
        yield name, docs


def test_odd_rows_pass_all_stages(spark):
    docs = odd_docs(spark)
    good = {r.doc_id for r in quality.with_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    after = dict(stages_of(spark, docs))
    assert all(df.columns == docs.columns for name, df in after.items() if name != "packing")
    kept = sorted(((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good), key=str)
    got = lambda name: sorted(((r.doc_id, r.text) for r in after[name].collect()), key=str)
    assert got("quality classifier") == kept
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    best = {}
    for i, t in kept:  # of equal texts the longest, then the smallest id
        key = (-len(t or ""), i is None, i or 0)
        best[bare(t)] = min(best.get(bare(t), (key, i, t)), (key, i, t), key=lambda x: x[0])
    assert got("exact dedup") == sorted([x[1:] for x in best.values()], key=str)
    assert got("near dedup") == got("exact dedup")  # what is left is unlike
    masked = [(i, "token = [SECRET] [SECRET]" if secret(t or "") else t) for i, t in got("near dedup")]
    assert got("secret scans") in (sorted(masked, key=str), sorted([(i, "[SECRET] [SECRET]" if "SECRET" in (t or "") else t) for i, t in masked], key=str))
    assert {r.doc_id for r in after["packing"].collect()} == {i for i, _ in got("secret scans")}


def test_no_rows_and_few_columns(spark):
    for docs in (no_docs(spark), no_docs(spark).select("doc_id", "text"), odd_docs(spark).select("text", "doc_id")):
        after = dict(stages_of(spark, docs))
        assert all(df.columns == docs.columns for name, df in after.items() if name != "packing")
        assert (after["packing"].count() > 0) == (docs.count() > 0)


def test_near_copies_are_dropped_row_by_row(spark):
    copied, other = "a b c d e f g h", "lone words of a text that nothing else is like"
    rows = [(1, copied), (None, copied.upper()), (None, other), (2, "p q r s t u v w"), (2, f"{copied} a b c d e f g h"), (2, "k l m n o p q"), (3, "P q r s t u v w"), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.without_near_copies(spark, docs, SF).collect()]
    # The second text of id 2 has four more shingles than the first row: 4 of 8 are not similar enough.
    want = [(1, copied), (None, other), (2, "p q r s t u v w"), (2, f"{copied} a b c d e f g h"), (2, "k l m n o p q"), (None, None), (None, "")]
    assert sorted(left, key=str) == sorted(want, key=str)
