"""The classifier on held-out rows."""

import zlib

import numpy as np
from helpers import no_docs, odd_docs

from kgspark.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in quality.with_scores(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    test = [(rows[r.doc_id].predicted, r.quality) for r in labels.collect() if r.doc_id in rows and rows[r.doc_id].held_out]
    assert np.mean([a == b for a, b in test]) > 0.97
    # Held-out labels and other columns change nothing.
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality")
    again = quality.with_scores(docs.selectExpr("doc_id", "text", "'x' as lang", "'y' as features", "1 as id"), turned).collect()
    assert all(rows[r.doc_id].score == r.score for r in again)


def test_factors_are_those_of_shrunken_covariances(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (60, quality.SIZE)), rng.normal(1, 2, (90, quality.SIZE))])
    y = [0] * 60 + [1] * 90
    model = quality.fit(spark.createDataFrame([(v.tolist(), k) for v, k in zip(x, y, strict=True)], "features array<double>, label int"))
    for k in (0, 1):
        own = [np.cov(x[np.array(y) == c].T, bias=True) for c in (0, 1)]
        c = 0.9 * own[k] + 0.1 * (60 * own[0] + 90 * own[1]) / 150
        c = 0.98 * c + 0.02 * (np.trace(c) / quality.SIZE + 1e-6) * np.eye(quality.SIZE)
        assert np.allclose(model.factors[k] @ c @ model.factors[k].T, np.eye(quality.SIZE), atol=1e-6)
    assert ((model.scores(x) >= 0.5) == np.array(y)).mean() > 0.9


def test_odd_tables(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (6, 1), (None, 1), (9, None), (5, 0)], "doc_id long, quality int")
    for table in (labels, labels.filter("doc_id < 0"), labels.filter("quality = 1")):
        assert quality.with_scores(docs, table).count() == docs.count()
    assert quality.with_scores(no_docs(spark), labels).count() == 0
    good = quality.keep_good(docs, labels)
    assert good.columns == docs.columns
