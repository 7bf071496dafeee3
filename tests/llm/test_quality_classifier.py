import zlib

import numpy as np
from messy import empty, frame, rows

from plumbline.llm import quality

SF = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(np.argsort(scores))
    return (order[labels == 1].mean() - (labels.sum() - 1) / 2) / (labels == 0).sum()


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.scored(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    scores, truth = map(np.array, zip(*held, strict=True))
    assert auc(scores, truth) > 0.97 and ((scores >= 0.5) == truth).mean() > 0.93


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a, b = (sorted((r.doc_id, r.score) for r in quality.scored(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_model_learns_an_interaction():
    draw = np.random.default_rng(4)
    x = draw.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    fresh = draw.random((1000, 3))
    truth = (fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5)
    assert ((model.scores(fresh) >= 0.5) == truth).mean() > 0.95


def test_messy_rows(spark):
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, None), (None, 1), (4, 1), (4, 0), (4, 1), (99, 0), (9, 0)], "doc_id long, quality int")
    got = quality.scored(frame(spark), labels).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in rows()), key=repr)
    none = labels.limit(0)
    assert {r.score for r in quality.scored(frame(spark), none).collect()} == {0.5}
    assert quality.scored(empty(spark), labels).count() == 0
    kept = quality.kept_documents(frame(spark), none)
    assert kept.count() == len(rows()) and kept.columns == frame(spark).columns
