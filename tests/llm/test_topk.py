from itertools import islice

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import topk


def brute(rows, k, is_query):
    out = []
    usable = [(i, v) for i, v in rows if i is not None]
    queries = {}
    for i, v in usable:
        if is_query(i):
            queries[i] = min(queries.get(i, v), v)
    for q, v in queries.items():
        scores = sorted((-int(np.dot(v, w)), i) for i, w in usable if i != q and len(w) == len(v))
        out += [(q, at + 1, i, -s) for at, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_blocks_ties_repeats_and_dimensions(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES", 12)
    draw = np.random.default_rng(1)
    rows = [(k, draw.integers(-9, 9, 6).tolist()) for k in range(300)]
    rows += [(k, rows[k - 400][1]) for k in range(400, 440)]  # ties
    rows += [(7, [1, 2, 3, 4, 5, 6]), (10, [0] * 6), (None, [9] * 6)]  # repeated ids, no id
    rows += [(500, [5]), (501, [-3]), (502, [4]), (510, [])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5, lambda i: i % 10 == 0)


def test_large_components_stay_exact(spark):
    rows = [(k, [2_000_000_000 + k, -100_000_007 * k]) for k in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 3).collect()
    exact = []
    for q in (0, 10):
        scores = sorted((-sum(a * b for a, b in zip(rows[q][1], w, strict=True)), i) for i, w in rows if i != q)
        exact += [(q, at + 1, i, -s) for at, (s, i) in enumerate(scores[:3])]
    assert sorted(tuple(r) for r in got) == sorted(exact)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [0.5, 1.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [-0.0005, 0.25]), (6, [0.5, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    ints = topk.integers(df, "vec_id", "embedding")
    assert sorted((r.vec_id, r.vec) for r in ints.collect()) == [(0, [512, 1024]), (5, [-1, 256]), (6, [512, 1024])]
    got = topk.top_k(ints, F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 6, 512 * 512 + 1024 * 1024), (0, 2, 5, -512 + 1024 * 256)]
    assert topk.top_k(ints.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_a_block_of_more_queries_than_a_slice(spark):
    draw = np.random.default_rng(5)
    rows = [(k, draw.integers(-50, 50, 8).tolist()) for k in range(2 * topk.SLICE + 90)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>").repartition(2)
    got = topk.top_k(df, F.lit(True), 4).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4, lambda i: True)


def test_shares_groups_and_waves(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("QUERIES", 12), ("SHARE", 100), ("GROUP", 100), ("WAVE", 4)):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(3)
    rows = [(k, draw.integers(-9, 9, 6).tolist()) for k in range(280)]
    rows += [(k, rows[40][1]) for k in range(300, 340)] + [(7, [1, 2, 3, 4, 5, 6]), (10, [0] * 6), (None, [9] * 6), (510, [5]), (511, [-3])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>").repartition(3)
    found = topk.top_k(df, F.col("vec_id") % 10 == 0, 5)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 5, lambda i: i % 10 == 0)
    # rows that come from one by an explode are all in memory at once
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_copies_leave_one_at_a_time():
    batch = pa.RecordBatch.from_pydict({"own": [b"x" * 100, b"y"], "first": [3, 5], "last": [10**15, 5]})
    some = list(islice(topk._copies("share")(iter([batch])), 4))
    assert [b.to_pylist() for b in some] == [[{"own": b"x" * 100, "share": k}] for k in range(3, 7)]


def share_of(rows, blocks):
    """Vectors as a share of several blocks."""
    parts = [rows[i::blocks] for i in range(blocks)]
    schema = {"dim": pa.int32(), "share": pa.int64(), "vec_id": pa.int64(), "vec": pa.list_(pa.int64())}
    return pa.concat_tables(topk._pack(pa.table({n: pa.array(x, t) for (n, t), x in zip(schema.items(), ([len(part[0][1])] * len(part), [0] * len(part), *zip(*part, strict=True)), strict=True)})) for part in parts)


@pytest.mark.parametrize(("top", "copies", "k"), [(9, 0, 5), (9, 200, 5), (700, 50, 10), (2**20, 0, 3), (2**29, 30, 3), (700, 0, 120)])
def test_a_share_gives_the_best_of_its_rows(monkeypatch, top, copies, k):
    monkeypatch.setattr(topk, "SLICE", 16)
    monkeypatch.setattr(topk, "READ", 4)
    draw = np.random.default_rng(top % 1000 + k)
    rows = [(i, draw.integers(-top, top, 7).tolist()) for i in range(900)]
    rows += [(900 + i, rows[30][1]) for i in range(copies)]
    ask = rows[:900:20]
    best = brute(rows, k, lambda i: i % 20 == 0 and i < 900)
    kth = {q: score for q, at, _, score in best if at == k}
    vectors = share_of(rows, 3)
    # without a score to reach, with one that is reached, and with the kth best of all
    for reach in ([topk._NONE] * len(ask), [kth[i] - 5 if n % 2 else topk._NONE for n, (i, _) in enumerate(ask)], [kth[i] for i, _ in ask]):
        columns = {"dim": pa.array([7] * len(ask), pa.int32()), "group": pa.array([0] * len(ask), pa.int64()), "query_id": [i for i, _ in ask], "vec": [v for _, v in ask], "reach": reach}
        found = topk._found(k)(topk._gather(pa.table(columns)), vectors)
        assert sorted(zip(*(found.column(c).to_pylist() for c in ("query_id", "vec_id", "score")), strict=True)) == sorted((q, i, s) for q, _, i, s in best)
