from collections import Counter

import pytest
from messy import empty, frame, rows, words

from plumbline.llm import mixing


def brute_targets(sizes, repeats=3):
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: k % 3 + 1 for k, n in enumerate(names)}
    done = set()
    while True:
        left = sum(sizes.values()) - sum(repeats * sizes[n] for n in done)
        rate = left / sum(weight[n] for n in names if n not in done)
        new = {n for n in names if n not in done and rate * weight[n] > repeats * sizes[n]}
        if not new:
            return {n: repeats * sizes[n] if n in done else rate * weight[n] for n in names}
        done |= new


def test_targets_stop_and_share_the_rest(spark):
    sizes = {"a": 1000, "b": 10, "c": 5, "d": 300, None: 2}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    expected = brute_targets(sizes)
    assert got.keys() == expected.keys()
    assert all(abs(got[n] - expected[n]) < 1e-6 for n in got)


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = [(k, " ".join(f"w{j}" for j in range(k % 37 + 1)), "abcd"[min(k % 11, 3)] if k % 50 else None) for k in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    mixed, placed = mixing.mix(df, block=8, shard=256, bucket=200)
    got = mixing.taken(mixed, placed).collect()
    source = {d: s for d, _, s in docs}
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r["size"] == len(words(docs[r.doc_id][1])) and 0 <= r.taken <= 3 * r["size"]
        size[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    expected = brute_targets(dict(size))
    for n in size:
        assert abs(target[n] - expected[n]) < 1e-6 and abs(taken[n] - target[n]) <= 16
    again = mixing.taken(*mixing.mix(df.repartition(3), block=8, shard=256, bucket=200)).collect()
    assert sorted(got) == sorted(again)


def test_permutations_are_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 1000):
        rows_ = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n), F.lit(5)).alias("x")).collect()
        assert sorted(r.x for r in rows_) == list(range(n))


def test_messy_rows(spark):
    got = mixing.taken(*mixing.mix(frame(spark))).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows())
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert mixing.taken(*mixing.mix(empty(spark))).count() == 0


def test_mixed_documents_hold_the_words_taken(spark):
    df = frame(spark)
    mixed, placed = mixing.mix(df)
    wanted = sum(r.taken for r in mixing.taken(mixed, placed).collect())
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.schema == df.schema
    got = out.collect()
    assert sum(len(words(r.text)) for r in got) == wanted
    known = {r[0]: set() for r in rows()}
    for r in rows():
        known[r[0]] |= set(words(r[1]))
    assert all(set(words(r.text)) <= known[r.doc_id] for r in got)
    assert mixing.mixed_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("text, n", [("", 0), (" \n", 0), ("a", 1), (" a\x0bb\x1cc ", 2), ("é　x y", 2)])
def test_word_count(spark, text, n):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(mixing.word_count(F.col("t")).alias("n")).first().n == n == len(words(text))
