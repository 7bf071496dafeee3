import random
import tracemalloc

import numpy as np
import pyarrow as pa
from messy import empty, frame, lower, rows, words

from plumbline.llm import jaccard_join
from plumbline.llm.components import components


def brute(docs, width, percent):
    sets = []
    for _, t in docs:
        w = words(lower(t or ""))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, len(sets[k]), least.get(top(k)) if sets[k] else i) for k, (i, _) in enumerate(docs)), key=repr)


def test_messy_rows(spark):
    got = jaccard_join.near_copies(frame(spark), width=4, percent=85).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([(r[0], r[1]) for r in rows()], 4, 85)
    assert jaccard_join.near_copies(empty(spark)).count() == 0
    one = jaccard_join.one_of_each(frame(spark))
    assert one.columns == frame(spark).columns


def test_near_copies_around_the_threshold_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    draw = random.Random(8)
    docs = []
    for group in range(6):
        base = [f"{group}w{k}" for k in range(60)]
        for _ in range(40 if group == 0 else 6):
            own = list(base)
            for _ in range(draw.randint(0, 4)):
                own[draw.randrange(60)] = f"x{draw.randrange(9)}"
            docs.append((len(docs), " ".join(own)))
    docs += [(len(docs) + k, "a b c d " * 5 + f"tail {k % 2}") for k in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = jaccard_join.near_copies(df, width=4, percent=85).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, 4, 85)


def test_components(spark):
    draw = random.Random(2)
    links = [(k, k + 1) for k in range(100, 160)] + [(draw.randrange(40), draw.randrange(40)) for _ in range(25)] + [(5, 5)]
    got = {r.a: r.b for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for link in links for x in link}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        ra, rb = top(a), top(b)
        root[max(ra, rb)] = min(ra, rb)
    assert got == {x: top(x) for x in root if top(x) != x}


def test_one_row_of_each_component_stays(spark):
    got = sorted(((r.doc_id, r.text) for r in jaccard_join.one_of_each(frame(spark)).collect()), key=repr)
    expected = {(r[0], r[1]) for r in rows()} - {(r[0], r[1]) for r in rows()[5:7]}
    assert got == sorted(expected, key=repr)
    long = [" ".join(f"{g}w{k}" for k in range(60)) for g in range(3)]
    docs = [(1, long[0]), (7, long[0] + " more"), (7, long[1]), (7, long[2]), (None, long[2]), (None, long[2]), (None, "no id but twice"), (None, "no id but twice"), (9, ""), (9, "")]
    got = jaccard_join.one_of_each(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([docs[0], docs[2], docs[3], docs[6], docs[8], docs[9]], key=repr)


def test_a_fragment_is_counted_in_few_arrays_of_its_length():
    ids = np.random.default_rng(5).integers(0, 2**64, 400_000, dtype=np.uint64)
    ids = np.concatenate([np.sort(ids), np.sort(ids)[:50]])
    n = np.array([400_000, 50], dtype=np.int32)
    columns = (np.array([1, 2], dtype=np.int64).tobytes(), n.tobytes(), n.tobytes(), jaccard_join._bytes_of(ids).tobytes())
    table = pa.table([pa.array([c], pa.binary()) for c in columns], names=["sigs", "sizes", "counts", "ids"])
    tracemalloc.start()
    out = jaccard_join._shared(1)(table).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [np.frombuffer(r["counts"], dtype=np.int32).tolist() for r in out] == [[50, 50]]
    assert set(np.frombuffer(out[0]["df"], dtype=np.int32)) == {2}
    assert peak < 40 * len(ids)  # five numbers of eight bytes
