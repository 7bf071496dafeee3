import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from messy import empty, frame, rows

from plumbline.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def counted(docs, least, deletions):
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if deletions and h % deletions == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= least:
                n[word] += 1
    return n


def brute(n, factor=10):
    neighbours = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, some in neighbours.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(neighbours[w]), n.get(form[w])))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_near_is_one_edit():
    draw = random.Random(1)
    words = sorted({"".join(draw.choices("abcé", k=draw.randint(1, 5))) for _ in range(300)})
    found = set()
    for q, t, longer in spelling.near_pairs(words, words):
        for i, j in zip(q.tolist(), t.tolist(), strict=True):
            assert (i, j) not in found
            found.add((i, j))
            if longer:
                found.add((j, i))
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b)}


def test_boxes_in_reach_hold_all_near_words():
    draw = random.Random(2)
    words = sorted({"".join(draw.choices("aabcdeé×", k=draw.randint(7, 9))) for _ in range(600)})
    points = spelling.letters(words)
    tree, ends = spelling.grow(points, 10)
    assert max(map(len, ends)) <= 10 or all((points[e] == points[e[0]]).all() for e in ends if len(e) > 10)
    home = spelling.home(tree, points)
    assert all((home[e] == k).all() for k, e in enumerate(ends))
    asked = set()
    for longer in (0, 1):
        for box, some in spelling.reached(tree, points, longer, True):
            asked |= {(longer, box, int(q)) for q in some}
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if near(a, b) and len(b) >= len(a):
                assert (len(b) - len(a), home[j], i) in asked
    assert len(asked) < tree.boxes * len(words) / 4


def test_variants_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BOX", 8)
    monkeypatch.setattr(spelling, "QUERIES", 20)
    monkeypatch.setattr(spelling, "SAMPLE", 200)
    draw = random.Random(3)
    n = {}
    for _ in range(40):
        word = "".join(draw.choices("abcdefghijklmnopqrstuvwxyzßéàÉ×", k=draw.randint(7, 12)))
        n[word] = draw.choice([100, 1000, 1000])
        for _ in range(12):
            at = draw.randrange(len(word))
            other = draw.choice([word[:at] + word[at + 1 :], word[:at] + "q" + word[at:], word[:at] + "ü" + word[at + 1 :]])
            n.setdefault(other, draw.choice([2, 10, 10, 99, 100]))
    n["".join(draw.choices("acgt", k=20))] = 5
    n |= {"".join(draw.sample("acgtacg", 7)): draw.choice([1, 10, 100]) for _ in range(150)}  # words of the same letters
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    assert got(spelling.variants(df)) == brute(n)
    assert got(spelling.variants(df, 2)) == brute(n, 2)


def test_forms_are_followed_to_the_last(spark):
    n = {"abcdefg" + "x" * k: 10**k for k in range(12)}
    out = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert {r.root for r in out.collect()} == {"abcdefg" + "x" * 11}
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0


@pytest.mark.parametrize("deletions", [None, 2])
def test_words_of_texts(spark, deletions):
    df = frame(spark)
    n = {w: c for w, c in counted([r[:2] for r in rows()], 3, deletions).items() if c >= 2}
    assert got(spelling.groups(df, least=3, occurs=2, deletions=deletions)) == brute(n)
    assert spelling.groups(empty(spark), deletions=31).count() == 0


def test_runs_of_a_hundred_thousand_letters(spark):
    text = "a" * 100_000 + " " + "É" * 100_000 + " " + "a" * 100_001
    df = spark.createDataFrame([(1, text + " " + text)], "doc_id long, text string")
    out = {(len(r.word), r.word[0]): r.n_near for r in spelling.groups(df).collect()}
    assert out == {(100_000, "a"): 1, (100_001, "a"): 1, (100_000, "É"): 0}


def test_marks_never_tell_near_words_apart():
    draw = random.Random(9)
    for _ in range(500):
        word = "".join(draw.choices("aaabcé", k=draw.randint(1, 9)))
        at, letter = draw.randrange(len(word)), draw.choice("abxé")
        bits = spelling.marks(spelling.letters([word, word[:at] + letter + word[at + 1 :], word[:at] + letter + word[at:]]))
        assert (bits[0] ^ bits[1]).item().bit_count() <= 2 and (bits[0] ^ bits[2]).item().bit_count() <= 1


def test_counts_of_letters():
    points = spelling.letters(["abca", "é×"])
    assert points[:, 0].tolist() == [4, 2]
    assert points[0, 1:4].tolist() == [2, 1, 1]
    assert np.array_equal(points[:, 1:].sum(axis=1), points[:, 0])
