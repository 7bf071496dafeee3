import random

from messy import empty, frame

from plumbline.llm import licenses


def test_notices_are_found_where_they_stand_and_nowhere_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    notices = {k: v for k, v in licenses.TEMPLATES.items() if k.endswith("notice")}
    expected = sorted((r.doc_id, k, r.text.find(v)) for r in docs.collect() for k, v in notices.items() if v in (r.text or ""))
    got = licenses.scan(docs).collect()
    assert sorted((r.doc_id, r.license, r.start) for r in got) == expected and all(r.coverage == 1 for r in got)


def test_damaged_and_repeated_texts(spark):
    mit = licenses.TEMPLATES["MIT"].split()
    n = len(next(iter(w for w in [licenses.Index(licenses.TEMPLATES)])).words[licenses.Index(licenses.TEMPLATES).names.index("MIT")])
    own = list(mit)
    own[20] = "other"
    del own[40]
    docs = [(1, "é " + " ".join(own) + " and more"), (2, " ".join(mit[:30])), (3, "x ".join(["Released under the MIT License."] * 40)), (4, None)]
    got = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    first = [r for r in got if r.doc_id == 1]
    assert len(first) == 1 and first[0].license == "MIT" and first[0].matched == n - 2 and first[0].start == 2
    assert docs[0][1][first[0].start : first[0].end] == " ".join(own).rstrip(".")
    assert not [r for r in got if r.doc_id == 2] and len([r for r in got if r.doc_id == 3]) == 40


def found(spark, texts, **more):
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **more).collect()
    return [[(r.license, round(r.coverage, 2)) for r in sorted(rows, key=lambda r: r.start) if r.doc_id == k] for k in range(len(texts))]


def test_every_licence_is_told_from_every_other(spark):
    names = sorted(licenses.TEMPLATES)
    texts = [f"Some words before. {licenses.TEMPLATES[n]} And some words after." for n in names]
    assert found(spark, texts) == [[(n, 1.0)] for n in names]


def test_a_licence_that_is_not_known_is_none(spark):
    gpl, bsd = licenses.TEMPLATES["GPL-3.0-or-later"], licenses.TEMPLATES["BSD-3-Clause"]
    texts = [
        "Licensed under CC BY-XY 4.0.",
        "Licensed under CC BY-NC-ND 3.0.",
        "This work is licensed under the GNU Free General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 4.",
        gpl.replace("version 3", "version 4"),
        gpl.replace("GNU General", "GNU Library General"),
        bsd[: bsd.index(" 3. ")],  # conditions alone
    ]
    assert found(spark, texts)[:5] == [[]] * 5
    assert found(spark, texts)[6] == []


def test_damage_leaves_a_long_licence_known(spark):
    texts = []
    for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-or-later", "Zlib"):
        words = licenses.TEMPLATES[name].split()
        words[3] = "damaged"
        del words[len(words) // 2]
        texts.append(" ".join(words))
    assert [[n for n, _ in f] for f in found(spark, texts)] == [["MIT"], ["BSD-2-Clause"], ["BSD-3-Clause"], ["GPL-2.0-or-later"], ["Zlib"]]


def test_index_and_band_lose_nothing_against_whole_alignments(spark):
    """Every template aligned over every diagonal, without index or band."""
    index, draw = licenses.Index(licenses.TEMPLATES), random.Random(3)
    texts = []
    for name in licenses.TEMPLATES:
        words = licenses.TEMPLATES[name].split()
        for _ in range(len(words) // 25):
            words[draw.randrange(len(words))] = "other"
        texts.append("before it " + " ".join(words) + " behind")
    got = found(spark, texts)
    for text, rows in zip(texts, got, strict=True):
        own = next(iter(w for _, w in licenses.words_of(licenses.pa.array([text]), table=licenses.ALNUM))).hashes
        best = []
        for k, goal in enumerate(index.words):
            n, first, last = licenses.align(own, goal, -len(goal), len(own))
            if n and n >= min(len(goal), max(licenses.WORDS, licenses.LEAST * len(goal))) and index.told(k, own[first:last], n):
                best.append((-n, -n / len(goal), index.names[k]))
        assert [r[0] for r in rows] == [b[2] for b in sorted(best)[:1]]


def test_messy_rows(spark):
    got = licenses.scan(frame(spark)).collect()
    assert [(r.doc_id, r.license, r.start, r.end) for r in got] == [(10, "MIT-notice", 0, 30)]
    assert licenses.scan(empty(spark)).count() == 0
    assert licenses.scan(frame(spark), templates={}).count() == 0
