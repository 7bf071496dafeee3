import hashlib
import random

from messy import empty, frame, rows

from plumbline.llm import fingerprints

SF = "/root/testdata/sf0.01"


def test_edits_digests_and_likeness(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in fingerprints.compared(docs).collect()}
    lined = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    by_text = {}
    for k, (i, text) in enumerate(lined):
        after, half = lined[(k + 1) % len(lined)], len(text) // 2
        edited = text[: len(text) - half] + after[1][:half]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        pairs = list(zip(row.fingerprint.split("."), got[after[0]].fingerprint.split("."), strict=True))
        either = [p for p in pairs if p != ("-", "-")]
        assert abs(row.near_next - sum(a == b for a, b in either) / len(either)) < 1e-12
    higher = sum(r.near_edited > r.near_next for r in got.values())
    assert higher > 0.85 * len(got)


def test_prints_agree_with_brute_force(spark):
    from pyspark.sql import functions as F

    texts = spark.createDataFrame([(1, "b a c a"), (2, "c B d"), (3, "")], "k int, text string")
    words = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "term string, kept long")
    got = {r.k: r.print_0 for r in fingerprints.fingerprints(texts, ["k"], ["text"], words).collect()}
    hashed = lambda t: spark.range(1).select(F.xxhash64(F.lit(t)).alias("h")).first().h
    rest = [None] * (len(fingerprints.PARTS) - 2)
    assert got[1] == [hashed("a b"), hashed("b c"), *rest] and got[2] == [hashed("b"), hashed("b c"), *rest]
    assert got[3] == [hashed("")] * len(fingerprints.PARTS)


def test_messy_rows(spark):
    got = fingerprints.compared(frame(spark)).collect()
    assert sorted(((r.doc_id, r.n_chars) for r in got), key=repr) == sorted(((r[0], len(r[1] or "")) for r in rows()), key=repr)
    assert len({r.fingerprint for r in got if r.n_chars == 0}) == 1
    assert fingerprints.compared(empty(spark)).count() == 0
    one = fingerprints.compared(frame(spark).where("doc_id = 3")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"onon"[:3]).hexdigest() or one.n_chars == 3


def test_randomised_lexicons_suffice_for_edits(spark):
    assert fingerprints.PARTS == (16,) * 8 + (64,) * 20 + (256,) * 20
    got = fingerprints.compared(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 4 = 0"))
    row = got.selectExpr("avg(cast(near_edited = 0 as int)) lost", "avg(cast(near_edited > near_next as int)) higher").first()
    assert row.lost < 0.075 and row.higher > 0.92


def test_a_large_group_of_near_copies_keeps_its_terms(spark):
    draw = random.Random(4)
    word = lambda: f"w{int(20000 * draw.random() ** 2)}"
    base = [word() for _ in range(150)]
    docs = [(k, " ".join(word() for _ in range(150))) for k in range(600)]
    for k in range(300):
        own = list(base)
        own[draw.randrange(150)] = f"edit{k}"
        docs.append((600 + k, " ".join(own)))
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    words = fingerprints.lexicon(texts.select("text"))
    names = {r.term for r in words.collect()}
    assert all(set(t.split()) & names for k, t in docs if k >= 600)
    prints = {r.doc_id: r.print_0 for r in fingerprints.fingerprints(texts, ["doc_id"], ["text"], words).collect()}
    alike = [sum(a == b for a, b in zip(prints[600], prints[k], strict=True) if a or b) / sum(bool(a or b) for a, b in zip(prints[600], prints[k], strict=True)) for k in range(601, 900)]
    assert sum(alike) / len(alike) > 0.8
