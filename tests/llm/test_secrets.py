import hashlib
import random
import re

from messy import empty, frame, rows
from pyspark.sql import functions as F

from plumbline.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def joined(found):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in found)


def check(docs, got):
    expected = sorted(((i, joined(brute(t))) for i, t in docs), key=repr)
    lined = sorted(((r.doc_id, ",".join(s for s in r.spans.split(",") if not s.startswith("random"))) for r in got), key=repr)
    assert lined == expected
    digests = sorted(((i, hashlib.sha256(j.encode()).hexdigest()) for i, j in expected), key=repr)
    assert sorted(((r.doc_id, r.base_sha256) for r in got), key=repr) == digests
    counts = sorted(((i, *[sum(s[1] == k for s in brute(t)) for k in range(3)]) for i, t in docs), key=repr)
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex) for r in got), key=repr) == counts


def test_messy_rows_agree_with_brute_force(spark):
    check([(r[0], r[1]) for r in rows()], secrets.report(frame(spark)).collect())
    assert secrets.report(empty(spark)).count() == 0


def test_many_matches_in_one_text(spark):
    text = "é " + "  ".join(f"password=abcdefg{k} AKIA{'A' * 16} {'f' * 24} token=abc" for k in range(600))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    check([(1, text)], secrets.report(df).collect())


def test_random_tokens_are_found_and_words_are_not(spark):
    draw = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(draw.choice(letters) for _ in range(n)) for n in (28, 36, 44) for _ in range(40)]
    plain = ["some-long-article-name-2020-about-other-things", "internationalisation1and2localisation", "z" * 40 + "1"]
    docs = [(k, f"here {t} there") for k, t in enumerate(keys + plain)]
    got = {r.doc_id: r.spans for r in secrets.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(got[k].startswith("random:5:") for k in range(len(keys))) > 0.85 * len(keys)
    assert not any(got[len(keys) + k] for k in range(len(plain)))


def test_p_values_of_random_tokens_are_even(spark):
    draw = random.Random(6)
    for name, letters in secrets.ENCODINGS[:1] + secrets.ENCODINGS[5:6]:
        tokens = ["".join(draw.choice(letters) for _ in range(40)) for _ in range(400)]
        df = spark.createDataFrame([(t,) for t in tokens], "t string")
        p = [r.p for r in df.select(secrets.battery(F.col("t"), secrets._encoding(F.col("t"))).alias("p")).collect() if r.p is not None]
        low = sum(x < 0.25 for x in p) / len(p)
        assert 0.15 < low < 0.4, name


def test_redaction(spark):
    docs = frame(spark)
    out = secrets.redacted(docs)
    assert out.columns == docs.columns and out.schema == docs.schema and out.count() == docs.count()
    texts = {r.doc_id: r for r in out.collect()}
    assert texts[8].text == "token=token: abcdefgh [secret]' [secret] [secret]" and texts[8].n_chars == len(texts[8].text)
    assert texts[0].text is None and texts[9].text == rows()[9][1]
    one = spark.createDataFrame([(1, 'token = "' + "0a" * 12 + '"', 35)], "doc_id long, text string, n_chars long")
    assert secrets.redacted(one).first().text == '[secret]"'


def test_few_tokens_and_copied_ones_raise_no_limit(spark):
    draw = random.Random(7)
    many = [(5, 3, draw.random(), f"t{k}") for k in range(1000)]
    few = [(0, 3, 0.3, "a"), (1, 3, 0.06, "b"), (1, 3, 0.2, "c"), (1, 3, 0.4, "d")]
    copied = [(5, 3, 0.3, "hot")] * 1000
    words = [(7, 3, draw.random() ** 4, f"w{k}") for k in range(1000)]
    got = secrets.limits(spark.createDataFrame(many + few + copied + words, "encoding int, stratum int, p double, token string"))
    assert got[5, 3] == got[0, 3] == got[1, 3] == secrets.LIMITS[0] and got[7, 3] > 0.2
