import base64
import gzip
import hashlib

import pytest
from oracle import connect, spark_rows, sql_rows

from plumbline.llm import queries, warc

PAGES = [
    (1, "http://a.b/c d\r\n", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (3, "x", None),
    (4, "x", ""),
    (4, "x", ""),
    (None, "y", "<p>one</p>"),
    (None, "z", "alone é"),
    (5, "w", "WARC/1.1\r\n\r\n" + "long " * 50_000),
]


def expected(least=0):
    out = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        holder = max(same) if same and len(data) >= least else i
        revisit = len(data) >= least and bool(same) and i != holder
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", holder if revisit else None))
    return sorted(out, key=repr)


def pages(spark):
    return spark.createDataFrame([(*p, 1, "q") for p in PAGES], "page_id long, url string, html string, digest int, path string").repartition(2)


@pytest.mark.parametrize("span", [61, 997, warc.RANGE])
def test_every_record_belongs_to_one_range(spark, span):
    got = warc.round_trip(pages(spark), span).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected()


def test_least_size_and_archives_are_plain_gzip(spark, tmp_path):
    directory = f"file://{tmp_path}/w"
    files = warc.write(warc.records(pages(spark), "page_id", "url", "html", least=11), directory)
    got = warc.read(files, 500).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected(11)
    text = b"".join(gzip.open(f.path.removeprefix("file://")).read() for f in files.collect())
    assert text.count(b"WARC/1.1\r\nWARC-Type") == len(PAGES) and b"\r\nWARC-Target-URI: http://a.b/c%20d%0D%0A\r\n" in text
    assert {r.bytes for r in warc.listed(spark, directory).collect()} == {r.bytes for r in files.collect()}


def test_false_marks_and_damage(spark, tmp_path):
    good = warc._member(7, "u", b"body", base64.b32encode(hashlib.sha1(b"body").digest()).decode(), None, "d")
    bad = warc._member(8, "u", b"body", "A" * 32, None, "d")
    other = gzip.compress(b"no record")
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"\x1f\x8b\x08 junk" + other + good + b"\x1f\x8b\x08\x00" + bad + good[: len(good) // 2])
    files = spark.createDataFrame([(f"file://{path}", path.stat().st_size)], "path string, bytes long")
    for span in (10, 10_000):
        assert sorted((r.page_id, r.valid) for r in warc.read(files, span).collect()) == [(7, True), (8, False)]


def test_empty(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert spark_rows(queries.QUERIES[name](spark, sf)) == sql_rows(connect(sf), queries.ORACLES[name])
