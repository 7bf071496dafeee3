"""Queries that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, fingerprints, jaccard_join, licenses, mixing, negatives, quality, secrets, spelling, token_files, topk, url_filter, warc
from plumbline.session import pin_utc, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = lambda spark, sf_dir: function(pin_utc(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP9 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END, ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""


@query("op9_ngram_jaccard_join", OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"), width=4, percent=85)


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op1_source_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(*mixing.mix(table(spark, sf_dir, "documents")))


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query("op5_url_filter")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query("op7_imatch_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


_HEX = "sha1(coalesce(html, ''))"
_BITS = ", ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {5 * group + 1}, 5) AS INTEGER) >> {shift}) & 31), 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)
OP4 = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, {_HEX} AS h FROM pages),
d AS (SELECT page_id, payload_bytes, concat({_BITS}) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM d)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to FROM m
"""


@query("op4_warc", OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


OP8 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op8_exact_top_k", OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.integers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), F.col("vec_id") % 100 == 0)


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_license_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op13_token_files")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank
    FROM s WHERE same),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_rank ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id
    WHERE positive_rank <= 5 AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank FROM n WHERE rank <= 3
"""


@query("op12_hard_negatives", OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.integers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label), F.col("vec_id") % 50 == 0)


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.groups(table(spark, sf_dir, "documents"), least=7, occurs=2, deletions=31, factor=10)
