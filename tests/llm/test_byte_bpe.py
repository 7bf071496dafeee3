import hashlib
import random

import public_tokenizers
from messy import empty, frame, rows
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_stitched_chunks_give_the_ids_of_whole_texts(spark):
    draw = random.Random(3)
    parts = [" ", "  ", "\n", "\n\n", "a", "bc", "'s", "'re", "'", "12", ".", "é", "日本", "\x1c", "　", "!!"]
    docs = [(3, "a" * 500), (4, " " * 700 + "b"), (5, "q " + "a" * 300 + " b c d e f " * 20), (5, "q " + "a" * 300 + " b c d e f " * 20)]
    docs += [(10 + k, "".join(draw.choice(parts) for _ in range(draw.randint(1, 500)))) for k in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = byte_bpe.encode(df, "doc_id", "text", PATH, PATTERN, chunk=64, overlap=24).collect()
    own = byte_bpe.tokenizer(PATH, PATTERN)
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((i, own.encode_ordinary(t)) for i, t in docs)


def test_messy_rows(spark):
    own = byte_bpe.tokenizer(PATH, PATTERN)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for r in rows():
        ids = own.encode_ordinary(r[1] or "")
        expected.append((r[0], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r[1] or "").encode())))
    got = [tuple(r) for r in byte_bpe.digests(frame(spark), PATH, PATTERN).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert byte_bpe.digests(empty(spark), PATH, PATTERN).count() == 0


def test_decoding_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, [64, 65])], "k int, ids array<int>")
    got = {r.k: bytes(r.decoded) for r in byte_bpe.decode(df, "ids", PATH, PATTERN).collect()}
    assert got[1] == b"" and got[2] == byte_bpe.tokenizer(PATH, PATTERN).decode_bytes([64, 65])
    assert byte_bpe.decode(df.withColumn("more", F.lit(1)), "ids", PATH, PATTERN).columns == ["k", "more", "decoded"]
