import zlib

import numpy as np
import public_tokenizers
import pytest
from messy import empty, frame, rows
from tokenizers import Tokenizer

from plumbline.llm import token_files
from plumbline.llm.common import file_system

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows, end_id):
    own = Tokenizer.from_file(PATH)
    out, at = [], 0
    for doc_id, text in rows:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("ids", [[], [0], [0] * 9, [1, 2, 3], [49407, 0, 255, 256, 65535, 65536], [2**32 - 1, 7], list(range(1000))])
def test_planes_give_the_ids_back(bits, ids):
    ids = np.array(ids, dtype="<u4")
    assert token_files.joined(token_files.planes(ids, bits), bits, len(ids)).tolist() == ids.tolist()


@pytest.mark.parametrize("special_as_text", [False, True])
def test_words_between_blanks_give_the_ids_of_the_text(monkeypatch, special_as_text):
    monkeypatch.setattr(token_files, "KNOWN", 20)
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = special_as_text
    words = token_files.Words(PATH, special_as_text)
    odd = "Ünïcode e\u0301 \u0301a wörds, it's 12345  \n\n end\u3000of\x85 a\x1cb\x0bc\xa0d <|endoftext|> x<|endoftext|>y ΣΑΣ İ ﬁ 日本語 "
    for text in (odd * 40 + "x" * 500 + " done", "", " ", "plain words of a plain text " * 30, "x" * 3000, "'S 'll don't\tI'LL"):
        for size in (1, 7, 50, 10_000):
            parts = token_files.pieces(text, size)
            assert "".join(parts) == text
            got = [i for a in words.ids(text, size) for i in a.tolist()]
            assert got == own.encode(text, add_special_tokens=False).ids
    assert len(words) <= 20


def test_every_letter_and_mark_alone_and_in_a_word(monkeypatch):
    own, words = Tokenizer.from_file(PATH), token_files.Words(PATH, False)
    assert words.apart
    for c in [chr(k) for k in range(1, 0x250)] + ["\u0300", "ﬁ", "\u2028", "日"]:
        for word in (c, f"ab{c}cd", f"Ab{c},", f"{c}x", f"Mot{c * 3}.", f"é{c}", f"don'{c}"):
            got = [i for a in words.ids(word, 100) for i in a.tolist()]
            assert got == own.encode(word, add_special_tokens=False).ids, word


def test_a_tokenizer_that_keeps_blanks_gets_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    words, text = token_files.Words(path, False), "A text  with blanks\n and words " * 50
    assert not words.apart
    assert [i for a in words.ids(text, 10) for i in a.tolist()] == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_ids_come_back_in_the_order_of_documents(spark, tmp_path):
    docs = [(k * 7 % 101, f"Document {k} says: " + "some words, " * (k % 13) + ("é" * 300 if k == 5 else "")) for k in range(101)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    token_files.write(df, f"{tmp_path}/out", "doc_id", "text", PATH, end_id=2, bits=1, chunk=64, piece=40)
    back = token_files.read(spark, f"{tmp_path}/out", size=50).collect()
    got = sorted((r.start, r.doc_id, len(r.ids), zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())) for r in back)
    assert [(d, s, n, c) for s, d, n, c in got] == expected(sorted(docs), 2)
    flat = [i for r in sorted(back, key=lambda r: r.start) for i in r.ids]
    cut = sorted((r.window, r.ids) for r in token_files.windows(spark, f"{tmp_path}/out", 100).collect())
    assert [k for k, _ in cut] == list(range(-(-len(flat) // 100)))
    assert [ids for _, ids in cut] == [flat[k : k + 100] for k in range(0, len(flat), 100)]


def test_nulls_repeats_and_long_texts(spark, tmp_path):
    got = sorted(token_files.digests(frame(spark), f"{tmp_path}/a", PATH, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows()), key=lambda i: (i is None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    content = sorted((r[0] or -1, *r[2:]) for r in map(tuple, got))
    assert content == sorted((d or -1, n, c) for d, _, n, c in expected([r[:2] for r in rows()], 2))
    assert token_files.digests(empty(spark), f"{tmp_path}/b", PATH, 2).count() == 0


def test_a_repeated_id_is_dealt_over_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "the same row")] * 400 + [(2, "b"), (0, "a")], "doc_id long, text string").repartition(3)
    files = token_files.write(df, f"{tmp_path}/out", "doc_id", "text", PATH, end_id=2).collect()
    assert max(f.n_docs for f in files) < 200
    back = sorted((r.start, r.doc_id) for r in token_files.read(spark, f"{tmp_path}/out").collect())
    assert [d for _, d in back] == [0] + [1] * 400 + [2]


def test_damage_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a few words")], "doc_id long, text string")
    path = token_files.write(df, f"{tmp_path}/out", "doc_id", "text", PATH).first().path
    data = bytearray(open(path, "rb").read())
    data[12] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError, match="damaged"):
        token_files.Reader(path).ids(0, 1)


def test_schemes_of_hadoop_name_the_same_store():
    system, path = file_system("s3a://bucket/folder?region=us-east-1")
    assert (system.type_name, path) == ("s3", "bucket/folder")
