"""Byte-level BPE over whole texts, long ones in overlapping chunks; and back to bytes.

A text of up to a chunk is encoded where it is read.  A longer one is cut into chunks that overlap;
tasks split them into pre-tokens side by side.  A match of the pattern depends only on what
follows its beginning, so once two chunks have a boundary in common, all later ones agree: there the
chunks are stitched, and the pieces between stitches are encoded, each by itself.  A boundary counts only
if the chunk's end can't have moved it, and a piece never ends in white space, whose split looks ahead.
From a chunk that has no boundary in common with the one before (as within a very long run of
letters) to its text's end, the rest is one piece.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, text_of, written

#: Characters of a chunk besides its overlap, and of the overlap with the next chunk.
CHUNK, OVERLAP = 32_768, 1_024
_SURE = 4  # the longest contraction is three characters, and white space looks one ahead
_ROWS = 256  # rows sent on at a time, or fewer if they hold more than _BYTES
_BYTES = 1 << 20


@functools.lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, as Python objects take much more room than columns."""
    for batch in batches:
        rows = max(1, min(_ROWS, int(_BYTES * len(batch) / max(1, batch.nbytes))))
        for k in range(0, len(batch), rows):
            yield batch.slice(k, rows)


def _boundaries(text: str, splitter: regex.Pattern, last: bool, a: int, b: int) -> list[int]:
    """Beginnings of pre-tokens in [a, b) that nothing after the text can move, after a character other than white space."""
    most = len(text) if last else len(text) - _SURE
    return [m.start() for m in splitter.finditer(text) if a <= m.start() < min(b, most) and (m.start() == 0 or not text[m.start() - 1].isspace())]


def _chunks(chunk: int, overlap: int):
    schema = pa.schema([("key", pa.string()), ("i", pa.int32()), ("last", pa.bool_()), ("text", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                n = max(1, -(-(len(text) - overlap) // chunk))
                for k in range(0, n, _ROWS):
                    at = range(k, min(n, k + _ROWS))
                    yield _batch([[key.as_py()] * len(at), list(at), [i == n - 1 for i in at], [text[i * chunk : (i + 1) * chunk + overlap] for i in at]], schema)

    return cut


def _edges(pattern: str, chunk: int, overlap: int):
    kind = pa.list_(pa.int64())
    schema = pa.schema([("key", pa.string()), ("i", pa.int32()), ("head", kind), ("tail", kind)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = regex.compile(pattern)
        for batch in _slices(batches):
            rows = []
            for key, i, last, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                head = _boundaries(text[: 2 * overlap + _SURE], splitter, False, 1, overlap) if i else []
                tail = [] if last else _boundaries(text, splitter, False, chunk + 1, chunk + overlap)
                rows.append((key, i, [x + i * chunk for x in head], [x + i * chunk for x in tail]))
            yield _batch(list(zip(*rows, strict=True)) or [[]] * 4, schema)

    return find


def _whole(path: str, pattern: str, schema: pa.Schema):
    def encode_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path, pattern)
        for part in _slices(batches):
            ids = [own.encode_ordinary(text) for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    return encode_texts


_PIECE = pa.schema([("key", pa.string()), ("i", pa.int32()), ("ids", pa.list_(pa.int32()))])


def _pieces(path: str, pattern: str, chunk: int):
    """Encodes what lies between two stitches of one chunk."""

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path, pattern)
        for part in _slices(batches):
            c = [x.to_pylist() for x in part.columns]
            ids = [own.encode_ordinary(t[a - i * chunk : None if b is None else b - i * chunk]) for i, t, a, b in zip(*c[1:], strict=True)]
            yield _batch([c[0], c[1], ids], _PIECE)

    return encode_pieces


def _rest(path: str, pattern: str, chunk: int):
    """Encodes from the last stitch of a text to its end, one pre-token after the other."""

    def encode_rest(table: pa.Table) -> pa.Table:
        own = tokenizer(path, pattern)
        rows = sorted(zip(*(table.column(k).to_pylist() for k in ("i", "last", "text", "start")), strict=True))
        first, start = rows[0][0], rows[0][3]
        text = "".join(text if last else text[:chunk] for _, last, text, _ in rows)[start - first * chunk :]
        # the library's own splitter overflows on runs of more than a million blanks
        ids = [x for m in regex.compile(pattern).finditer(text) for x in own._encode_single_piece(m.group())]
        return pa.Table.from_batches([_batch([[table.column("key")[0].as_py()], [first], [ids]], _PIECE)])

    return encode_rest


def encode(docs: DataFrame, id_column: str, text_column: str, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Columns ``doc_id, ids``: the token ids of each row's whole text, as the ranks in ``path`` give them.

    Null and empty texts have no ids.  Repeated rows and null ids stay as they are; long texts that
    are equal are encoded once.  ``path`` must be readable on every executor.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(quoted(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    is_long = F.length("text") > chunk + overlap
    id_type = rows.select("doc_id").limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("doc_id", id_type), ("ids", pa.list_(pa.int32()))])
    short = rows.where(~is_long).mapInArrow(_whole(path, pattern, schema), f"doc_id {kind}, ids array<int>")

    keyed = rows.where(is_long).withColumn("key", F.sha2("text", 256))
    chunks = written(
        keyed.select("key", "text")
        .mapInArrow(_chunks(chunk, overlap), "key string, i int, last boolean, text string")
        .dropDuplicates(["key", "i"]),
        "chunks",
    )
    edges = chunks.mapInArrow(_edges(pattern, chunk, overlap), "key string, i int, head array<long>, tail array<long>")
    line = Window.partitionBy("key").orderBy("i")
    stitch = F.when(F.col("i") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(line))))
    cuts = edges.withColumn("start", stitch.cast("long"))
    cuts = cuts.withColumn("start", F.when(F.min(F.col("start").isNotNull()).over(line), F.col("start")))
    cuts = cuts.withColumn("end", F.lead("start").over(line)).withColumn("piece", F.max(F.when(F.col("start").isNotNull(), F.col("i"))).over(line))
    cuts = cuts.withColumn("broken", F.col("start").isNull() | F.coalesce(F.lead(F.col("start").isNull()).over(line), F.lit(False)))
    pieces = chunks.join(written(cuts.drop("head", "tail"), "cuts"), ["key", "i"])
    stitched = pieces.where("NOT broken").select("key", "i", "text", "start", "end").mapInArrow(_pieces(path, pattern, chunk), "key string, i int, ids array<int>")
    rest = pieces.where("broken").groupBy("key", "piece").applyInArrow(_rest(path, pattern, chunk), "key string, i int, ids array<int>")
    lined = F.sort_array(F.collect_list(F.struct("i", "ids")))
    joined = stitched.union(rest).groupBy("key").agg(F.flatten(F.transform(lined, lambda x: x["ids"])).alias("ids"))
    return short.union(keyed.select("doc_id", "key").join(joined, "key").select("doc_id", "ids"))


def decode(tokens: DataFrame, ids_column: str, path: str, pattern: str) -> DataFrame:
    """The rows with ``decoded`` (binary) in place of the ids: the tokens' bytes, one after the other.

    Null ids give no bytes; an id that isn't in the ranks fails.
    """
    own_schema = tokens.limit(0).toArrow().schema
    at = tokens.columns.index(ids_column)
    schema = pa.schema([f for k, f in enumerate(own_schema) if k != at] + [pa.field("decoded", pa.binary())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path, pattern)
        for batch in _slices(batches):
            data = [own.decode_bytes(x or []) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([c for k, c in enumerate(batch.columns) if k != at] + [pa.array(data, pa.binary())], schema=schema)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for k, f in enumerate(tokens.schema.fields) if k != at]
    return tokens.mapInArrow(join, ", ".join([*fields, "decoded binary"]))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Columns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of texts encoded and decoded again."""
    tokens = encode(docs, "doc_id", "text", path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        "ids",
    )
    back = decode(tokens, "ids", path, pattern)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
