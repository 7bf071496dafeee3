"""Token ids as files of compressed planes, written in the order of documents and read back by ranges.

Texts are encoded where they are dealt to: ranges of (id, text), one file each.  A file holds the ids of its documents one after
the other, in chunks of a fixed number.  A chunk is transposed into planes, of the first, second ... byte of every id
or of single bits, each compressed by itself; planes above the chunk's largest id are left out.

    file   = b"PLTOKEN1", chunks, index, tail
    chunk  = u32 ids, u32 crc32 of the ids, u8 bits of a plane (1 or 8), u8 planes, u32 bytes of each plane, planes
    index  = three zstd frames: u64 offset of each chunk and of the end; i64 document ids with u8 null marks; u64 ids per document
    tail   = u64 chunks, u64 documents, u32 ids per chunk, three u64 (bytes of each frame), b"PLTOKEN1"

All numbers are little-endian.  The chunk index gives any range of ids by reading its chunks alone.  ``manifest`` beside the files is
a table of them with the number of ids before each, which no task needs to count.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import file_system, partitions, quoted, text_of, written

#: Ids of a chunk, characters that are encoded at a time, ids that a reading task owns.
CHUNK, PIECE, READ = 1 << 16, 1 << 18, 1 << 20
_MAGIC = b"PLTOKEN1"
_HEAD, _TAIL = struct.Struct("<IIBB"), struct.Struct("<QQIQQQ8s")
_BLANK = re.compile(r"[ \t\n\r]")
# white space of str.split that isn't one of these blanks, and so not known to part words
_ODD = re.compile(r"[^\S \t\n\r]")
#: Words whose ids a task keeps, and the longest such word.
KNOWN, LONGEST = 1 << 19, 64
# Letters of one code point in any normal form, and marks that follow a word; in both no alternative of the split can begin but one.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
# The normal form and the split for which words between blanks are independent.
_NORMAL = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it can be printed, else the next free one from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printed]
    return [chr(b) if b in printed else chr(256 + others.index(b)) for b in range(256)]


def _parts_at_blanks(described: dict) -> bool:
    """Whether a tokenizer's file says that it drops blanks and that nothing reaches across them."""
    normal = [(n["type"], n.get("pattern", {}).get("Regex")) for n in (described.get("normalizer") or {}).get("normalizers", [])]
    steps = (described.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if normal != _NORMAL or [s["type"] for s in steps] != ["Split", "ByteLevel"] or described.get("post_processor"):
        return False
    split, level = steps
    plain = not any(t[k] for t in described["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized"))
    return plain and split["pattern"] == {"Regex": _SPLIT} and split["invert"] and split["behavior"] == "Removed" and not (level["add_prefix_space"] or level["use_regex"])


class Words(dict):
    """The ids of words between blanks, as bytes, each by the tokenizers library when it is first asked for."""

    def __init__(self, path: str, special_as_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = special_as_text
        self.model, self.apart = self.own.model, _parts_at_blanks(json.loads(self.own.to_str()))
        self.level = _byte_letters()

    def _whole(self, text: str) -> bytes:
        return np.array(self.own.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain is None:
            ids = self._whole(word)
        else:
            letters, marks = plain.groups()
            lower = letters.lower()
            if lower != word:
                ids = self[lower] + (self[marks] if marks else b"")
            else:  # one match of the split in its normal form: the model takes it as it is
                spelled = word if word.isascii() else "".join([self.level[b] for b in word.encode()])
                ids = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= KNOWN:
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str, size: int) -> list[np.ndarray]:
        """The ids of a text, a bounded number of characters at a time.

        The tokenizer's normal form and its words never reach across a blank, so a text's ids are those of what lies between blanks.  With a
        tokenizer of another kind the text is encoded as a whole.
        """
        if not self.apart:
            return [np.frombuffer(self._whole(text), dtype="<u4")]
        out = []
        for piece in pieces(text, size):
            words = piece.split() if _ODD.search(piece) is None else [w for w in _BLANK.split(piece) if w]
            out.append(np.frombuffer(b"".join(map(self.__getitem__, words)), dtype="<u4"))
        return out


@functools.lru_cache(maxsize=2)
def known_words(path: str, special_as_text: bool) -> Words:
    return Words(path, special_as_text)


def pieces(text: str, size: int) -> list[str]:
    """The text in pieces of about ``size`` characters, each after the first from a blank on."""
    out, at = [], 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at + 1, at + size) for c in " \t\n\r")
        if cut < 0:
            found = _BLANK.search(text, at + size)
            if found is None:
                break
            cut = found.start()
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """Byte or bit planes of the ids, the lowest first, up to the largest id's highest."""
    wide = int(ids.max(initial=0)).bit_length()
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [plane.tobytes() for plane in table.T[: -(-wide // 8)]]
    return [plane.tobytes() for plane in np.packbits(np.unpackbits(table, axis=1, bitorder="little").T[:wide], axis=1)]


def joined(parts: list[bytes], bits: int, n: int) -> np.ndarray:
    """The ids that ``planes`` came from."""
    if bits == 8:
        table = np.zeros((4, n), dtype=np.uint8)
        for k, part in enumerate(parts):
            table[k] = np.frombuffer(part, dtype=np.uint8)
    else:
        flags = np.zeros((32, n), dtype=np.uint8)
        for k, part in enumerate(parts):
            flags[k] = np.unpackbits(np.frombuffer(part, dtype=np.uint8), count=n)
        table = np.packbits(flags, axis=0, bitorder="little")
    return np.ascontiguousarray(table.T).view("<u4").ravel()


class _Writer:
    """One file: ids are held until they fill a chunk."""

    def __init__(self, out, chunk: int, bits: int):
        self.out, self.chunk, self.bits = out, chunk, bits
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.held, self.n_held, self.total = [], 0, 0
        self.offsets, self.ids, self.nulls, self.lengths = [len(_MAGIC)], [], [], []
        out.write(_MAGIC)

    def _put(self, ids: np.ndarray) -> None:
        parts = [self.zstd.compress(p) for p in planes(ids, self.bits)]
        head = _HEAD.pack(len(ids), zlib.crc32(ids.tobytes()), self.bits, len(parts)) + struct.pack(f"<{len(parts)}I", *map(len, parts))
        data = b"".join([head, *parts])
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def add(self, doc_id: int | None, arrays: list[np.ndarray]) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(sum(map(len, arrays)))
        self.total += self.lengths[-1]
        self.held += arrays
        self.n_held += self.lengths[-1]
        if self.n_held >= self.chunk:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.chunk * self.chunk
            for k in range(0, whole, self.chunk):
                self._put(flat[k : k + self.chunk])
            self.held, self.n_held = [flat[whole:].copy()], len(flat) - whole

    def close(self) -> None:
        if self.n_held:
            self._put(np.concatenate(self.held))
        documents = np.array(self.ids, dtype="<i8").tobytes() + np.array(self.nulls, dtype=np.uint8).tobytes()
        sections = (np.array(self.offsets, dtype="<u8").tobytes(), documents, np.array(self.lengths, dtype="<u8").tobytes())
        frames = [self.zstd.compress(s) for s in sections]
        for frame in frames:
            self.out.write(frame)
        self.out.write(_TAIL.pack(len(self.offsets) - 1, len(self.ids), self.chunk, *map(len, frames), _MAGIC))
        self.out.close()


class Reader:
    """One file: its index, and any range of its ids."""

    def __init__(self, path: str):
        system, name = file_system(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        if size < len(_MAGIC) + _TAIL.size:
            raise ValueError(f"{path} is no file of token ids")
        n, docs, self.chunk, *frames, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != _MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        data, at, sections = self.file.read_at(sum(frames), size - _TAIL.size - sum(frames)), 0, []
        for length in frames:
            sections.append(zstandard.decompress(data[at : at + length]) if length else b"")
            at += length
        self.offsets = np.frombuffer(sections[0], dtype="<u8", count=n + 1)
        self.doc_ids, self.nulls = np.frombuffer(sections[1], dtype="<i8", count=docs), np.frombuffer(sections[1], dtype=np.uint8, offset=8 * docs)
        self.ends = np.cumsum(np.frombuffer(sections[2], dtype="<u8"), dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64) if docs else self.ends
        self.path, self.held = path, (None, None)

    def _chunk(self, k: int) -> np.ndarray:
        if self.held[0] != k:
            a, b = int(self.offsets[k]), int(self.offsets[k + 1])
            data = self.file.read_at(b - a, a)
            n, check, bits, count = _HEAD.unpack_from(data)
            sizes = struct.unpack_from(f"<{count}I", data, _HEAD.size)
            at, parts = _HEAD.size + 4 * count, []
            for size in sizes:
                parts.append(zstandard.decompress(data[at : at + size]))
                at += size
            ids = joined(parts, bits, n)
            if zlib.crc32(ids.tobytes()) != check:
                raise ValueError(f"chunk {k} of {self.path} is damaged")
            self.held = (k, ids)
        return self.held[1]

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids from place ``a`` up to ``b`` of the file, from the chunks that hold them."""
        if b <= a:
            return np.zeros(0, dtype="<u4")
        size = self.chunk
        return np.concatenate([self._chunk(k)[max(0, a - k * size) : b - k * size] for k in range(a // size, -(-b // size))])


def write(
    docs: DataFrame,
    folder: str,
    id_column: str,
    text_column: str,
    path: str,
    end_id: int | None = None,
    bits: int = 8,
    chunk: int = CHUNK,
    piece: int = PIECE,
    special_as_text: bool = False,
) -> DataFrame:
    """Writes the ids of all texts to files in ``folder``; returns their manifest ``path, shard, n_docs, n_ids, start``.

    Documents come in ascending order of their id, from file to file and within each; rows that share an id by a hash of their
    text, complete copies in any order, null ids last.  A null text is an empty one.  ``end_id``, if given, follows each document.
    ``path`` names the tokenizer's file on every executor; its special tokens' strings are taken for these unless ``special_as_text``.
    An id or many copies of a row that hold much of the table are dealt over several files.  A task writes under
    a name of its own and renames when done, so a repeated task replaces its file.
    """
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_last(), F.col("hash"), F.col("copy")]
    ranged = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, own, writer, words = TaskContext.get(), None, None, known_words(path, special_as_text)
        system, place = file_system(folder)
        shard = context.partitionId()
        end = [np.array([end_id], dtype="<u4")] if end_id is not None else []
        for batch in batches:
            rows = max(1, min(len(batch), (4 * piece * len(batch)) // max(1, batch.nbytes)))
            for k in range(0, len(batch), rows):
                ids, texts = (c.to_pylist() for c in batch.slice(k, rows).columns)
                if writer is None:
                    system.create_dir(place, recursive=True)
                    own = f"{place}/.{context.taskAttemptId()}-{uuid.uuid4().hex}"
                    writer = _Writer(system.open_output_stream(own), chunk, bits)
                for doc_id, text in zip(ids, texts, strict=True):
                    writer.add(doc_id, words.ids(text, piece) + end)
        if writer is not None:
            writer.close()
            name = f"ids-{shard:06d}.tok"
            system.move(own, f"{place}/{name}")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "shard": [shard], "n_docs": [len(writer.ids)], "n_ids": [writer.total]})

    files = written(ranged.select("doc_id", "text").mapInArrow(put, "path string, shard long, n_docs long, n_ids long"), "files")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    files.withColumn("start", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{folder}/manifest")
    return manifest(docs.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("path string, shard long, n_docs long, n_ids long, start long").parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str, raw: bool = False, size: int = READ) -> DataFrame:
    """Columns ``doc_id, start, ids``: each document of the files with the number of ids before it.

    A task takes the documents that begin in its range of a file's ids.  ``raw`` gives the ids as bytes, four each,
    little-endian, instead of an array.
    """
    kind = pa.binary() if raw else pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", kind)])
    splits = manifest(spark, folder).select(
        "path", "start", "n_ids", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.col("n_ids") - 1), F.lit(size).cast("long"))).alias("a")
    )
    splits = splits.select("path", "start", "a", F.when(F.col("a") + size < F.col("n_ids"), F.col("a") + size).alias("b"))
    splits = splits.repartition(partitions(spark), "path", "a")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, a, b in sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True), key=lambda r: (r[0], r[2])):
                file = Reader(path)
                at = np.searchsorted(file.starts, a)
                stop = len(file.starts) if b is None else np.searchsorted(file.starts, b)
                while at < stop:
                    upto = max(at + 1, min(int(stop), at + 4096, int(np.searchsorted(file.starts, file.starts[at] + CHUNK))))
                    ids = file.ids(int(file.starts[at]), int(file.ends[upto - 1]))
                    cuts = np.concatenate([file.starts[at:upto], file.ends[upto - 1 : upto]]) - file.starts[at]
                    if raw:
                        data = pa.array([ids[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)], kind)
                    else:
                        data = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32)))
                    docs = pa.array(file.doc_ids[at:upto], mask=file.nulls[at:upto].astype(bool))
                    yield pa.RecordBatch.from_arrays([docs, pa.array(file.starts[at:upto] + start), data], schema=schema)
                    at = upto

    return splits.mapInArrow(get, f"doc_id long, start long, ids {'binary' if raw else 'array<int>'}")


def windows(spark: SparkSession, folder: str, length: int) -> DataFrame:
    """Columns ``window, ids``: all ids of all files in windows of ``length``, by the chunk index alone; the last may be shorter.

    A window that spans files is read by one task from each of them.
    """
    files = manifest(spark, folder).where("n_ids > 0")
    numbers = F.sequence(F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("n_ids") - 1) / length))
    spans = files.select("path", "start", "n_ids", F.explode(numbers).alias("window")).repartition(partitions(spark), "window")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, n, window in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = max(0, window * length - start), min(n, (window + 1) * length - start)
                ids = pa.array([Reader(path).ids(a, b).astype(np.int32)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([window], pa.int64()), pa.array([start + a], pa.int64()), ids], ["window", "at", "ids"])

    parts = spans.mapInArrow(get, "window long, at long, ids array<int>")
    lined = F.sort_array(F.collect_list(F.struct("at", "ids")))
    return parts.groupBy("window").agg(F.flatten(F.transform(lined, lambda x: x["ids"])).alias("ids"))


def digests(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Columns ``doc_id, start, n_tokens, ids_crc32`` of documents written to ``folder`` and read back from it."""
    write(docs, folder, "doc_id", "text", path, end_id)
    back = read(docs.sparkSession, folder, raw=True)
    return back.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
