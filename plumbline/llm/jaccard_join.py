"""N-gram Jaccard join by vertical partitioning.

The global order of shingles is cut into fragments: each task sees one fragment of every document's
set, never a whole set.

1. Fragments of equal hash ranges.  A fragment's task counts in how many different sets each of
   its shingles occurs, and passes on those of two sets or more with that count.
2. Per set, its shared shingles of all fragments meet.  A set of which less than the threshold is
   shared has no partner.  What remains is ordered by (count, hash), and the rarest of it, as many
   as two sets over the threshold can't both do without, may make candidates.
3. Sets are dealt into blocks of bounded size so that sets with common rare shingles lie together,
   and two blocks are compared if some rare shingle occurs in both.  The blocks' sets are cut into
   fragments again; each fragment's partial overlaps of all pairs are counted separately and
   summed per pair, as packed matrices.  Of the links found, each pair of blocks reports a spanning forest.
4. Components of these links.

Equal sets count as one from the start, so copies cost one small row each; a hot group of near copies
becomes many pairs of blocks, each a task of its own, and never a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import content, kept, packed, quoted, text_of, unpacked, written
from plumbline.llm.components import components
from plumbline.llm.texthash import words_of
from plumbline.operators.ranking import number_rows

#: Shingles per fragment, which bounds what a task of step 1 or 2 holds.
FRAGMENT = 3_000_000
#: Sets per block of step 3.
BLOCK = 512
#: Fragments of step 3.
PARTS = 4
_ID = np.uint64(16)  # shingles are told apart by their upper 48 bits once each set's size is known


def _unique(hashes: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    return [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _signature(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes()) - 2**63


def shingle_sets(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """Columns ``doc_id, n_shingles, sig``: the size of each text's set, and a hash of the set (null if empty)."""
    kind = docs.schema[id_column].dataType

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sigs = [], []
            for _, words in words_of(batch.column(1)):
                for own in _unique(*words.shingles(width)):
                    sizes.append(len(own))
                    sigs.append(_signature(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64())], ["doc_id", "n_shingles", "sig"]
            )

    schema = f"doc_id {kind.simpleString()}, n_shingles long, sig long"
    return docs.select(quoted(id_column).alias("doc_id"), text_of(text_column).alias("t")).mapInArrow(sets, schema)


def _bytes_of(x: np.ndarray) -> np.ndarray:
    """Upper 48 bits as six bytes each."""
    return np.ascontiguousarray((x >> _ID).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _ids_of(parts: list[bytes]) -> np.ndarray:
    out, at = np.zeros((sum(map(len, parts)) // 6, 8), dtype=np.uint8), 0
    for part in parts:
        raw = np.frombuffer(part, dtype=np.uint8).reshape(-1, 6)
        out[at : at + len(raw), :6] = raw
        at += len(raw)
    return out.view("<u8").ravel()


def _numbers(parts, kind) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=kind)


def _fragments(texts: DataFrame, width: int, n: int) -> DataFrame:
    """Rows of ``frag``, and for many sets each: ``sig``, size, and the shingles that fall into the fragment."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in words_of(batch.column(0), 4 << 20):
                own = [x for x in _unique(*words.shingles(width)) if len(x)]
                if not own:
                    continue
                sigs = np.array([_signature(x) for x in own], dtype=np.int64)
                sizes = np.array([len(x) for x in own], dtype=np.int32)
                hashes = np.concatenate(own)
                owner = np.repeat(np.arange(len(own)), sizes)
                frag = ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int16 if n < 2**15 else np.int32)
                order = np.argsort(frag, kind="stable")
                ends = np.searchsorted(frag[order], np.arange(n + 1))
                rows = []
                for f in range(n):
                    spots = order[ends[f] : ends[f + 1]]
                    if len(spots):
                        counts = np.bincount(owner[spots], minlength=len(own))
                        has = np.flatnonzero(counts)
                        rows.append((f, sigs[has].tobytes(), sizes[has].tobytes(), counts[has].astype(np.int32).tobytes(), _bytes_of(hashes[spots]).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)],
                    ["frag", "sigs", "sizes", "counts", "ids"],
                )

    return texts.mapInArrow(cut, "frag int, sigs binary, sizes binary, counts binary, ids binary")


def _shared(n: int):
    """Of a fragment: its shingles that occur in two sets or more, dealt by set into ``n`` bundles."""

    def count(table: pa.Table) -> pa.Table:
        c = {k: table.column(k).to_pylist() for k in ("sigs", "sizes", "counts", "ids")}
        sigs, sizes, counts = (_numbers(c[k], t) for k, t in (("sigs", np.int64), ("sizes", np.int32), ("counts", np.int32)))
        ids = _ids_of(c.pop("ids"))
        first = np.zeros(len(sigs), dtype=bool)
        first[np.unique(sigs, return_index=True)[1]] = True
        ids, sigs, sizes, counts = ids[np.repeat(first, counts)], sigs[first], sizes[first], counts[first]
        order = np.argsort(ids)
        lined = ids[order]
        # few arrays of a fragment's length at a time: only what occurs twice is counted
        twice = np.zeros(len(lined), dtype=bool)
        twice[1:] = lined[1:] == lined[:-1]
        twice[:-1] |= twice[1:]
        order, lined = order[twice], lined[twice]
        opens = np.flatnonzero(np.r_[True, lined[1:] != lined[:-1]]) if len(lined) else np.zeros(0, dtype=np.int64)
        runs = np.diff(np.r_[opens, len(lined)])
        df = np.zeros(len(ids), dtype=np.int32)
        df[order] = np.repeat(runs.astype(np.int32), runs)
        del order, lined, opens, runs
        many = df > 1
        ids, df, owner = ids[many], df[many], np.repeat(np.arange(len(sigs), dtype=np.int32), counts)[many]
        bundle = (sigs.view(np.uint64) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)
        counts = np.bincount(owner, minlength=len(sigs)).astype(np.int32)
        rows = []
        by = bundle[owner]
        for b in np.unique(by):
            has, spots = np.flatnonzero((bundle == b) & (counts > 0)), by == b
            six = np.ascontiguousarray(ids[spots].view(np.uint8).reshape(-1, 8)[:, :6])
            rows.append((int(b), sigs[has].tobytes(), sizes[has].tobytes(), counts[has].tobytes(), six.tobytes(), df[spots].tobytes()))
        kinds = (pa.int32(), *[pa.binary()] * 5)
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["bundle", "sigs", "sizes", "counts", "ids", "df"])

    return count


def _survivors(percent: int):
    """Sets of which enough is shared: their shared shingles, rarest first, and how many of them may make candidates."""

    def gather(table: pa.Table) -> pa.Table:
        c = {k: table.column(k).to_pylist() for k in ("sigs", "sizes", "counts", "ids", "df")}
        sigs, sizes, counts, df = (
            _numbers(c[k], t) for k, t in (("sigs", np.int64), ("sizes", np.int32), ("counts", np.int32), ("df", np.int32))
        )
        ids = _ids_of(c["ids"])
        own, where = np.unique(sigs, return_inverse=True)
        size = np.zeros(len(own), dtype=np.int64)
        size[where] = sizes
        shared = np.bincount(where, weights=counts, minlength=len(own)).astype(np.int64)
        owner = np.repeat(where.astype(np.int32), counts)
        keep = (100 * shared >= percent * size)[owner]
        ids, df, owner = ids[keep], df[keep], owner[keep]
        order = np.lexsort((ids, df, owner))
        ids, owner = ids[order], owner[order]
        out = []
        for i in np.unique(owner):
            a, b = np.searchsorted(owner, (i, i + 1))
            n = int(size[i])
            prefix = (n - (percent * n + 99) // 100 + 1) - (n - (b - a))
            out.append((int(own[i]), n, int(prefix), ids[a:b].tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["sig", "size", "prefix", "ids"])

    return gather


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns ``token, sig, size``: the shingles of each set that may make candidates."""
    for batch in batches:
        for sig, size, prefix, ids in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            own = np.frombuffer(ids, dtype=np.int64)[:prefix]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(np.full(len(own), sig)), pa.array(np.full(len(own), size))], ["token", "sig", "size"]
            )


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns ``block, part, sig, size, ids``: each set, cut into fragments by ranges of its shingles' hashes."""
    for batch in batches:
        rows = []
        for block, sig, size, ids in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            own = np.sort(np.frombuffer(ids, dtype=np.uint64))
            ends = np.searchsorted(own, np.arange(1, PARTS, dtype=np.uint64) * np.uint64(2**48 // PARTS))
            rows += [(block, part, sig, size, x.tobytes()) for part, x in enumerate(np.split(own, ends))]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["block", "part", "sig", "size", "ids"])


def _overlaps(table: pa.Table) -> pa.Table:
    """For one fragment of two blocks (or one): overlaps of all pairs of sets that have any, packed."""
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    block = np.array(table.column("block").to_pylist())
    sig = np.array(table.column("sig").to_pylist())
    line = np.lexsort((sig, block))
    raw = table.column("ids").to_pylist()
    sets = [np.frombuffer(raw[i], dtype=np.uint64) for i in line]
    sizes = np.array(table.column("size").to_pylist())[line]
    n = len(sets)
    counts = np.zeros(n * n, dtype=np.int64)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(tokens, kind="stable")
    lined, owner = tokens[order], owner[order]
    if len(lined):
        opens = np.flatnonzero(np.r_[True, lined[1:] != lined[:-1]])
        runs = np.diff(np.r_[opens, len(lined)])
        for d in np.unique(runs[(runs > 1) & (runs <= 32)]):
            at = opens[runs == d]
            i, j = np.triu_indices(d, 1)
            step = max(1, (1 << 20) // len(i))
            for k in range(0, len(at), step):
                held = owner[at[k : k + step, None] + np.arange(d)]
                counts += np.bincount((held[:, i] * n + held[:, j]).ravel(), minlength=n * n)
        wide = np.flatnonzero(runs > 32)
        for k in range(0, len(wide), 2048):
            part = wide[k : k + 2048]
            one = np.zeros((n, len(part)), dtype=np.float32)
            spots = np.concatenate([np.arange(opens[w], opens[w] + runs[w]) for w in part])
            one[owner[spots], np.repeat(np.arange(len(part)), runs[part])] = 1
            counts += np.triu(one @ one.T, 1).astype(np.int64).ravel()
    if left != right:  # pairs inside a block belong to that block's own comparison
        cut = int((block == left).sum())
        square = counts.reshape(n, n)
        square[:cut, :cut] = 0
        square[cut:, cut:] = 0
    pairs = np.flatnonzero(counts)
    kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
    row = (left, right, sig[line].astype(np.int64).tobytes(), sizes.astype(np.int64).tobytes(), pairs.astype(np.int32).tobytes(), counts[pairs].astype(np.int32).tobytes())
    return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], ["left", "right", "sigs", "sizes", "pairs", "counts"])


def _links(percent: int):
    """Sums the fragments' overlaps per pair; a spanning forest of the pairs over the threshold."""

    def sums(table: pa.Table) -> pa.Table:
        sigs = np.frombuffer(table.column("sigs")[0].as_py(), dtype=np.int64)
        sizes = np.frombuffer(table.column("sizes")[0].as_py(), dtype=np.int64)
        n = len(sigs)
        total = np.zeros(n * n, dtype=np.int64)
        for pairs, counts in zip(table.column("pairs").to_pylist(), table.column("counts").to_pylist(), strict=True):
            total[np.frombuffer(pairs, dtype=np.int32)] += np.frombuffer(counts, dtype=np.int32)
        pairs = np.flatnonzero(total)
        i, j = pairs // n, pairs % n
        both = total[pairs]
        near = 100 * both >= percent * (sizes[i] + sizes[j] - both)
        root = list(range(n))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for a, b in zip(i[near].tolist(), j[near].tolist(), strict=True):
            ra, rb = top(a), top(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
                out.append((int(sigs[a]), int(sigs[b])))
        columns = list(zip(*out, strict=True)) or [[], []]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in columns], ["a", "b"])

    return sums


def similar_sets(docs: DataFrame, text_column: str, width: int, percent: int) -> DataFrame:
    """Links between different shingle sets, as ``a, b`` of their hashes: enough of them to connect all that are linked."""
    texts = docs.select(text_of(text_column).alias("t"))
    chars = texts.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(12, -(-chars // (6 * FRAGMENT)))  # words have six letters or so
    shared = (
        _fragments(texts, width, n)
        .groupBy("frag")
        .applyInArrow(_shared(n), "bundle int, sigs binary, sizes binary, counts binary, ids binary, df binary")
    )
    found = kept(
        shared.groupBy("bundle").applyInArrow(_survivors(percent), "sig long, size long, prefix int, ids binary")
    )
    rare = written(found.mapInArrow(_rare, "token long, sig long, size long"), "rare")

    # sets with a common rare shingle next to each other: two rounds of least labels suffice for most,
    # and what they part is compared across blocks
    near = rare.select("token", "sig", F.col("sig").alias("label"))
    for _ in range(2):
        least = near.groupBy("token").agg(F.min("label").alias("label"))
        own = rare.select("token", "sig").join(least, "token").groupBy("sig").agg(F.min("label").alias("label"))
        near = written(rare.select("token", "sig").join(own, "sig"), "near")
    labels = near.groupBy("sig").agg(F.min("label").alias("label"))
    lined = number_rows(found.select("sig", "size").join(labels, "sig"), [F.col("label"), F.col("size"), F.col("sig")], "at")
    blocks = written(lined.select("sig", F.floor(F.col("at") / BLOCK).cast("long").alias("block")), "blocks")

    spread = (
        rare.select("token", "sig")
        .join(blocks, "sig")
        .groupBy("token")
        .agg(F.sort_array(F.collect_set("block")).alias("held"))
        .where(F.size("held") > 1)
        .select("held")
        .distinct()
    )
    across = spread.select(F.posexplode("held").alias("at", "left"), "held").select(
        "left", F.explode(F.expr("slice(held, at + 2, size(held))")).alias("right")
    )
    within = blocks.select(F.col("block").alias("left"), F.col("block").alias("right"))
    pairs = written(across.union(within).distinct(), "pairs")
    sides = pairs.select("left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    cut = (
        found.join(blocks, "sig")
        .select("block", "sig", "size", "ids")
        .mapInArrow(_split, "block long, part int, sig long, size long, ids binary")
    )
    overlaps = (
        cut.join(sides, "block")
        .groupBy("left", "right", "part")
        .applyInArrow(_overlaps, "left long, right long, sigs binary, sizes binary, pairs binary, counts binary")
    )
    return overlaps.groupBy("left", "right").applyInArrow(_links(percent), "a long, b long")


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Columns ``doc_id, n_shingles, component_id``: one row per row of ``docs``.

    Two documents are linked when ``100 * |intersection| >= percent * |union|`` holds for their
    sets of distinct ``width``-word shingles; ``component_id`` is the least id that links reach.
    A text of fewer words has one shingle.  Null, empty and blank texts have none, and are
    linked with nothing.  Rows with the same text are linked, whatever their ids; rows that share an id but
    not a text are separate rows.  A null id stands for itself, and never is a component's least id
    unless all are null.  Sets are told apart by 64-bit hashes of their shingles.
    """
    base = written(shingle_sets(docs, id_column, text_column, width), "sets")
    groups = components(similar_sets(docs, text_column, width, percent))
    least = base.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("least"))
    tops = least.join(groups.withColumnRenamed("a", "sig"), "sig", "left").withColumn("top", F.coalesce("b", "sig"))
    tops = written(tops.select("sig", "top", "least"), "tops")
    names = tops.groupBy("top").agg(F.min("least").alias("component_id"))
    named = written(tops.select("sig", "top").join(names, "top").select("sig", "component_id"), "named")
    return base.join(named, "sig", "left").select(
        "doc_id", "n_shingles", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, one of each component: that with the least id, null ids last.

    Rows are told apart by 128 bits of hashes of all their columns (but maps), so rows that share an id stay or go each for itself;
    of complete copies one stays.  Rows without shingles are linked with nothing, and all stay.
    """
    marks = [F.xxhash64(F.lit(k), content(docs)).alias(f"mark_{k}") for k in range(2)]
    key = F.struct(quoted("doc_id").isNull().alias("none"), quoted("doc_id").alias("id"), *marks)
    groups = near_copies(docs.select(key.alias("key"), text_of("text").alias("text")), "key", "text", width, percent)
    names = ["mark_0", "mark_1"]
    stays = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id.mark_0", "doc_id.mark_1", "n_shingles")
    stays = written(stays.groupBy(*names).agg(((F.max("n_shingles") > 0) & (F.count(F.lit(1)) > 1)).alias("again")), "stays")
    rows = docs.select(*packed(docs), *marks).join(stays, names)
    # only repeated rows are shuffled for it
    rows = rows.where(~F.col("again")).union(rows.where("again").dropDuplicates(names))
    return rows.select(*unpacked(docs))
