"""Exact top-k search by inner product over vector-approximation files.

Vectors are kept twice: exactly, and as one byte per component that names a cell of a grid.  A cell bounds its
component from below and above, and so a query's score from both sides.

Blocks of vectors are dealt to shares, blocks of queries to groups; a task holds one share and one group, and meets each pair of blocks in slices of queries:

1. Scan: bounds of all its vectors by their cells.  As long as a query has no score that it is sure to reach,
   the kth highest of some lower bounds is one.
2. Visit: candidates whose upper bound reaches that score, in the order of their upper bounds, the highest first;
   exact vectors are read a few at a time until the kth best score is above every bound that is left.
   Each share reports at most k rows per query, of which the k best are the result.

Shares are gone through in waves, each with eight times as many as those before it: the kth best score of a query in earlier waves is what
later shares have to reach, so that few of their exact vectors are read and few rows reported.  Every share meets every group, once.
Copies of a block for the other side's groups or shares leave Python one at a time; a row is never exploded, as Spark holds all
rows that come from one in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, written
from plumbline.session import bound_batches

#: Rows of a block, queries of a block, queries that are bounded at a time, cells per component, exact vectors read at a time.
BLOCK, QUERIES, SLICE, CELLS, READ = 4096, 8192, 256, 256, 64
#: Components of a block at most, of a share of the vectors, of a group of the queries; how many times as many shares a wave has as those before it.
ROOM, SHARE, GROUP, WAVE = 1 << 20, 1 << 22, 1 << 23, 8
#: Bounds whose highest is looked at first.
_RUN = 64


def integers(vectors: DataFrame, id_column: str, vector_column: str, scale: int = 1024) -> DataFrame:
    """Columns ``vec_id, vec``: components as ``floor(scale * x)``; vectors that are null, or hold a null or a number that isn't finite, are left out."""
    scaled = F.transform(quoted(vector_column), lambda x: F.floor(scale * x.cast("double")).cast("long"))
    usable = quoted(vector_column).isNotNull() & F.forall(quoted(vector_column), lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return vectors.where(usable).select(quoted(id_column).cast("long").alias("vec_id"), scaled.alias("vec"))


def _numbers(vec: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    if not dim:
        return np.zeros((len(flat), 0), dtype=np.int64)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _small(numbers: np.ndarray) -> bytes:
    """The numbers in as few bytes each as hold them all."""
    ends = (int(numbers.min(initial=0)), int(numbers.max(initial=0)))
    kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= ends[0] and ends[1] <= np.iinfo(k).max)
    return numbers.astype(kind).tobytes()


def _matrix(data: np.ndarray, n: int, dim: int) -> np.ndarray:
    """The numbers that ``_small`` stored, a row for each vector."""
    return data.view(f"i{len(data) // (n * dim) if n * dim else 8}").reshape(n, dim)


def _rows(table: pa.Table) -> Iterator[dict]:
    """A table's rows; bytes as arrays where they lie."""
    for batch in table.to_batches():
        for i in range(len(batch)):
            values = ((name, column[i]) for name, column in zip(batch.schema.names, batch.columns, strict=True))
            yield {name: np.frombuffer(x.as_buffer(), dtype=np.int8) if pa.types.is_binary(x.type) else x.as_py() for name, x in values}


def _row(schema: str, *values) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([value], kinds[kind]) for (name, kind), value in zip(fields, values, strict=True)})


_PACKED = "dim int, share long, n int, ids binary, exact binary, cells binary, low binary, width binary"


def _pack(table: pa.Table) -> pa.Table:
    """A block's vectors: exact, and as cells of a grid between each component's least and greatest value in the block, counted from its middle."""
    dim, share = (table.column(c)[0].as_py() for c in ("dim", "share"))
    ids, exact = table.column("vec_id").to_numpy(), _numbers(table.column("vec"), dim)
    order = np.argsort(ids, kind="stable")
    ids, exact = ids[order], exact[order]
    low = exact.min(axis=0)
    width = (exact.max(axis=0) - low) // CELLS + 1
    cells = ((exact - low) // width - CELLS // 2).astype(np.int8)
    return _row(_PACKED, dim, share, len(ids), ids.tobytes(), _small(exact), cells.tobytes(), low.tobytes(), width.tobytes())


_GATHERED = "dim int, group long, n int, qids binary, queries binary, reach binary"


def _gather(table: pa.Table) -> pa.Table:
    """A block of queries with the score that each is sure to reach."""
    dim, group = (table.column(c)[0].as_py() for c in ("dim", "group"))
    ids, reach = (table.column(c).to_numpy() for c in ("query_id", "reach"))
    return _row(_GATHERED, dim, group, len(ids), ids.tobytes(), _small(_numbers(table.column("vec"), dim)), reach.tobytes())


def _dims(rows: DataFrame, size: int, part: int, name: str) -> DataFrame:
    """Columns ``d, blocks, parts``: blocks of about ``size`` rows of each dimension, and parts of about ``part`` components that they are dealt to."""
    counts = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    wide = F.greatest(F.col("d"), F.lit(1))
    blocks = F.ceil(F.col("rows") / F.least(F.lit(size), F.greatest(F.lit(1), F.floor(F.lit(ROOM) / wide)))).cast("long")
    parts = F.least(blocks, F.ceil(F.col("rows") * wide / F.lit(part)).cast("long"))
    return written(counts.select("d", blocks.alias("blocks"), parts.alias("parts")), name)


def _dealt(rows: DataFrame, dims: DataFrame, key: Column, part: str) -> DataFrame:
    """The rows with their dimension, block and part."""
    met = rows.withColumn("dim", F.size("vec")).join(F.broadcast(dims), F.col("dim") == F.col("d"))
    return met.withColumn("block", F.pmod(key, F.col("blocks"))).withColumn(part, F.pmod("block", "parts")).drop("d", "blocks", "parts")


def _copies(name: str):
    """Each row once for each number from ``first`` to below ``last``, one after another."""

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, last = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("first", "last"))
            rest = batch.select([c for c in batch.schema.names if c not in ("first", "last")])
            for i in range(len(batch)):
                for number in range(first[i], last[i]):
                    yield pa.RecordBatch.from_arrays([*rest.slice(i, 1).columns, pa.array([number], pa.int64())], [*rest.schema.names, name])

    return copies


_NONE = np.iinfo(np.int64).min
_RESULT = "query_id long, vec_id long, score long"


class _Share:
    """The blocks of a share, in a task's memory."""

    def __init__(self, table: pa.Table):
        rows = list(_rows(table))
        self.dim, self.ids = rows[0]["dim"], [r["ids"].view(np.int64) for r in rows]
        self.exact = [_matrix(r["exact"], r["n"], self.dim) for r in rows]
        self.cells = [r["cells"].reshape(r["n"], self.dim) for r in rows]
        self.low, self.width = (np.array([r[c].view(np.int64) for r in rows], dtype=np.float64) for c in ("low", "width"))
        self.runs = max(-(-len(x) // _RUN) for x in self.ids)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What to add to the products of queries and cells in each block, for the least and the greatest possible score.

        The products are taken in floating-point numbers of 32 bits, these sums in 64 bits; both are wider than that by what rounding can be.
        """
        size, up = np.abs(queries), np.maximum(queries, 0)
        middle = queries @ (self.low + CELLS // 2 * self.width).T
        most, least = middle + up @ (self.width - 1).T, middle - (size - up) @ (self.width - 1).T
        slack = (self.dim + 4) * (2.0**-23 * (size @ (CELLS // 2 * self.width).T) + 2.0**-51 * (size @ (np.abs(self.low) + CELLS * self.width).T))
        return least - slack, most + slack


def _ranks(query: np.ndarray) -> np.ndarray:
    """How many of the same query come before each place; queries lie together."""
    return np.arange(len(query)) - np.searchsorted(query, query)


class _Best:
    """The k best rows so far of each query of a slice, in the order (score, least id)."""

    def __init__(self, k: int, reach: np.ndarray):
        self.k, self.reach, self.rows, self.more, self.waiting = k, reach.copy(), np.zeros((3, 0), dtype=np.int64), [], 0

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray, now: bool) -> None:
        real = scores >= self.reach[query]
        self.more.append(np.array([query[real], ids[real], scores[real]], dtype=np.int64))
        self.waiting += self.more[-1].shape[1]
        if now or 2 * self.waiting >= self.k * len(self.reach):
            self.settle()

    def settle(self) -> None:
        rows = np.concatenate([self.rows, *self.more], axis=1)
        query, ids, scores = rows = rows[:, np.lexsort((rows[1], -rows[2], rows[0]))]
        place = _ranks(query)
        last = place == self.k - 1
        self.reach[query[last]] = np.maximum(self.reach[query[last]], scores[last])
        self.rows, self.more, self.waiting = rows[:, place < self.k], [], 0


def _visit(best: _Best, queries: np.ndarray, ids: np.ndarray, exact: np.ndarray, query: np.ndarray, row: np.ndarray, bound: np.ndarray) -> None:
    """Exact scores of candidates, in the order of their bounds, a few of each query at a time until no bound that is left reaches its kth best."""
    order = np.lexsort((-bound, query))
    query, row, bound = query[order], row[order], bound[order]
    rank = _ranks(query)
    rounds = -(-int(rank.max() + 1) // READ)
    for at in range(rounds):
        near = np.flatnonzero((rank // READ == at) & (bound >= best.reach[query])) if rounds > 1 else np.arange(len(query))
        if not len(near):
            break
        step = max(1, ROOM // 2 // max(1, queries.shape[1]))
        parts = (near[i : i + step] for i in range(0, len(near), step))
        scores = np.concatenate([np.einsum("ij,ij->i", queries[query[p]], exact[row[p]].astype(np.int64)) for p in parts])
        best.add(query[near], ids[row[near]], scores, at < rounds - 1)


def _slice(share: _Share, qids: np.ndarray, queries: np.ndarray, reach: np.ndarray, k: int) -> _Best:
    """The k best of a share for each query of a slice."""
    best, n = _Best(k, reach), len(qids)
    real = queries.astype(np.float64)
    leasts, mosts = share.bounds(real)
    space = np.empty((share.runs * _RUN, n), dtype=np.float32)
    for b, ids in enumerate(share.ids):
        bounds = space[: -(-len(ids) // _RUN) * _RUN]
        np.matmul(share.cells[b].astype(np.float32), (real * share.width[b]).astype(np.float32).T, out=bounds[: len(ids)])
        bounds[len(ids) :] = -np.inf
        starts, ends = np.searchsorted(ids, qids), np.searchsorted(ids, qids, side="right")
        for q in np.flatnonzero(ends > starts):
            bounds[starts[q] : ends[q], q] = -np.inf
        runs = bounds.reshape(-1, _RUN, n)
        heads = runs.max(axis=1)
        if len(heads) >= k and (best.reach == _NONE).any():
            sure = np.floor(np.partition(heads, len(heads) - k, axis=0)[len(heads) - k] + leasts[:, b])
            best.reach = np.maximum(best.reach, np.where(np.abs(sure) < 2.0**62, sure, _NONE).astype(np.int64))
        # as a number of 32 bits that isn't greater; what has no bound is less than each
        least = best.reach * (1 + np.sign(best.reach) * -(2.0**-51)) - mosts[:, b]
        limit = np.maximum(np.nextafter(least.astype(np.float32), np.float32(-np.inf)), np.finfo(np.float32).min)
        run, query = np.nonzero(heads >= limit)
        if len(run):
            hopeful = runs[run, :, query]
            pair, place = np.nonzero(hopeful >= limit[query, None])
            query = query[pair]
            bound = hopeful[pair, place] + mosts[query, b]
            _visit(best, queries, ids, share.exact[b], query, run[pair] * _RUN + place, bound)
    best.settle()
    return best


def _found(k: int):
    """Each query's k best of a share."""

    def found(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out = [np.zeros((3, 0), dtype=np.int64)]
        if len(queries) and len(vectors):
            share = _Share(vectors)
            for row in _rows(queries):
                qids, reach = (row[c].view(np.int64) for c in ("qids", "reach"))
                numbers = _matrix(row["queries"], row["n"], share.dim)
                for part in (slice(at, at + SLICE) for at in range(0, row["n"], SLICE)):
                    query, ids, scores = _slice(share, qids[part], numbers[part].astype(np.int64), reach[part], k).rows
                    out.append(np.array([qids[part][query], ids, scores]))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), np.concatenate(out, axis=1), strict=True)))

    return found


def _wave(blocks: DataFrame, queries: DataFrame, shares: DataFrame, groups: DataFrame, span: tuple[int, int], k: int) -> DataFrame:
    """Every group of queries against those shares of its dimension that belong to a wave, each by a task: at most k rows per query and share."""
    first, last = (F.ceil(F.col("parts") / x).cast("long") if x else F.lit(0).cast("long") for x in span)
    own = F.broadcast(shares.select("d", first.alias("first"), last.alias("last")))
    some = blocks.join(own, (F.col("dim") == F.col("d")) & (F.col("share") >= F.col("first")) & (F.col("share") < F.col("last"))).drop("d", "first", "last")
    dealt = some.join(F.broadcast(groups.select("d", F.lit(0).cast("long").alias("first"), F.col("parts").alias("last"))), F.col("dim") == F.col("d")).drop("d")
    vectors = dealt.mapInArrow(_copies("group"), f"{_PACKED}, group long")
    asked = queries.join(own, F.col("dim") == F.col("d")).drop("d").mapInArrow(_copies("share"), f"{_GATHERED}, share long")
    keys = ("dim", "group", "share")
    return asked.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInArrow(_found(k), _RESULT)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
    return found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """Columns ``query_id, rank, vec_id, score``: each query's ``k`` highest inner products with rows of another id.

    ``vectors`` has ``vec_id`` and ``vec`` (whole numbers); ``is_query`` says which rows are queries.  Ties go to the smaller
    id.  Only vectors of a query's dimension are its candidates.  Rows with a null id take no part.  Rows that repeat an
    id are candidates each; of queries that repeat an id, the least vector is the query.
    """
    bound_batches(vectors.sparkSession)
    vectors = written(vectors.where("vec_id IS NOT NULL"), "vectors")
    shares = _dims(vectors, BLOCK, SHARE, "shares")
    dealt = _dealt(vectors, shares, F.xxhash64("vec_id", "vec"), "share")
    blocks = written(dealt.groupBy("dim", "share", "block").applyInArrow(_pack, _PACKED), "blocks")
    queries = written(vectors.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec")), "queries")
    groups = _dims(queries, QUERIES, GROUP, "groups")
    queries = _dealt(queries, groups, F.xxhash64("vec_id"), "group").withColumnRenamed("vec_id", "query_id")
    most, spans = shares.agg(F.max("parts")).first()[0] or 1, [1]
    while spans[0] * WAVE <= most:
        spans.insert(0, spans[0] * WAVE)
    best, reached = None, queries.withColumn("reach", F.lit(_NONE))
    for span in zip([0, *spans], spans, strict=False):
        # written, so that no task holds two Python workers, one that gathers and one that copies
        asked = written(reached.groupBy("dim", "group", "block").applyInArrow(_gather, _GATHERED), "asked")
        found = _wave(blocks, asked, shares, groups, span, k)
        best = _ranked(found if best is None else found.unionByName(best.drop("rank")), k)
        if span[1] > 1:
            best = written(best, "best")
            kth = best.where(F.col("rank") == k).select(F.col("query_id").alias("q"), F.col("score").alias("reach"))
            reached = queries.join(kth, F.col("query_id") == F.col("q"), "left").drop("q").withColumn("reach", F.coalesce("reach", F.lit(_NONE)))
    return best
