"""Hard negatives by a vertical scan (BOND): dimensions one after the other, not vectors.

Vectors lie in groups, column by column.  For an anchor a group's columns are read in the order of the anchor's magnitudes, the
greatest first, a few at a time.  What is read gives each candidate a partial score; the least and greatest value
of every column still to come bound the rest.  Candidates whose bounds can't reach the result leave the bitmap, and
later columns are read for those that are left, until their scores are exact.

1. Positives: each anchor against the groups that hold its label; the bound to reach is its kth best lower bound so far.
2. Windows: each positive allows negatives in an interval of scores.  Each anchor, with its intervals, against the groups that hold
   other labels; the bound to reach in an interval is the kth best lower bound of those that can't be above it.

Groups are of one label, or of several rare ones, and of a bounded number of components; a frequent label has several.  Each
group is sent to a task once, and anchors are sent to it: they are the smaller side, and stream past it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import partitions, quoted, written

#: Components of a group at most, rows that make a group worthwhile, rows scanned at a time.
GROUP, LEAST, BLOCK = 1 << 24, 512, 1 << 14
_FAR = np.iinfo(np.int64).max
_FLOAT, _LONG = 2.0**53, 2.0**63


def integers(vectors: DataFrame, id_column: str, vector_column: str, label: Column, scale: int = 256) -> DataFrame:
    """Columns ``vec_id, label, vec``: components as ``floor(scale * x)``.

    Rows with a null id, label or vector, or a vector that holds a null or a number that isn't finite, are left out.
    """
    vec = quoted(vector_column)
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    scaled = F.transform(vec, lambda x: F.floor(scale * x.cast("double")).cast("long"))
    rows = vectors.where(vec.isNotNull() & finite & quoted(id_column).isNotNull())
    return rows.select(quoted(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), scaled.alias("vec")).where("label IS NOT NULL")


class Block:
    """Candidates column by column, with the least and greatest value of each column."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(rows.T)
        self.low, self.high = (f(axis=1).astype(np.int64) for f in (self.columns.min, self.columns.max))


def scan(block: Block, anchor: np.ndarray, bitmap: np.ndarray, survivors) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the candidates that no step ruled out.

    ``survivors`` gets the lower and upper bounds of the candidates in the bitmap and says which stay.
    """
    dim = len(anchor)
    order = np.argsort(-np.abs(anchor), kind="stable")
    whole = float((np.abs(anchor.astype(float)) * np.maximum(np.abs(block.low.astype(float)), np.abs(block.high.astype(float)))).sum())
    if whole >= _LONG:
        raise OverflowError("scores exceed 64 bits")
    ends = np.stack([anchor * block.low, anchor * block.high])[:, order]
    rest_low, rest_high = (np.concatenate([np.cumsum(e[::-1])[::-1], [0]]) for e in (ends.min(axis=0), ends.max(axis=0)))
    at = np.flatnonzero(bitmap)
    part = np.zeros(len(at), dtype=np.int64)
    kind = np.float64 if whole < _FLOAT else np.int64  # floating point where it is exact
    step = max(1, -(-dim // 8))
    for k in range(0, dim, step):
        if not len(at):
            break
        read = order[k : k + step]
        columns = block.columns[read] if len(at) == len(block.ids) else block.columns[np.ix_(read, at)]
        part += (anchor[read].astype(kind) @ columns.astype(kind)).astype(np.int64)
        done = min(dim, k + step)
        stay = survivors(part + rest_low[done], part + rest_high[done])
        at, part = at[stay], part[stay]
    if not dim and len(at):
        stay = survivors(part, part)
        at, part = at[stay], part[stay]
    return at, part


def _kth(values: np.ndarray, k: int, least: int) -> int:
    """The kth greatest value if there are as many and it is above ``least``."""
    return least if len(values) < k else max(least, int(np.partition(values, len(values) - k)[len(values) - k]))


def _best(found: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    return sorted(found, key=lambda f: (-f[1], f[0]))[:k]


def positives_in(blocks: list[Block], own: int, label: int, anchor: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Id and score of the anchor's ``k`` best candidates of its label."""
    found: list[tuple[int, int]] = []
    for block in blocks:
        reach = [found[-1][1] if len(found) == k else -_FAR]

        def survivors(low: np.ndarray, high: np.ndarray, reach=reach) -> np.ndarray:
            reach[0] = _kth(low, k, reach[0])
            return high >= reach[0]

        at, scores = scan(block, anchor, (block.labels == label) & (block.ids != own), survivors)
        found = _best(found + list(zip(block.ids[at].tolist(), scores.tolist(), strict=True)), k)
    return found


def negatives_in(blocks: list[Block], own: int, label: int, anchor: np.ndarray, spans: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
    """For each interval of scores, id and score of its ``k`` best candidates of other labels."""
    found: list[list[tuple[int, int]]] = [[] for _ in spans]
    for block in blocks:
        reach = [f[-1][1] if len(f) == k else low for f, (low, _) in zip(found, spans, strict=True)]

        def survivors(low: np.ndarray, high: np.ndarray, reach=reach) -> np.ndarray:
            stay = np.zeros(len(low), dtype=bool)
            for s, (_, top) in enumerate(spans):
                if reach[s] <= top:
                    reach[s] = _kth(low[high <= top], k, reach[s])
                    stay |= (high >= reach[s]) & (low <= top)
            return stay

        at, scores = scan(block, anchor, (block.labels != label) & (block.ids != own), survivors)
        for s, (least, top) in enumerate(spans):
            inside = np.flatnonzero((scores >= max(least, reach[s])) & (scores <= top))
            found[s] = _best(found[s] + list(zip(block.ids[at[inside]].tolist(), scores[inside].tolist(), strict=True)), k)
    return found


def _matrix(vec: pa.Array, dim: int, kind) -> np.ndarray:
    return vec.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(vec), dim)


def _groups(batches: Iterator[pa.RecordBatch], kind) -> Iterator[tuple[list[Block], pa.RecordBatch]]:
    """The blocks of a group with each batch of its anchors: rows come sorted by group, candidates first."""
    group, held, n_held, blocks = None, [], 0, []

    def close() -> None:
        nonlocal held, n_held
        if held:
            blocks.append(Block(*(np.concatenate(x) for x in zip(*held, strict=True))))
            held, n_held = [], 0

    for batch in batches:
        groups, roles = (batch.column(k).to_numpy() for k in (0, 1))
        cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(roles) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if groups[a] != group:
                group, held, n_held, blocks = groups[a], [], 0, []
            if roles[a] == 0:
                dim = len(part.column(4)[0])
                for x in range(0, len(part), BLOCK):
                    some = part.slice(x, BLOCK)
                    held.append((some.column(2).to_numpy(), some.column(3).to_numpy(), _matrix(some.column(4), dim, kind)))
                    n_held += len(some)
                    if n_held >= BLOCK:
                        close()
            else:
                close()
                yield blocks, part


def _positives(k: int, kind):
    names = ["anchor_id", "positive_id", "positive_score"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks, anchors in _groups(batches, kind):
            out = []
            matrix = _matrix(anchors.column(4), len(anchors.column(4)[0]), np.int64)
            for own, label, anchor in zip(anchors.column(2).to_pylist(), anchors.column(3).to_pylist(), matrix, strict=True):
                out += [(own, *f) for f in positives_in(blocks, own, label, anchor, k)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 3)], names)

    return find


def _negatives(k: int, kind):
    names = ["anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks, anchors in _groups(batches, kind):
            out = []
            matrix = _matrix(anchors.column(4), len(anchors.column(4)[0]), np.int64)
            for own, label, anchor, spans in zip(*(anchors.column(c).to_pylist() for c in (2, 3)), matrix, anchors.column(5).to_pylist(), strict=True):
                found = negatives_in(blocks, own, label, anchor, [(s["low"], s["high"]) for s in spans], k)
                out += [(own, s["place"], s["positive_id"], s["positive_score"], *f) for s, some in zip(spans, found, strict=True) for f in some]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 6)], names)

    return find


def _families(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Which family each (dim, label) belongs to, and the groups of each family: ``dim, alone, family, first, groups``.

    A label with rows enough for a group has a family of its own; the rest of a dimension's labels share pools, by a hash.  There
    are at most a few families per group's worth of rows.
    """
    n = partitions(vectors.sparkSession)
    labels = written(vectors.groupBy(F.size("vec").alias("dim"), "label").agg(F.count(F.lit(1)).alias("rows")), "labels")
    total = labels.groupBy("dim").agg(F.sum("rows").alias("all"), F.count(F.lit(1)).alias("labels"))
    most = F.greatest(F.lit(1), F.floor(F.lit(GROUP) / F.greatest(F.col("dim"), F.lit(1))))
    total = total.withColumn("size", F.least(most, F.greatest(F.lit(LEAST), F.ceil(F.col("all") / F.lit(2 * n)))).cast("long"))
    kinds = labels.join(total, "dim")
    alone = 2 * F.col("rows") >= F.col("size")
    rest = Window.partitionBy("dim", "alone")
    pooled = kinds.withColumn("alone", alone).groupBy("dim", "alone").agg(F.sum("rows").alias("pooled"))
    kinds = kinds.withColumn("alone", alone).join(pooled, ["dim", "alone"])
    pools = F.greatest(F.lit(1), F.ceil(F.col("pooled") / F.col("size"))).cast("long")
    kinds = kinds.withColumn("family", F.when(F.col("alone"), F.col("label")).otherwise(F.pmod(F.xxhash64("label"), pools)))
    families = kinds.groupBy("dim", "alone", "family").agg(F.sum("rows").alias("rows"), F.max("size").alias("size"))
    families = families.withColumn("groups", F.ceil(F.col("rows") / F.col("size")).cast("long"))
    before = F.sum("groups").over(Window.orderBy("dim", "alone", "family").rowsBetween(Window.unboundedPreceding, -1))
    families = families.withColumn("first", F.coalesce(before, F.lit(0)))
    return kinds.select("dim", "label", "alone", "family"), families.select("dim", "alone", "family", "first", "groups")


def _meet(groups: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """Groups and the anchors sent to them, each group whole in one partition and its candidates first."""
    union = groups.unionByName(anchors, allowMissingColumns=True)
    return union.repartitionById(n, F.pmod(F.col("grp"), F.lit(n)).cast("int")).sortWithinPartitions("grp", "role")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Columns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank``.

    ``vectors`` has ``vec_id``, ``label`` and ``vec`` (whole numbers); ``is_anchor`` says which rows are anchors.  A row's score is its inner
    product with the anchor.  An anchor's positives are its best ``positives`` rows of its label; for each, the best ``negatives`` rows of other
    labels are returned whose score is from ``low`` to ``high`` percent of the positive's.  Ties go to the smaller id.  Only vectors of the anchor's dimension
    take part, and none with its id; rows that repeat an id are candidates each, so one id may be a positive twice, told apart by
    ``positive_rank``; of anchors that repeat an id, the least (label, vector) is the anchor.  Rows with nulls take no part.
    Scores beyond 64 bits are an error.
    """
    spark = vectors.sparkSession
    n = partitions(spark)
    vectors = written(vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))), "vectors")
    top = vectors.agg(F.max(F.greatest(F.abs(F.array_max("vec")), F.abs(F.array_min("vec"))))).first()[0] or 0
    kind = np.int32 if top < 2**31 else np.int64
    kinds, families = (written(x, "families") for x in _families(vectors))

    placed = vectors.withColumn("dim", F.size("vec")).join(kinds, ["dim", "label"]).join(families, ["dim", "alone", "family"])
    number = F.col("first") + F.pmod(F.xxhash64("vec_id", "vec"), F.col("groups"))
    groups = placed.select(number.cast("int").alias("grp"), F.lit(0).alias("role"), "vec_id", "label", "vec")
    chosen = vectors.where("is_anchor").groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row"))
    chosen = chosen.select("vec_id", "row.label", "row.vec", F.size("row.vec").alias("dim"))
    anchors = written(chosen.join(kinds, ["dim", "label"]).join(families, ["dim", "alone", "family"]), "anchors")

    own = F.sequence(F.col("first"), F.col("first") + F.col("groups") - 1)
    same = anchors.select(F.explode(own.cast("array<int>")).alias("grp"), F.lit(1).alias("role"), "vec_id", "label", "vec")
    near = _meet(groups, same, n).mapInArrow(_positives(positives, kind), "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")).cast("long")
    near = near.withColumn("place", place).where(F.col("place") <= positives)

    # the interval in whole numbers; an empty one, as of a negative score, has no negatives
    least = F.ceil(F.col("positive_score").cast("decimal(38,0)") * low / 100).cast("long")
    most = F.floor(F.col("positive_score").cast("decimal(38,0)") * high / 100).cast("long")
    near = near.withColumn("low", least).withColumn("high", most).where("low <= high")
    spans = near.groupBy("anchor_id").agg(F.collect_list(F.struct("place", "positive_id", "positive_score", "low", "high")).alias("spans"))
    spans = written(spans, "spans")
    every = families.groupBy("dim").agg(F.min("first").alias("d_first"), F.max(F.col("first") + F.col("groups")).alias("d_end"))
    wide = anchors.join(spans, F.col("vec_id") == F.col("anchor_id")).join(every, "dim")
    others = F.filter(
        F.sequence(F.col("d_first"), F.col("d_end") - 1),
        lambda g: ~(F.col("alone") & (g >= F.col("first")) & (g < F.col("first") + F.col("groups"))),
    )
    sent = wide.select(F.explode(others.cast("array<int>")).alias("grp"), F.lit(1).alias("role"), "vec_id", "label", "vec", "spans")
    columns = "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meet(groups, sent, n).mapInArrow(_negatives(negatives, kind), columns)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.col("negative_score").desc(), "negative_id"))
    found = found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("place").cast("int").alias("positive_rank"))
