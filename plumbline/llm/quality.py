"""Quality classifier: a generalised additive model with pairwise interactions.

Measures of a text's words and characters are cut into bins.  Boosting goes round the measures in cycles: each
turn fits a shallow tree to one measure's bins and adds it to that measure's table.  Then the
pairs of measures that explain most of what is left get tables of both bins, in the same way.  A score is a sum of table
entries, so it needs no tree, and every table can be read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, text_of, written
from plumbline.llm.texthash import words_of

#: Labelled rows that the model is fitted on, at most: a sample by hash of the id if there are more.
FIT_ROWS = 20_000
#: Bins of a measure, bins of a pair's side, pairs, turns, turns of pairs, step, weight of no change.
BINS, SIDE, PAIRS, TURNS, PAIR_TURNS, STEP, RIDGE = 48, 12, 6, 120, 60, 0.15, 5.0

MEASURES = (
    "words", "word_bytes", "word_spread", "distinct", "repeated_next", "top_word", "distinct_pairs", "short_words",
    "upper", "digits", "symbols", "marks", "letters", "words_per_line", "mark_ends",
)

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91], _KIND[48:58] = 1, 2
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 3
_KIND[[ord(c) for c in ".,;:?!\"'()-"]] = 4
_KIND[97:123] = _KIND[128:] = 5
_KIND[10] = 6


def measured(raw, starts, ends, hashes, pairs) -> list[float]:
    """The measures of one text, from its bytes, the places of its words, and hashes of words and of pairs of words."""
    kinds = np.bincount(np.take(_KIND, raw), minlength=7) / max(1, len(raw))
    n = len(hashes)
    if not n:
        return [0.0] * 8 + [float(kinds[k]) for k in (1, 2, 3, 4, 5)] + [0.0, 0.0]
    sizes = (ends - starts).astype(np.float64)
    _, counts = np.unique(hashes, return_counts=True)
    return [
        np.log1p(n),
        sizes.mean(),
        sizes.std(),
        len(counts) / n,
        float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0,
        counts.max() / n,
        len(np.unique(pairs)) / max(1, len(pairs)),
        float((sizes <= 3).mean()),
        *[float(kinds[k]) for k in (1, 2, 3, 4, 5)],
        n / (1 + kinds[6] * len(raw)),
        float((np.take(_KIND, raw[ends - 1]) >= 3).mean() - (np.take(_KIND, raw[ends - 1]) >= 5).mean()),
    ]


def measured_texts(texts: pa.Array) -> list[list[float]]:
    """The measures of each text of an Arrow column."""
    rows = []
    for _, words in words_of(texts):
        pairs, edges = words.shingles(2)
        for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
            base, end = words.edges[i], words.edges[i + 1]
            rows.append(measured(words.raw[base:end], words.starts[a:b] - base, words.ends[a:b] - base, words.hashes[a:b], pairs[edges[i] : edges[i + 1]]))
    return rows


def measures(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Columns ``doc_id, x``: the measures of each whole text; a null text is an empty one."""
    kind = docs.schema[id_column].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(measured_texts(batch.column(1)), pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(quoted(id_column).alias("doc_id"), text_of(text_column).alias("text")).mapInArrow(measure, f"doc_id {kind}, x array<double>")


@dataclass
class Additive:
    """Tables of a fitted model; a score is the logistic function of the base and one entry of each table."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, k], "right")]
        for a, b, edges_a, edges_b, table in self.pairs:
            total += table[np.searchsorted(edges_a, x[:, a], "right"), np.searchsorted(edges_b, x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A tree over ordered bins with a few leaves: for each bin its leaf's value."""
    up, down = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])

    def split(a: int, b: int) -> tuple[float, int]:
        at = np.arange(a + 1, b)
        if not len(at):
            return 0.0, a
        value = lambda i, j: (up[j] - up[i]) ** 2 / (down[j] - down[i] + RIDGE)
        gain = value(a, at) + value(at, b) - value(a, b)
        return float(gain.max()), int(at[gain.argmax()])

    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((split(a, b), (a, b)) for a, b in parts), key=lambda s: s[0][0])
        if best[0][0] <= 1e-9:
            break
        (_, at), (a, b) = best
        parts[parts.index((a, b)) : parts.index((a, b)) + 1] = [(a, at), (at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -(up[b] - up[a]) / (down[b] - down[a] + RIDGE)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four quarters: its gain, and each place's value."""
    ug, uh = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    n, m = g.shape
    if n < 2 or m < 2:
        return 0.0, np.zeros_like(g)
    parts = []
    for u in (ug, uh):
        inner, right, low, all_ = u[:-1, :-1], u[:-1, -1:], u[-1:, :-1], u[-1, -1]
        parts.append((inner, right - inner, low - inner, all_ - right - low + inner))
    gain = sum(a**2 / (b + RIDGE) for a, b in zip(*parts, strict=True))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.empty_like(g)
    spots = ((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, m)), (slice(i + 1, n), slice(0, j + 1)), (slice(i + 1, n), slice(j + 1, m)))
    for spot, a, b in zip(spots, *parts, strict=True):
        out[spot] = -a[i, j] / (b[i, j] + RIDGE)
    return float(gain[i, j] - ug[-1, -1] ** 2 / (uh[-1, -1] + RIDGE)), out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """A model of the labels 0 and 1; with labels of one kind only, or none, it scores all alike."""
    model = Additive()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.base = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return model
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    model.edges = [_edges(column, BINS) for column in x.T]
    bins = [np.searchsorted(e, column, "right") for e, column in zip(model.edges, x.T, strict=True)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    for _ in range(TURNS):
        for k, own in enumerate(bins):
            g, h = slopes()
            n = len(model.tables[k])
            change = STEP * _tree(np.bincount(own, g, n), np.bincount(own, h, n))
            model.tables[k] += change
            total += change[own]
    edges = [_edges(column, SIDE) for column in x.T]
    sides = [np.searchsorted(e, column, "right") for e, column in zip(edges, x.T, strict=True)]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        n, m = len(edges[a]) + 1, len(edges[b]) + 1
        return np.bincount(sides[a] * m + sides[b], values, n * m).reshape(n, m)

    g, h = slopes()
    ranked = sorted(((_quarters(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(len(edges)) for b in range(a)), reverse=True)
    chosen = [(a, b) for _, a, b in ranked[:PAIRS]]
    tables = {pair: np.zeros((len(edges[pair[0]]) + 1, len(edges[pair[1]]) + 1)) for pair in chosen}
    for _ in range(PAIR_TURNS):
        for a, b in chosen:
            g, h = slopes()
            change = STEP * _quarters(grid(a, b, g), grid(a, b, h))[1]
            tables[a, b] += change
            total += change[sides[a], sides[b]]
    model.pairs = [(a, b, edges[a], edges[b], tables[a, b]) for a, b in chosen]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(measured_docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = FIT_ROWS) -> Additive:
    """A model of ``label`` from labelled documents that are not held out: at most about ``most`` rows reach the driver.

    A document that is labelled more than once counts as what most of its labels say; null labels and
    labels without a document say nothing.
    """
    known = labels.select(quoted("doc_id").alias("l"), quoted(label).cast("double").alias("y")).where("l IS NOT NULL AND y IS NOT NULL")
    known = known.where(~held_out(F.col("l"))).groupBy("l").agg(F.round(F.avg("y")).alias("y"))
    rows = measured_docs.join(known, F.col("doc_id") == F.col("l")).select("doc_id", "x", "y")
    # copies of a row say nothing new, and with them the draw by a hash would have no bound
    rows = written(rows.dropDuplicates(["doc_id", "x"]).withColumn("draw", F.xxhash64("doc_id", "x")), "labelled")
    n = rows.count()
    if n > most:
        rows = rows.where(F.pmod("draw", F.lit(1 << 30)) < int((1 << 30) * most / n))
    data = rows.toArrow().sort_by([("doc_id", "ascending"), ("draw", "ascending")])
    x = np.array(data.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(MEASURES))
    return fit(x, data.column("y").to_numpy().astype(np.float64))


def score(measured_docs: DataFrame, model: Additive) -> DataFrame:
    """Columns ``doc_id, score`` from ``doc_id, x``."""
    kind = measured_docs.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    return measured_docs.select("doc_id", "x").mapInArrow(apply, f"doc_id {kind}, score double")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Columns ``doc_id, held_out, score, predicted`` per document."""
    x = written(measures(docs, "doc_id", "text"), "measures")
    found = score(x, learn(x, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def text_score(text: Column, model: Additive) -> Column:
    """The score of a text, beside the other columns of its row."""

    @F.arrow_udf("double")
    def apply(texts: pa.Array) -> pa.Array:
        x = np.array(measured_texts(texts), dtype=np.float64).reshape(-1, len(MEASURES))
        return pa.array(model.scores(x), pa.float64())

    return apply(text)


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least one half, as they are; rows of one id are judged each by their own text.

    Texts are measured again when rows are judged, so that no row has to be shuffled to meet its score.
    """
    model = learn(written(measures(docs, "doc_id", "text"), "measures"), labels)
    return docs.where(text_score(text_of("text"), model) >= 0.5)
