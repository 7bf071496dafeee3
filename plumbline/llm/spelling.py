"""Groups of spelling variants by k-d trees over letter counts.

One inserted, deleted or replaced letter moves a word's vector of letter counts by at most two in sum of absolute differences: by
one step up and one down for words of one length, by one step up towards words one longer.  A tree cuts the space of (length,
letter counts) into boxes; a word is sent to its own box as a target, and as a query to every box that its few steps
can reach, for its own length and for the next.  Within a box each length has a tree of its own, whose branches are pruned in the same
way; at their ends counts are compared as bits, and pairs that stay are verified letter by letter.  Letters share counts modulo a small alphabet, which
only brings words nearer.

The upper tree is fitted on a bounded sample of words; every word is dealt by it, and no pair depends on where it cuts.  A box that
still holds too much is dealt into blocks of its targets and of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import partitions, quoted, text_of, written

# The letters of a word, and which of them have a lower case here.
RUN = r"[A-Za-z\x{C0}-\x{FF}]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Counted letters: a to z, and six shares of the rest.
LETTERS = 32
#: Words that the upper tree is fitted on, words of a box, words of a branch's end, queries of a block, pairs verified at a time.
SAMPLE, BOX, END, QUERIES, PAIRS = 1 << 16, 1 << 15, 96, 1 << 18, 1 << 17


def occurrences(docs: DataFrame, id_column: str, text_column: str, least: int, deletions: int | None) -> DataFrame:
    """Column ``word``, a row per occurrence: whole runs of letters, A to Z in lower case, of at least ``least`` letters.

    With ``deletions``, a run whose hash with the row's id it divides loses the letter that the hash points to, so that
    variants are known.  Null texts have no words; a null id is an empty one.
    """
    # runs that are too short can't match, since a run is taken from its beginning
    runs = F.regexp_extract_all(text_of(text_column), F.lit(f"({RUN}{{{least},}})"), 1)
    word = F.translate("run", UPPER, LOWER)
    rows = docs.select(F.coalesce(quoted(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")).select("id", word.alias("word"))
    if deletions is None:
        return rows.select("word")
    digest = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
    at = (F.col("h") % F.length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    rows = rows.withColumn("h", digest).select(F.when(F.col("h") % deletions == 0, shorter).otherwise(F.col("word")).alias("word"))
    return rows.where(F.length("word") >= least)


def letters(words: list[str]) -> np.ndarray:
    """A row per word: its length, then its letter counts."""
    joined = "".join(words).encode("utf-32-le")
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    points = np.frombuffer(joined, dtype="<u4").astype(np.int64)
    low = (points >= 97) & (points <= 122)
    slot = np.where(low, points - 97, 26 + points % (LETTERS - 26))
    rows = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(rows * LETTERS + slot, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)
    return np.concatenate([lengths[:, None], counts], axis=1).astype(np.int32)


def marks(points: np.ndarray) -> np.ndarray:
    """Letter counts as 64 bits, one for once and one for twice or more: as many bits differ as counts do, or fewer."""
    return np.packbits(np.concatenate([points[:, 1:] >= 1, points[:, 1:] >= 2], axis=1), axis=1).view(np.uint64).ravel()


@dataclass
class Tree:
    """Inner nodes: ``axis`` and ``cut`` (values up to it go left) with children; ends: ``axis`` -1 and the place of the box."""

    axis: list[int]
    cut: list[int]
    left: list[int]
    right: list[int]
    boxes: int


def grow(points: np.ndarray, end: int) -> tuple[Tree, list[np.ndarray]]:
    """A tree whose ends hold at most ``end`` of the points, or points that are all the same; and each end's points.

    A node is cut along the axis whose halves are most even; along the length if that is nearly as even, since no query of one length reaches another's.
    """
    tree, ends = Tree([], [], [], [], 0), []
    work = [(np.arange(len(points)), None, False)]
    while work:
        some, parent, is_right = work.pop()
        node = len(tree.axis)
        for column in (tree.axis, tree.cut, tree.left, tree.right):
            column.append(-1)
        if parent is not None:
            (tree.right if is_right else tree.left)[parent] = node
        best = None
        if len(some) > end:
            here = points[some]
            middle = np.sort(here, axis=0)[(len(some) - 1) // 2]
            # a cut at the median, or just below it if nothing lies above
            middle = np.where(here.max(axis=0) > middle, middle, middle - 1)
            left = (here <= middle).sum(axis=0)
            even = np.minimum(left, len(some) - left)
            axis = 0 if 4 * even[0] >= len(some) else int(even.argmax())
            if even[axis]:
                best = axis, int(middle[axis])
        if best is None:
            tree.left[node] = len(ends)
            ends.append(some)
            continue
        tree.axis[node], tree.cut[node] = best
        side = points[some, best[0]] <= best[1]
        work += [(some[~side], node, True), (some[side], node, False)]
    tree.boxes = len(ends)
    return tree, ends


def home(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The box of each point."""
    node = np.zeros(len(points), dtype=np.int64)
    axis, cut, left, right = (np.array(x) for x in (tree.axis, tree.cut, tree.left, tree.right))
    while True:
        inner = np.flatnonzero(axis[node] >= 0)
        if not len(inner):
            return left[node]
        at = node[inner]
        goes = points[inner, axis[at]] <= cut[at]
        node[inner] = np.where(goes, left[at], right[at])


def reached(tree: Tree, points: np.ndarray, longer: int, lengths: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Each box with the queries that some target of their length, or one ``longer``, may lie in.

    A query may go one count down and one up within its length, and one up towards words one longer.  Each box's bounds are those of the
    cuts above it: along one axis the steps to the nearer bound, summed over the axes that were crossed.  ``lengths`` says that the first
    axis is a word's length, which has to be met.
    """
    down, up = (0, 1) if longer else (1, 1)
    # per query, what each axis must at least go up or down to be inside the bounds so far
    work = [(0, np.arange(len(points)), {})]
    while work:
        node, some, crossed = work.pop()
        axis = tree.axis[node]
        if axis < 0:
            yield tree.left[node], some
            continue
        value = points[some, axis]
        if axis == 0 and lengths:
            goes_left = value + longer <= tree.cut[node]
            work += [(child, some[goes], {a: s[goes] for a, s in crossed.items()}) for child, goes in ((tree.left[node], goes_left), (tree.right[node], ~goes_left))]
            continue
        for child, steps in ((tree.left[node], np.minimum(tree.cut[node] - value, 0)), (tree.right[node], np.maximum(tree.cut[node] + 1 - value, 0))):
            now = dict(crossed)
            before = now.get(axis)
            now[axis] = steps if before is None else np.where(np.abs(before) > np.abs(steps), before, steps)
            total_up = sum(np.maximum(s, 0) for s in now.values())
            total_down = sum(np.maximum(-s, 0) for s in now.values())
            stay = (total_up <= up) & (total_down <= down)
            if stay.any():
                # axes that nobody crosses needn't be carried
                kept = {a: s[stay] for a, s in now.items()}
                work.append((child, some[stay], {a: s for a, s in kept.items() if s.any()}))


def _same_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_longer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``b`` is that of ``a`` with one letter inserted: what agrees before and after covers all."""
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


def _spelled(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-16-le"), dtype="<u2").reshape(len(words), -1)


def near_pairs(targets: list[str], queries: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places of queries and of targets that are one edit apart, and by how much the target is longer (0 or 1)."""
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(targets):
        by_length.setdefault(len(word), []).append(k)
    asking: dict[int, list[int]] = {}
    for k, word in enumerate(queries):
        asking.setdefault(len(word), []).append(k)
    for length, places in by_length.items():
        some = [targets[k] for k in places]
        points = letters(some)
        tree, ends = grow(points, END)
        spelled, places, bits = _spelled(some), np.array(places), marks(points)
        for longer in (0, 1):
            asked = asking.get(length - longer)
            if not asked:
                continue
            own = [queries[k] for k in asked]
            vectors, written_out, asked = letters(own), _spelled(own), np.array(asked)
            own_bits = marks(vectors)
            check = _one_longer if longer else _same_length
            for box, some_asked in reached(tree, vectors, longer, False):
                at = ends[box]
                rows = max(1, PAIRS // len(at))
                for k in range(0, len(some_asked), rows):
                    q = some_asked[k : k + rows]
                    i, j = np.divmod(np.flatnonzero(np.bitwise_count(own_bits[q, None] ^ bits[None, at]) <= (1 if longer else 2)), len(at))
                    i, j = q[i], at[j]
                    for x in range(0, len(i), max(1, (1 << 22) // length)):
                        y = slice(x, x + max(1, (1 << 22) // length))
                        right = check(written_out[i[y]], spelled[j[y]])
                        yield asked[i[y][right]], places[j[y][right]], longer


def _route(tree: Tree):
    """Each word to its box as a target, and to all boxes in reach as a query."""
    names = ["box", "role", "word", "n"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1)
            points = letters(words)

            def rows(box: np.ndarray, role: int, at: np.ndarray, batch=batch, n=n) -> pa.RecordBatch:
                columns = [pa.array(box.astype(np.int32)), pa.array(np.full(len(at), role, dtype=np.int32)), batch.column(0).take(pa.array(at)), n.take(pa.array(at))]
                return pa.RecordBatch.from_arrays(columns, names)

            yield rows(home(tree, points), 0, np.arange(len(words)))
            boxes, asked = [], []
            for longer in (0, 1):
                for box, some in reached(tree, points, longer, True):
                    boxes.append(np.full(len(some), box, dtype=np.int64))
                    asked.append(some)
            # a box that is in reach for both lengths gets the query once
            both = np.unique(np.stack([np.concatenate(boxes), np.concatenate(asked)]), axis=1)
            yield rows(both[0], 1, both[1])

    return route


def _compare(table: pa.Table) -> pa.Table:
    """Both directions of each pair that is near, found once per pair and direction."""
    role = table.column("role").to_numpy()
    targets, queries = (table.filter(pa.array(role == k)) for k in (0, 1))
    t_words, q_words = (x.column("word").combine_chunks() for x in (targets, queries))
    t_n, q_n = (x.column("n").to_numpy() for x in (targets, queries))
    asked, found, longer = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=bool)]
    for q, t, by in near_pairs(t_words.to_pylist(), q_words.to_pylist()):
        asked.append(q)
        found.append(t)
        longer.append(np.full(len(q), bool(by)))
    q, t, back = (np.concatenate(x) for x in (asked, found, longer))
    # a word only asks for longer ones, so these are told here; within a length each asks for the other
    words = [pa.concat_arrays([a.take(pa.array(x)), b.take(pa.array(y[back]))]) for a, x, b, y in ((q_words, q, t_words, t), (t_words, t, q_words, q))]
    counts = [pa.array(np.concatenate(x)) for x in ((q_n[q], t_n[t[back]]), (t_n[t], q_n[q[back]]))]
    return pa.Table.from_arrays([words[0], counts[0], words[1], counts[1]], ["word", "n", "near", "near_n"])


def pairs(words: DataFrame) -> DataFrame:
    """Columns ``word, n, near, near_n``: all pairs of ``words`` (``word, n``, each word once, not empty) that are one edit apart, both ways.

    Letters are code points below 65,536.
    """
    n = words.count()
    sample = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE).toArrow().column(0).to_pylist()
    boxes = max(1, -(-n // BOX), min(partitions(words.sparkSession), n // 256))
    tree, _ = grow(letters(sample), max(1, -(-len(sample) // boxes)))
    routed = written(words.select("word", "n").mapInArrow(_route(tree), "box int, role int, word string, n long"), "routed")
    # a box holds about BOX words; one that holds many more, as words of the same letters, is dealt into blocks
    size = F.when(F.col("role") == 0, F.lit(4 * BOX)).otherwise(F.lit(QUERIES))
    blocks = routed.groupBy("box", "role").agg(F.ceil(F.count(F.lit(1)) / F.first(size)).alias("blocks"))
    blocks = blocks.groupBy("box").agg(*[F.coalesce(F.max(F.when(F.col("role") == r, F.col("blocks"))), F.lit(1)).cast("int").alias(f"b{r}") for r in (0, 1)])
    dealt = routed.join(blocks, "box")
    own = [F.pmod(F.xxhash64("word"), F.col(f"b{r}")).cast("int") for r in (0, 1)]
    every = [F.sequence(F.lit(0), F.col(f"b{r}") - 1) for r in (0, 1)]
    placed = dealt.withColumn("t", F.explode(F.when(F.col("role") == 0, F.array(own[0])).otherwise(every[0])))
    placed = placed.withColumn("q", F.explode(F.when(F.col("role") == 1, F.array(own[1])).otherwise(every[1])))
    tasks = partitions(words.sparkSession)  # a box is much work for few bytes
    groups = placed.select("box", "t", "q", "role", "word", "n").repartition(tasks, "box", "t", "q").groupBy("box", "t", "q")
    return groups.applyInArrow(_compare, "word string, n long, near string, near_n long")


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """Columns ``word, form, root, n, n_near, form_n``: each word's commonest near word and where such steps lead.

    ``words`` has ``word`` (each once) and ``n``.  A form is the near word of the largest n, ties to the smallest in code-point order,
    if it is at least ``factor`` times as frequent (``factor`` > 1); ``root`` follows forms to the last.
    """
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    near = near.select(F.col("word").alias("w"), "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    all_words = words.join(near, F.col("word") == F.col("w"), "left")
    is_form = F.col("near_n").cast("decimal(38,0)") >= F.col("n").cast("decimal(38,0)") * factor
    all_words = written(
        all_words.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("near")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    # along forms n grows by the factor, so a chain has at most log(max n) steps, and each round doubles the steps taken
    most = words.agg(F.max("n")).first()[0] or 1
    steps, reach = 0, 1
    while reach <= most:
        steps, reach = steps + 1, reach * factor
    roots, taken = all_words.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 1
    while taken < steps:
        further = roots.select(F.col("word").alias("w"), F.col("root").alias("r"))
        ahead = roots.join(further, F.col("root") == F.col("w"), "left")
        roots, taken = written(ahead.select("word", F.coalesce("r", "root").alias("root")), "roots"), 2 * taken
    found = roots.select(F.col("word").alias("w"), "root")
    return all_words.join(found, F.col("word") == F.col("w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 7, occurs: int = 2, deletions: int | None = None, factor: int = 10) -> DataFrame:
    """``variants`` of all words of at least ``least`` letters that occur at least ``occurs`` times in the texts."""
    if least < 1:
        raise ValueError("words have a letter at least")
    counted = occurrences(docs, id_column, text_column, least, deletions).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return variants(counted.where(F.col("n") >= occurs), factor)
