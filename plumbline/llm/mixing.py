"""Mixing sources to target weights.

1. Each source's documents, in a fixed order, are packed into blocks of equally many words (the last
   holds the rest).  Where a document begins follows from running sums: over buckets of a source's
   documents, and within a bucket, so that no task orders a whole source.
2. The mix has as many slots as the targets need blocks, dealt into output shards of equal length.
   Each shard draws its sources' counts from the multinomial distribution of the targets.  What a source
   drew over its share of the slots goes to sources that drew less, so that totals meet the targets.
3. A source's slots, in the order of shards, are mapped through pseudorandom permutations of
   its blocks, one per pass over the source; slots and blocks meet in a join by index.

Draws are hashes of a seed, a shard and a slot, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import SPACE, content, packed, partitions, place, quoted, text_of, unpacked, written

#: Words of a block, slots of an output shard, documents whose order one task finds, times a source may be repeated.
BLOCK, SHARD, BUCKET, REPEATS = 32, 16_384, 20_000, 3
_ROUNDS = 16


def word_count(text: Column) -> Column:
    """Number of words: each, with the white space around it, becomes one letter."""
    marks = F.regexp_replace(text, f"[{SPACE}]*[^{SPACE}]+[{SPACE}]*", "w")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long")


def sized(docs: DataFrame, id_column: str, text_column: str, source_column: str, mark_column: str | None = None) -> DataFrame:
    """Columns ``doc_id, source, size, mark``: ``mark`` tells texts of one id apart."""
    text = text_of(text_column)
    return docs.select(
        quoted(id_column).alias("doc_id"),
        quoted(source_column).alias("source"),
        word_count(text).alias("size"),
        (F.xxhash64(text) if mark_column is None else quoted(mark_column)).alias("mark"),
    )


def targets(sizes: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Columns ``source, source_size, weight, target`` from one row per source with its ``source_size``.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share all words; a target stops at
    ``repeats`` times its source, and what is over goes to the others by weight.  As weights among the others
    never change, they all get one rate: the one that is left when all sources with a smaller
    limit per weight have stopped.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    ranked = ranked.withColumn("limit", repeats * F.col("source_size") / F.col("weight"))
    stopped = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    total, weights = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    ranked = ranked.withColumn(
        "rate",
        (total - repeats * F.coalesce(F.sum("source_size").over(stopped), F.lit(0)))
        / (weights - F.coalesce(F.sum("weight").over(stopped), F.lit(0.0))),
    )
    # the rate with the first k stopped holds once it is below the limit of the next; stopping more lowers it
    ranked = ranked.withColumn("rate", F.max(F.when(F.col("rate") <= F.col("limit"), F.col("rate"))).over(everything))
    target = F.least(repeats * F.col("source_size").cast("double"), F.col("rate") * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def _placed(rows: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their beginning in their source, and (source, bucket) totals with the sources' targets."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(buckets)).cast("int"))
    totals = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "totals")
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows, offsets


def _permuted(x: Column, n: Column, key: Column) -> Column:
    """A permutation of 0..n-1: rounds that swap pairs of places, or not, as a hash says."""

    def step(at: Column, k: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, k), n) - at + n, n)
        swap = F.xxhash64(key, k, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.array(*[F.lit(k) for k in range(_ROUNDS)]), x, step)


def shard_counts(plan: DataFrame, slots: int, shard: int, seed: int) -> DataFrame:
    """Columns ``shard, source, drawn``: each shard's multinomial draw.

    ``plan`` has ``low, high``: the source's share of 0..slots-1.  A slot draws a number; cells of
    equal width lead to the sources that reach into them, so a large source is spread over many.
    """
    spark = plan.sparkSession
    width = max(1, slots // max(1, 4 * plan.count()))
    cells = plan.where("high > low").select(
        "source", "low", "high", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")).alias("cell")
    )
    draws = spark.range(slots).select(
        F.expr(f"id div {shard}").alias("shard"), F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(slots)).alias("at")
    )
    draws = draws.withColumn("cell", F.expr(f"at div {width}"))
    hit = draws.join(cells, "cell").where("at >= low AND at < high")
    return hit.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("drawn"))


def _slots(plan: DataFrame, slots: int, shard: int, seed: int) -> DataFrame:
    """Columns ``shard, source, blocks, at``: the source of each slot, and the slot's number within the source."""
    counts = written(shard_counts(plan, slots, shard, seed), "counts")
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("drawn").over(before), F.lit(0)))
    name = plan["source"].eqNullSafe(counts["source"])
    counts = counts.join(plan, name).select("shard", counts["source"], "blocks", "first", "drawn", (F.col("high") - F.col("low")).alias("due"))
    # few rows that stand for many slots: dealt out anew before they are spread
    dealt = counts.repartition(partitions(plan.sparkSession), "shard", "source")
    own = dealt.where("first < due AND drawn > 0").select(
        "shard", "source", "blocks", F.explode(F.expr("sequence(first, least(first + drawn, due) - 1)")).alias("at")
    )
    over = counts.where("first + drawn > due").select(
        "shard", "source", F.explode(F.expr("sequence(greatest(first, due) - due, first + drawn - 1 - due)")).alias("extra")
    )
    drawn = counts.groupBy("source").agg(F.sum("drawn").alias("drawn"))
    state = plan.join(drawn.withColumnRenamed("source", "s"), plan["source"].eqNullSafe(F.col("s")), "left").select(
        "source", "blocks", (F.col("high") - F.col("low")).alias("due"), F.coalesce("drawn", F.lit(0)).alias("drawn")
    )
    earlier = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    over_from = F.coalesce(F.sum(F.greatest(F.col("drawn") - F.col("due"), F.lit(0))).over(earlier), F.lit(0))
    under_from = F.coalesce(F.sum(F.greatest(F.col("due") - F.col("drawn"), F.lit(0))).over(earlier), F.lit(0))
    state = written(state.withColumn("over_from", over_from).withColumn("under_from", under_from), "state")
    numbered = over.join(state.select(F.col("source").alias("s"), "over_from"), F.col("source").eqNullSafe(F.col("s"))).select(
        "shard", (F.col("extra") + F.col("over_from")).alias("k")
    )
    gaps = state.where("due > drawn").select("source", "blocks", "under_from", "drawn", F.explode(F.expr("sequence(drawn, due - 1)")).alias("at"))
    gaps = gaps.select("source", "blocks", "at", (F.col("at") - F.col("drawn") + F.col("under_from")).alias("k"))
    return own.union(numbered.join(gaps, "k").select("shard", "source", "blocks", "at"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 1,
    block: int = BLOCK,
    shard: int = SHARD,
    bucket: int = BUCKET,
    repeats: int = REPEATS,
    mark_column: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The mix, and each document with its source's target.

    The mix has a row for each part of a document in each slot: ``shard, source, at`` (the slot's number
    within its source), ``turn`` (the pass over the source), ``block``, ``doc_id, mark, start`` (where the document
    begins in its source, which tells rows apart), ``size``, ``low, high`` (the part's words of the document, from 0, end exclusive).
    The documents have ``doc_id, source, size, mark, start, source_size, target``.

    Null texts have no words and null sources are a source.  Documents without words stay in the second table and
    are in no slot.  Repeated rows count as often as they occur.  An empty table has an empty mix.
    """
    rows = written(sized(docs, id_column, text_column, source_column, mark_column), "sized")
    buckets = max(1, -(-rows.count() // bucket))
    rows, offsets = _placed(rows, buckets)
    sources = offsets.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(sources, repeats)
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    plan = plan.withColumn("blocks", blocks)
    due = F.when(F.col("blocks") > 0, F.least(repeats * F.col("blocks"), F.round(F.col("target") * F.col("blocks") / F.col("source_size")))).otherwise(0)
    plan = plan.withColumn("due", due.cast("long"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    plan = plan.withColumn("high", F.sum("due").over(by_name)).withColumn("low", F.col("high") - F.col("due"))
    plan = written(plan, "plan")
    slots = plan.agg(F.max("high")).first()[0] or 0

    named = offsets.join(plan.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    named = written(named.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "offset", "source_size", "target"), "named")
    placed = rows.join(named, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    placed = placed.select("doc_id", "source", "size", "mark", (F.col("offset") + F.col("inner")).alias("start"), "source_size", "target")
    placed = written(placed, "placed")

    parts = placed.where("size > 0").select(
        "source", "doc_id", "mark", "start", "size", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block")
    )
    parts = parts.select(
        F.xxhash64("source", "block").alias("cell"),
        "source",
        "block",
        "doc_id",
        "mark",
        "start",
        "size",
        F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).alias("low"),
        F.least((F.col("block") + 1) * block - F.col("start"), F.col("size")).alias("high"),
    )
    drawn = _slots(plan.select("source", "blocks", "low", "high"), slots, shard, seed)
    turn = F.expr("at div blocks")
    drawn = drawn.select("shard", F.col("source").alias("s"), "at", turn.alias("turn"), _permuted(F.expr("at % blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), "source", turn)).alias("b"))
    drawn = drawn.withColumn("cell", F.xxhash64("s", "b"))
    same = (parts["cell"] == drawn["cell"]) & parts["source"].eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
    mixed = drawn.join(parts, same).select("shard", "source", "at", "turn", "block", "doc_id", "mark", "start", "size", "low", "high")
    return mixed, placed


def taken(mixed: DataFrame, placed: DataFrame) -> DataFrame:
    """Columns ``doc_id, size, source_size, target, taken`` per document: the words that the mix takes of it."""
    words = mixed.groupBy("source", "start").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    words = words.select(F.xxhash64("source", "start").alias("cell"), F.col("source").alias("s"), F.col("start").alias("at"), "taken")
    # a document without words begins where the next does; it takes nothing
    own = placed.withColumn("cell", F.when(F.col("size") > 0, F.xxhash64("source", "start")))
    same = (own["cell"] == words["cell"]) & F.col("source").eqNullSafe(F.col("s")) & (F.col("start") == F.col("at"))
    return own.join(words, same, "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The mix as documents: each row of ``docs`` once for every pass that takes words of it.

    A pass that takes all of a text gives it as it is; one that takes some gives these words, in order,
    joined by blanks, with ``n_chars`` to match.  Documents without words are in no mix.  Rows are told apart by
    64 bits of a hash of all their columns (but maps), so those that share an id or a text keep their other columns.
    """
    mark = F.xxhash64(content(docs)).alias("mark")
    mixed, _ = mix(docs.select(*[quoted(c).alias(c) for c in ("doc_id", "text", "source")], mark), seed=seed, mark_column="mark")
    own = docs.select(*[quoted(c).alias(c) for c in ("doc_id", "source")], *packed(docs), mark)
    text = F.col(place(docs, "text"))
    parts = mixed.groupBy("doc_id", "mark", "source", "start", "turn").agg(
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("parts"),
        F.sum(F.col("high") - F.col("low")).alias("words"),
        F.first("size").alias("size"),
    )
    parts = parts.select(F.col("doc_id").alias("part_id"), F.col("mark").alias("part_mark"), F.col("source").alias("part_source"), "parts", "words", "size")
    own = own.dropDuplicates(["doc_id", "mark", "source"])  # full copies; each has its own parts
    same = F.col("doc_id").eqNullSafe(F.col("part_id")) & (F.col("mark") == F.col("part_mark")) & F.col("source").eqNullSafe(F.col("part_source"))
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")

    def cut(own: Column) -> Column:
        return F.concat_ws(" ", F.flatten(F.transform("parts", lambda p: F.slice(own, (p["low"] + 1).cast("int"), (p["high"] - p["low"]).cast("int")))))

    some = F.element_at(F.transform(F.array(words), cut), 1)  # words are found once, not once for each part
    whole = F.col("words") == F.col("size")
    rows = own.join(parts, same).withColumn("given", F.when(whole, text).otherwise(some))
    new = {"text": F.col("given")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(whole, F.col(place(docs, "n_chars"))).otherwise(F.length("given").cast(docs.schema["n_chars"].dataType))
    return rows.select(*unpacked(docs, new))
