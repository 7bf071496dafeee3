"""I-Match fingerprints: hashes of a document's terms within a band of document frequency.

Terms that occur in too many or too few documents say little about a document or don't survive an
edit; the lexicon is what lies between.  Near copies together weigh about as much as one document when a term is judged too common, so that a
large group of them doesn't lift its own terms out of the lexicon.  Its size has a bound that doesn't grow with the number of
documents: the terms with a document frequency of at least a share s are at most 1/s times the mean number of
distinct terms of a document.  Each of several randomised lexicons keeps a part of it, some large parts, some small:
a document's terms in it, sorted, give one hash.  Small parts survive edits of long documents, large ones tell
short documents apart.  Two fingerprints are as alike as the share of their hashes that agree, of those that either has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import SPACE, partitions, quoted, text_of, written
from plumbline.operators.ranking import number_rows

#: The band: least and most share of all documents that a term occurs in, and documents it must occur in at least.
LEAST, MOST, SEEN = 0.002, 0.02, 2
#: Parts of the lexicon that the randomised lexicons keep: one in so many terms, by lexicon.
PARTS = (16,) * 8 + (64,) * 20 + (256,) * 20
#: Words of a hashed run, least hashes of runs that make a text's sketch, and how many of them a group of near copies shares at least.
RUN, SKETCH, COMMON = 3, 8, 3
_UNIT = 1 << 30  # weight of a text without near copies
_FIRST = -(2**63)  # stands for a null id


def terms(text: Column) -> Column:
    """Distinct words in lower case."""
    return F.array_distinct(F.split(F.lower(text), f"[{SPACE}]+"))


def sketch(text: Column) -> Column:
    """The least few hashes of a text's runs of words: near copies have most of them in common."""

    def hashes(words: Column) -> Column:
        return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, RUN)]))

    words = F.filter(F.split(F.lower(text), f"[{SPACE}]+"), lambda w: w != "")
    return F.slice(F.sort_array(F.array_distinct(_once(words, hashes))), 1, SKETCH)


def weighed(texts: DataFrame, n: int, least: float = LEAST) -> DataFrame:
    """Columns ``text, weight``: a whole weight shared by a group of near copies.

    A group's size is the number of texts that have a text's third commonest sketch hash; hashes of fewer texts than half the
    band's least share make no group, which bounds those that are broadcast: the length of a sketch over that share.
    """
    drawn = texts.select("text", sketch(F.col("text")).alias("sketch"))
    counted = drawn.select(F.explode("sketch").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("size"))
    groups = written(counted.where(F.col("size") >= max(2, least / 2 * n)), "groups")
    rows = drawn.select("text", *[F.get("sketch", F.lit(k)).alias(f"hash_{k}") for k in range(SKETCH)])
    for k in range(SKETCH):
        rows = rows.join(F.broadcast(groups.select(F.col("hash").alias(f"hash_{k}"), F.col("size").alias(f"size_{k}"))), f"hash_{k}", "left")
    # a text of fewer runs has them all in common with its near copies
    has = sum((F.col(f"hash_{k}").isNotNull().cast("int") for k in range(SKETCH)), F.lit(0))
    sizes = F.sort_array(F.array(*[F.coalesce(F.col(f"size_{k}"), F.lit(1).cast("long")) for k in range(SKETCH)]), asc=False)
    size = F.get(sizes, F.greatest(F.least(has, F.lit(COMMON)), F.lit(1)) - 1)
    return rows.select("text", F.floor(F.lit(_UNIT) / size).cast("long").alias("weight"))


def lexicon(texts: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """Columns ``term, df, kept``: the terms in the band; bit k of ``kept`` is set if randomised lexicon k has the term.

    The least share is of all texts, the most of their weights.
    """
    n = texts.count()
    rows = weighed(texts, n, least)
    # an outer explode, as the plain one would work out the terms twice, to leave out texts without any
    counted = rows.select("weight", F.explode_outer(F.array_union(terms(F.col("text")), F.array(F.lit("")))).alias("term"))
    counted = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("weight").alias("weight"))
    # every text has the empty term once, which sums all weights
    counted = written(counted.where((F.col("df") >= max(SEEN, least * n)) | (F.col("term") == "")), "counted")
    whole = counted.where("term = ''").agg(F.max("weight")).first()[0] or 0
    band = counted.where((F.col("term") != "") & (F.col("weight") <= most * whole))
    bits = [F.when(F.pmod(F.xxhash64(F.lit(k), "term"), F.lit(part)) == 0, 1 << k).otherwise(0) for k, part in enumerate(PARTS)]
    return written(band.select("term", "df", sum(bits[1:], bits[0]).cast("long").alias("kept")).where("kept <> 0"), "lexicon")


def _hashes(found: Column, whole: Column) -> Column:
    """One hash for each randomised lexicon: of the sorted terms that it keeps; null if there are none.

    ``found`` has a text's terms, each with the numbers of the lexicons that keep it.  Lined up by lexicon and term, they
    are gone through once, not once for each lexicon.  A text without any term of the lexicon stands for itself: each
    hash is that of the whole text.
    """

    slots = F.array(*[F.lit(k) for k in range(len(PARTS))])
    lined = F.sort_array(F.flatten(F.transform(found, lambda t: F.transform(t["slots"], lambda k: F.struct(k.alias("slot"), t["term"].alias("term"))))))

    def each(own: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(1), F.size(own)), lambda i: (i == 1) | (F.get(own, i - 1)["slot"] != F.get(own, i - 2)["slot"]))

        def parts(begins: Column) -> Column:
            def one(begin: Column, k: Column) -> Column:
                end = F.coalesce(F.get(begins, k + 1), F.size(own) + 1)
                joined = F.array_join(F.transform(F.slice(own, begin, end - begin), lambda t: t["term"]), " ")
                return F.struct(F.get(own, begin - 1)["slot"], F.xxhash64(joined))

            return F.map_from_entries(F.transform(begins, one))

        known = _once(begins, parts)
        return F.when(F.size(own) > 0, _once(known, lambda m: F.transform(slots, lambda k: F.element_at(m, k)))).otherwise(F.transform(slots, lambda _: whole))

    return _once(lined, each)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, not wherever it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fingerprints(texts: DataFrame, keys: list[str], text_columns: list[str], words: DataFrame) -> DataFrame:
    """The rows' ``keys``, which tell rows apart, and for text column k an array of hashes ``print_<k>``.

    The lexicon is broadcast: its size has a bound (see above).  If the rows are dealt out by some of ``keys``
    already, nothing is shuffled.  Null texts are empty.
    """
    each = F.array(*[F.struct(F.lit(k).alias("which"), terms(text_of(c)).alias("terms")) for k, c in enumerate(text_columns)])
    wholes = [f"whole_{k}" for k in range(len(text_columns))]
    rows = texts.select(*keys, *[F.xxhash64(text_of(c)).alias(w) for c, w in zip(text_columns, wholes, strict=True)], each.alias("each"))
    rows = rows.select(*keys, *wholes, F.explode_outer("each").alias("own"))
    # apart, so that the terms themselves don't go along with each of them
    rows = rows.select(*keys, *wholes, F.col("own.which").alias("which"), F.col("own.terms").alias("terms"))
    # the empty term keeps texts without any other in the result; no lexicon keeps it
    rows = rows.select(*keys, *wholes, "which", F.explode_outer(F.concat("terms", F.array(F.lit("")))).alias("term"))
    rows = rows.select(*keys, *wholes, "which", F.xxhash64("term").alias("code"))
    known = words.select("term", "kept").union(texts.sparkSession.createDataFrame([("", 0)], "term string, kept long"))
    slots = F.filter(F.array(*[F.lit(k) for k in range(len(PARTS))]), lambda k: F.getbit("kept", k) == 1)
    known = known.select("term", slots.alias("slots"))
    found = rows.join(F.broadcast(known.withColumn("code", F.xxhash64("term"))), "code").groupBy(*keys, *wholes)
    lists = [F.collect_list(F.when((F.col("which") == k) & (F.size("slots") > 0), F.struct("term", "slots"))).alias(f"list_{k}") for k in range(len(wholes))]
    found = found.agg(*lists)
    return found.select(*keys, *[_hashes(F.col(f"list_{k}"), F.col(w)).alias(f"print_{k}") for k, w in enumerate(wholes)])


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes that agree, of those that either has."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    either = F.size(F.filter(pairs, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
    same = F.size(F.filter(pairs, lambda p: p["x"] == p["y"]))
    return (same / F.greatest(either, F.lit(1))).cast("double")


def shown(hashes: Column) -> Column:
    """A fingerprint as text: 16 hex digits for each hash, a dash for none."""
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit("-"))), ".")


def numbered(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns ``key, text, copy``: ids, null ones as the smallest; ``copy`` numbers the rows that share one, by text.

    Texts are dealt out by id here, once for all that is done with them.
    """
    key = F.coalesce(quoted(id_column).cast("long"), F.lit(_FIRST))
    texts = docs.select(key.alias("key"), text_of(text_column).alias("text")).repartition(partitions(docs.sparkSession), "key")
    return texts.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy("text")))


def neighbours(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns ``key, next, half``: each id with the next smaller one (after the smallest: the largest) and half the length of its longest text."""
    key = F.coalesce(quoted(id_column).cast("long"), F.lit(_FIRST))
    ids = docs.select(key.alias("key"), F.length(text_of(text_column)).alias("n")).groupBy("key").agg(F.max("n").alias("n"))
    placed = written(number_rows(ids, [F.col("key").desc()], "at"), "ids")
    n = placed.count()
    after = placed.select(F.pmod(F.col("at") - 1, F.lit(max(n, 1))).alias("at"), F.col("key").alias("next"))
    return written(placed.join(after, "at").select("key", "next", F.floor(F.col("n") / 2).cast("int").alias("half")), "next")


def edited(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Columns ``key, copy, next, text, edited, n_chars``: every text, and with its second half from the next document.

    The next document is the one with the next smaller id.  Rows that share an id are all followed by the least text of
    the next smaller id.
    """
    # only what a text needs of the next one is sent to it
    heads = texts.where("copy = 1").select(F.col("key").alias("next"), "text")
    heads = heads.join(pairs, "next").select(F.col("key").alias("to"), "next", F.substring("text", F.lit(1), F.col("half")).alias("head"))
    half = F.floor(F.length("text") / 2).cast("int")
    mixed = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("head", F.lit(1), half))
    return texts.join(heads, F.col("key") == F.col("to")).select(
        "key", "copy", "next", "text", mixed.alias("edited"), F.length("text").cast("long").alias("n_chars")
    )


def compared(docs: DataFrame) -> DataFrame:
    """Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Null texts are empty.  Repeated rows, and rows that share an id, are compared each for itself.
    """
    words = lexicon(docs.select(text_of("text").alias("text")))
    texts, pairs = numbered(docs), neighbours(docs)
    both = edited(texts, pairs).withColumn("edited_sha256", F.sha2("edited", 256))
    rows = written(fingerprints(both, ["key", "copy", "next", "n_chars", "edited_sha256"], ["text", "edited"], words), "prints")
    of_next = rows.where("copy = 1").select(F.col("key").alias("next"), F.col("print_0").alias("print_next"))
    return rows.join(of_next, "next").select(
        F.when(F.col("key") != _FIRST, F.col("key")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        shown(F.col("print_0")).alias("fingerprint"),
        shown(F.col("print_1")).alias("edited_fingerprint"),
        likeness(F.col("print_0"), F.col("print_1")).alias("near_edited"),
        likeness(F.col("print_0"), F.col("print_next")).alias("near_next"),
    )
