"""Tables with everything that may go wrong: nulls, blanks, repeats, ties, clashing names."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sig long, size long, `a.b` string, target double"

TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "Same words here twice over and over again",
    "Same words here twice over and over again",
    "same  words here\ttwice over and over AGAIN",
    "é ü 日本 \x1c　 x\x0by",
    "token=token: abcdefgh password = 'hunter22hunter22' AKIA" + "Z" * 16 + " " + "0a1b" * 8,
    "x" * 5000 + " " + "long words " * 400,
    "Released under the MIT License.",
]


def rows():
    out = [(k, t, "en", ("b", "a", None, "c")[k % 4], None if t is None else len(t), 1, 2, "x", 0.5) for k, t in enumerate(TEXTS)]
    out.append(out[4])  # a repeated row
    out.append((4, "another text under the same id", "en", "a", 30, 1, 2, "x", 0.5))
    out.append((None, "a row without an id and " * 3, None, None, None, None, None, None, None))
    return out


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


#: Names that the stages use themselves, as a user's columns.
CLASHING = """row mark mark_0 mark_1 again key bad_id bad_mark score held_out x draw sig size least top n_shingles component_id doc_id.x
    found base tokens tests masked has span encoding stratum p start source_size target turn parts part_id part_mark part_source words
    given low high own c0 c1 _text _mark _id _mark_0 _again _masked _has a.b""".split()


def clashing(spark, good):
    """Rows of a table, each with a text of its own under every such name; two rows that are equal but for these."""
    from pyspark.sql import functions as F

    docs = good.select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.withColumn("tag", F.lit("one")).union(docs.withColumn("tag", F.lit("two")).orderBy("doc_id").limit(20))
    value = lambda name: F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(" "), "tag")
    return docs.select("*", *[value(n).alias(n) for n in CLASHING])


def untouched(rows):
    """Whether every such column still holds what it held."""
    return all(r[n] == f"{n} of {'none' if r['doc_id'] is None else r['doc_id']} {r['tag']}" for r in rows for n in CLASHING)
