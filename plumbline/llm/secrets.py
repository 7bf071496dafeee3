"""Secrets in texts: three stated patterns, and tokens that look random.

The patterns' matches are found with their places.  Besides them, runs of letters and digits as encodings
use them are put to a battery of tests against "drawn evenly from the alphabet of its encoding": a chi-squared
test of the alphabet's evenness, a runs test and a serial-correlation test of the letters' values, combined by
Fisher's method.  Words fail it, random keys don't, but short words fail it less surely.  So tokens are judged
within strata of encoding and length: random tokens spread evenly over all p-values, so those with a p-value over one
half tell how many there are; what a limit lets through beyond their share is taken for words, and the
lowest limit is chosen at which that is, within what chance does, at most the allowed share.  Different tokens count, not
how often each occurs; too few of them support no limit but the lowest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import packed, place, quoted, text_of, unpacked, written

# The kinds of secrets and their patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

#: Runs that may be encoded keys, from this length on.
TOKEN_LEAST = 20
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}"
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, the narrowest first: name, the letters it may use, in the order of their values.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"),
    ("hex_upper", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("base36", _DIGITS + _LOWER),
    ("base36_upper", _DIGITS + _UPPER),
    ("base62", _DIGITS + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64_url", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Lengths at which a new stratum begins, allowed share of words, p-values that may be limits.
LENGTHS, ALLOWED, LIMITS = (20, 26, 32, 40, 56, 80), 0.1, tuple(k / 20 for k in range(1, 11))
#: Standard deviations by which the words' share must be over the allowed one for a higher limit.
SURE = 2


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _sums_before(numbers: Column, step: int = 256) -> Column:
    """For each number the sum of those before it, by way of the sums of steps."""

    def over(own: Column) -> Column:
        spots = F.when(F.size(own) > 0, F.sequence(F.lit(0), F.floor((F.size(own) - 1) / step).cast("int"))).otherwise(F.array().cast("array<int>"))
        steps = F.transform(spots, lambda c: _sum(F.slice(own, c * step + 1, F.lit(step))))

        def inside(steps: Column) -> Column:
            bases = F.transform(spots, lambda c: _sum(F.slice(steps, F.lit(1), c)))
            return _let(
                bases,
                lambda b: F.transform(
                    own, lambda _, i: F.get(b, F.floor(i / step).cast("int")) + _sum(F.slice(own, F.floor(i / step).cast("int") * step + 1, i % step))
                ),
            )

        return _let(steps, inside)

    return _let(numbers, over)


_SPANS = "array<struct<start:bigint,kind:int,end:bigint,text:string>>"


def _matches(text: Column, pattern: str, kind: int, holds: Callable[[Column], Column], group: int = 0) -> Column:
    """All matches of a pattern, leftmost first, of which a group holds: what lies between them gives their places."""
    regexp = F.lit(pattern)
    found, tested = F.regexp_extract_all(text, regexp, F.lit(0)), F.regexp_extract_all(text, regexp, F.lit(group))

    def placed(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["own"]))
        lined = F.zip_with(
            pairs,
            _sums_before(lengths.cast("array<bigint>")),
            lambda p, at: F.struct(
                (at + F.length(p["gap"])).cast("long").alias("start"),
                F.lit(kind).alias("kind"),
                (at + F.length(p["gap"]) + F.length(p["own"])).cast("long").alias("end"),
                p["own"].alias("text"),
                p["test"].alias("test"),
            ),
        )
        return F.transform(
            F.filter(lined, lambda s: holds(s["test"])), lambda s: F.struct(s["start"], s["kind"], s["end"], s["text"])
        )

    named = F.zip_with(found, tested, lambda own, test: F.struct(own.alias("own"), test.alias("test")))
    both = F.zip_with(named, F.split(text, pattern, -1), lambda m, gap: F.struct(m["own"].alias("own"), m["test"].alias("test"), gap.alias("gap")))
    pairs = F.filter(both, lambda p: p["own"].isNotNull())  # the last gap has no match after it
    return F.when(text.rlike(pattern), _let(pairs, placed)).otherwise(F.array()).cast(_SPANS)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a rational approximation good to seven places."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = poly * F.exp(-x * x / 2) / (2 * 3.141592653589793) ** 0.5
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _encoding(token: Column) -> Column:
    """Number of the narrowest encoding; null if none fits, or the token lacks a letter or a digit."""
    out = F.when(~token.rlike("[0-9]") | ~token.rlike("[A-Za-z]"), F.lit(None))
    for k, (_, letters) in enumerate(ENCODINGS):
        out = out.when(token.rlike("^[" + letters.replace("-", r"\-") + "]+=*$"), F.lit(k))
    return out.cast("int")


def battery(token: Column, encoding: Column) -> Column:
    """Combined p-value of the tests of a token against even draws from its encoding's letters."""
    letters = F.element_at(F.array(*[F.lit(x) for _, x in ENCODINGS]), encoding + 1)
    bare = F.rtrim(token, F.lit("="))

    def tested(v: Column) -> Column:
        n = F.size(v).cast("double")
        k = F.length(letters).cast("double")
        squares = F.aggregate(F.array_distinct(v), F.lit(0.0), lambda a, x: a + F.pow(F.size(F.filter(v, lambda y: y == x)), F.lit(2.0)))
        chi = (k / n * squares - n) / (k - 1)
        uneven = _tail((F.pow(F.greatest(chi, F.lit(0.0)), F.lit(1 / 3)) - (1 - 2 / (9 * (k - 1)))) / F.sqrt(2 / (9 * (k - 1))))
        pairs = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        turns = F.size(F.filter(pairs, lambda p: (p["a"] < k / 2) != (p["b"] < k / 2)))
        runs = 2 * _tail(F.abs((turns - (n - 1) / 2) / F.sqrt((n - 1) / 4)))
        lag = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - (k - 1) / 2) * (p["b"] - (k - 1) / 2))
        serial = 2 * _tail(F.abs(lag / ((k * k - 1) / 12 * F.sqrt(n - 1))))
        half = -sum(F.log(F.greatest(p, F.lit(1e-300))) for p in (uneven, runs, serial))
        return _let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))

    values = F.transform(F.split(bare, ""), lambda c: F.instr(letters, c) - 1)
    return _let(values, tested)


def limits(tests: DataFrame, allowed: float = ALLOWED) -> dict[tuple[int, int], float]:
    """The lowest p-value that counts as random, by (encoding, stratum of length), from columns ``encoding, stratum, p, token``.

    One row per stratum and twentieth of the p-values reaches the driver: a few hundred at most.
    """
    step = F.least(F.floor(F.col("p") * 20), F.lit(19)).alias("step")
    counted = tests.dropDuplicates(["encoding", "stratum", "token"]).groupBy("encoding", "stratum", step).count().collect()
    found: dict[tuple[int, int], list[int]] = {}
    for row in counted:
        found.setdefault((row["encoding"], row["stratum"]), [0] * 20)[row["step"]] += row["count"]
    out = {}
    for stratum, steps in found.items():
        high = sum(steps[10:])
        for limit in LIMITS:
            low = sum(steps[round(limit * 20) : 10])
            # of low + high tokens over the limit, 2 * high * (1 - limit) are random
            of_low, of_high = 1 - allowed, 1 - 2 * limit + allowed
            if of_low * low - of_high * high <= SURE * (of_low**2 * low + of_high**2 * high) ** 0.5:
                out[stratum] = limit
                break
        else:
            out[stratum] = LIMITS[-1]
    return out


def _stratum(length: Column) -> Column:
    return sum((F.when(length >= least, 1).otherwise(0) for least in LENGTHS[1:]), F.lit(0))


def secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``doc_id``, the columns ``carried``, and ``found``, the spans of secrets by beginning and kind.

    A span is ``start, kind, end, text``: places in code points, end exclusive, and kind a number in
    ``KINDS``.  A null text is an empty one.  Rows stand by themselves, so repeated and null ids
    are no matter; but which tokens count as random depends on all texts.
    """
    text = text_of(text_column)
    rows = docs.select(quoted(id_column).alias("doc_id"), *[quoted(c).alias(c) for c in carried], text.alias("_text"))
    # a run of the class that is long enough, from where it begins, is the same as any run, short ones dropped
    base = F.concat(
        _matches(F.col("_text"), ASSIGN, 0, lambda v: F.length(v) >= ASSIGN_LEAST, 2),
        _matches(F.col("_text"), ACCESS, 1, lambda v: F.length(v) >= ACCESS_LEAST),
        _matches(F.col("_text"), f"(?<!{HEX[:-1]}){HEX[:-1]}{{{HEX_LEAST},}}+", 2, lambda v: F.length(v) >= HEX_LEAST),
    )
    tokens = _matches(F.col("_text"), TOKEN % TOKEN_LEAST, 3, lambda v: _encoding(v).isNotNull())
    spans = rows.select("doc_id", *map(quoted, carried), F.array_sort(base).alias("base"), tokens.alias("tokens"))

    clear = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    scored = F.transform(
        clear,
        lambda t: F.struct(t.alias("span"), _encoding(t["text"]).alias("encoding"), _stratum(F.length(t["text"])).alias("stratum"), battery(t["text"], _encoding(t["text"])).alias("p")),
    )
    # tokens are tested once, in the pass that finds them: the limits and the judging read their p-values
    tests = F.when(F.size("tokens") > 0, scored).alias("tests")
    judged = written(spans.select("doc_id", *map(quoted, carried), "base", tests), "spans")
    chosen = limits(judged.select(F.explode("tests").alias("t")).select("t.encoding", "t.stratum", "t.p", F.col("t.span.text").alias("token")))
    random = F.transform(F.filter(F.coalesce("tests", F.array().cast(judged.schema["tests"].dataType)), lambda t: _passes(t, chosen)), lambda t: t["span"])
    return judged.select("doc_id", *map(quoted, carried), "base", F.array_sort(F.concat(F.col("base"), random.cast(_SPANS))).alias("found"))


def _passes(test: Column, chosen: dict[tuple[int, int], float]) -> Column:
    out = F.lit(False)
    for (encoding, stratum), limit in sorted(chosen.items()):
        out = F.when((test["encoding"] == encoding) & (test["stratum"] == stratum), test["p"] >= limit).otherwise(out)
    return out


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Columns ``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` per document."""
    found = secrets(docs)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(3)]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


MASK = "[secret]"


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced by a mask, and ``n_chars`` to match.

    Spans that overlap or touch become one mask.  Texts without secrets stay as they are, null ones too.
    """
    rows = docs.select(quoted("doc_id").alias("doc_id"), quoted("text").cast("string").alias("text"), *packed(docs))
    found = secrets(rows, carried=tuple(rows.columns[2:]))
    text = F.col(place(docs, "text")).cast("string")
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        apart = (span["start"] > state["end"]) | ((span["start"] == 0) & (state["out"] == ""))
        gap = F.substring(text, (state["end"] + 1).cast("int"), (span["start"] - state["end"]).cast("int"))
        out = F.when(apart, F.concat(state["out"], gap, F.lit(MASK))).otherwise(state["out"])
        return F.struct(F.greatest(state["end"], span["end"]).alias("end"), out.alias("out"))

    masked = F.aggregate("found", start, step, lambda s: F.concat(s["out"], F.substring(text, (s["end"] + 1).cast("int"), F.length(text))))
    has = F.size("found") > 0
    found = found.withColumn("masked", F.when(has, masked).otherwise(text)).withColumn("has", has)
    new = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("has"), F.length("masked").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(place(docs, "n_chars")))
    return found.select(*unpacked(docs, new))
