"""URL filter: rules by host and path, and a character language-model ratio where no rule fits.

URLs that rules accept and reject train two Markov models over characters.  A character is
predicted from up to four before it: the counts after the longest context are blended with the
prediction from the next shorter one, by as much as the context has been followed by different
characters (Witten-Bell), down to even chances.  A URL's score is the mean over its characters
of the log ratio of both models' predictions, so long and short URLs compare; the limit between accepting and
rejecting is calibrated on ruled URLs that the models haven't seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, written

#: Characters of the longest context; one in HELD ruled URLs calibrates the limit.
ORDER, HELD = 4, 5
_BEGIN, _END = "\x02", "\x03"
_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


# The rules of the filter.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_and_rest(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and what follows it; both empty for a URL that is null or without ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.regexp_replace(url, r"^(?s).*?://", "")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, _A_TO_Z, _A_TO_Z.lower()), F.regexp_replace(rest, "^[^/?#]*", "")


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, "^[^?#]*", 0)


def rule_for(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule whose host is the host or above it, and whose path begins the path; else null."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, value(rule)) if out is None else out.when(fits, value(rule))
    return out.otherwise(F.lit(None)) if out is not None else F.lit(None).cast("string")


def grams(text: Column, order: int) -> Column:
    """Each character of a text, and its end, with the ``order`` characters before it."""
    letters = F.split(F.concat(F.lit(_BEGIN * order), text, F.lit(_END)), "")
    cut = lambda own: F.transform(F.sequence(F.lit(1), F.size(own) - order), lambda i: F.array_join(F.slice(own, i, F.lit(order + 1)), ""))
    return F.element_at(F.transform(F.array(letters), cut), 1)


def log_ratios(examples: DataFrame, order: int = ORDER) -> DataFrame:
    """Columns ``gram, ratio``: log of the accepted model's prediction over the rejected model's, for every gram there is.

    ``examples`` has ``gram`` and the numbers ``good`` and ``bad`` of its rows in either set, both 0 for grams
    that are only to be scored.
    """
    counts = written(examples.groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "grams")
    lower = None
    for level in range(order + 1):
        own = counts.select(F.expr(f"right(gram, {level + 1})").alias("gram"), "good", "bad")
        own = own.groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        own = own.withColumn("context", F.expr(f"left(gram, {level})")).withColumn("shorter", F.expr(f"right(gram, {level})"))
        if lower is None:
            chance = 1.0 / max(1, own.count())
            own = own.withColumn("p_good", F.lit(chance)).withColumn("p_bad", F.lit(chance))
        else:
            below = lower.select(F.col("gram").alias("shorter"), "p_good", "p_bad")
            own = own.join(below, "shorter")
        after = Window.partitionBy("context")
        blended = {}
        for side in ("good", "bad"):
            kinds = F.sum((F.col(side) > 0).cast("long")).over(after)
            total = F.sum(side).over(after) + kinds
            blended[f"p_{side}"] = F.when(total > 0, (F.col(side) + kinds * F.col(f"p_{side}")) / total).otherwise(F.col(f"p_{side}"))
        lower = own.select("gram", "good", "bad", *[v.alias(k) for k, v in blended.items()])
    return written(lower.select("gram", F.log(F.col("p_good") / F.col("p_bad")).alias("ratio")), "ratios")


def limit(scored: DataFrame) -> float:
    """The score that best parts held-out URLs, both sets weighing the same; 0 if one of them is empty.

    Scores are counted in steps of a hundredth between -20 and 20, so a few thousand rows reach the driver.
    """
    step = F.greatest(F.lit(-2000), F.least(F.lit(2000), F.floor(F.col("score") * 100))).cast("int")
    steps = scored.groupBy(step.alias("step")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
    good, bad = sum(r.good for r in steps), sum(r.bad for r in steps)
    if not good or not bad:
        return 0.0
    best, at, below_good, below_bad = -1.0, 0.0, 0, 0
    lined = sorted(steps, key=lambda r: r.step)
    for k, row in enumerate(lined):
        value = (good - below_good) / good + below_bad / bad
        if value > best + 1e-12:
            # half way to the step before
            best, at = value, (row.step + (lined[k - 1].step + 1 if k else row.step)) / 200
        below_good, below_bad = below_good + row.good, below_bad + row.bad
    if below_bad / bad > best:
        at = (lined[-1].step + 1) / 100
    return at


def judge(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", rules: Sequence[Rule] = RULES, order: int = ORDER, held: int = HELD) -> DataFrame:
    """Columns ``page_id, host, path, rule, verdict, score`` per row: the longest rule's verdict, else the models'.

    Null URLs and URLs without ``://`` have an empty host and path; the models still judge the text they have.
    Repeated rows get the same verdict, and null ids are no matter.  Without rejected or without
    accepted URLs all that no rule fits scores 0 at a limit of 0, and is accepted.
    """
    url = quoted(url_column).cast("string")
    host, rest = host_and_rest(url)
    rows = pages.select(quoted(id_column).alias("page_id"), host.alias("host"), rest.alias("rest"), F.coalesce(url, F.lit("")).alias("url"))
    rows = rows.withColumn("path", path_of(F.col("rest")))
    name = rule_for(F.col("host"), F.col("path"), rules, lambda r: F.lit(r.host + r.path))
    says = rule_for(F.col("host"), F.col("path"), rules, lambda r: F.lit(r.verdict))
    text = F.when((F.col("host") != "") | (F.col("rest") != ""), F.concat("host", "rest")).otherwise(F.col("url"))
    rows = rows.select("page_id", "host", "path", name.alias("rule"), says.alias("says"), text.alias("text")).withColumn("key", F.xxhash64("text"))

    shown = F.pmod(F.xxhash64(F.lit("held"), "text"), F.lit(held)) != 0
    one = lambda verdict: (shown & F.coalesce(F.col("says") == verdict, F.lit(False))).cast("long")
    examples = rows.select(F.explode(grams(F.col("text"), order)).alias("gram"), one("allow").alias("good"), one("block").alias("bad"))
    model = log_ratios(examples, order)
    texts = rows.select("key", "text").dropDuplicates(["key"])
    scores = texts.select("key", F.explode(grams(F.col("text"), order)).alias("gram")).join(model, "gram").groupBy("key").agg(F.avg("ratio").alias("score"))
    scores = written(scores, "scores")
    scored = written(rows.join(scores, "key"), "scored")
    trained = scored.agg(*[F.coalesce(F.max(one(v)), F.lit(0)).alias(v) for v in ("allow", "block")]).first()
    both = bool(trained.allow and trained.block)
    unseen = scored.where(~shown & F.col("says").isNotNull())
    unseen = unseen.select("score", (F.col("says") == "allow").cast("long").alias("good"), (F.col("says") == "block").cast("long").alias("bad"))
    score = F.col("score") if both else F.lit(0.0)
    own = F.when(score >= (limit(unseen) if both else 0.0), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("says", own).alias("verdict"), score.alias("score"))
