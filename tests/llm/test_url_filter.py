import math
import re
from collections import Counter, defaultdict

from plumbline.llm import url_filter

URLS = [
    None, "", "abc", "HTTP://A.Net", "http://NET/x", "x://Example.net/en/?q", "a://b://c.org/fr/z#q", "h://xexample.com/de/",
    "h://org?x/fr/", "http://É.Org/fr/\n/x", "http://www.example.com/de/1", "http://www.example.com/en/1",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path)) if fits else None
    return host, path, best and best.host + best.path, best and best.verdict


def test_hosts_paths_and_rules(spark):
    rows = [(k, u) for k, u in enumerate(URLS)] + [(None, URLS[5]), (3, URLS[3])]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "page_id long, url string, host string, score double")
    got = url_filter.judge(df).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=repr) == sorted(((i, *brute(u)[:3]) for i, u in rows), key=repr)
    says = {u: brute(u)[3] for u in URLS}
    by_id = dict(rows)
    assert all(r.verdict in ("allow", "block") and says[by_id[r.page_id]] in (None, r.verdict) for r in got)
    assert url_filter.judge(df.limit(0)).count() == 0


def test_models_agree_with_brute_force(spark):
    order = 2
    good, bad, new = ["abab", "abba"], ["cdcd", "dddc", "ab"], ["abcd", "zz"]
    pad = lambda t: "\x02" * order + t + "\x03"
    grams = lambda t: [pad(t)[i : i + order + 1] for i in range(len(t) + 1)]
    rows = [(g, int(t in good), int(t in bad)) for t in good + bad + new for g in grams(t)]
    df = spark.createDataFrame(rows, "gram string, good long, bad long")
    got = {r.gram: r.ratio for r in url_filter.log_ratios(df, order).collect()}
    letters = {r[0][-1] for r in rows}

    def chance(gram, texts):
        counts, after = Counter(), defaultdict(Counter)
        for t in texts:
            for g in grams(t):
                for level in range(order + 1):
                    after[g[order - level : order]][g[-1]] += 1
        p = 1 / len(letters)
        for level in range(order + 1):
            own = after[gram[order - level : order]]
            total = sum(own.values()) + len(own)
            p = (own[gram[-1]] + len(own) * p) / total if total else p
        return p

    assert got.keys() == {r[0] for r in rows}
    for gram, ratio in got.items():
        assert math.isclose(ratio, math.log(chance(gram, good) / chance(gram, bad)), rel_tol=1e-9, abs_tol=1e-9)


def test_models_tell_hosts_apart(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = [r for r in url_filter.judge(pages).collect() if r.rule is None]
    right = sum((r.verdict == "block") == r.host.endswith(".com") for r in got)
    assert len(got) > 50 and right > 0.9 * len(got)
