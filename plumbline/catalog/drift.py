"""Drift between two parts of a table."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.catalog.base import SQL_V1, query, staged_v1, table
from plumbline.operators import categories, distribution
from plumbline.operators.drift import drift_report, drift_summary
from plumbline.operators.gauges import drift_gauges
from plumbline.operators.ranks import areas
from plumbline.operators.roles import infer_roles, settle_distinct, table_facts
from plumbline.operators.split import side_sizes, split_at_fraction, split_at_time
from plumbline.operators.text_drift import domain_auc

RUN_TIME = datetime.datetime(2024, 2, 1, 12, 0, 0)
EVENT_COLUMNS = ["user_id", "event_type", "page", "purchase_value"]
LINEITEM_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_CATEGORIES = ["l_returnflag", "l_linestatus"]
SHIP_CUT = datetime.datetime(1998, 6, 1)


def events_in_halves(spark, sf_dir) -> DataFrame:
    return split_at_fraction(staged_v1(table(spark, sf_dir, "events")), ["ts", "event_id"])


def lineitem_by_date(spark, sf_dir) -> DataFrame:
    return split_at_time(table(spark, sf_dir, "lineitem"), "l_shipdate", SHIP_CUT)


def orders_in_halves(spark, sf_dir) -> DataFrame:
    return split_at_fraction(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"])


SQL_EVENT_HALVES = f"""{SQL_V1}, halves AS (SELECT *,
    row_number() OVER (ORDER BY ts, event_id) <= count(*) OVER () // 2 AS is_ref FROM stg)"""
SQL_ORDER_HALVES = """halves AS (SELECT *,
    row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= count(*) OVER () // 2 AS is_ref FROM orders)"""
SQL_LINEITEM_SIDES = "sides AS (SELECT *, l_shipdate < TIMESTAMP '1998-06-01' AS is_ref FROM lineitem)"


def _sql_long(source: str, columns: list[str], name: str, cast: str) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS col, CAST({c} AS {cast}) AS x, is_ref FROM {source} WHERE {c} IS NOT NULL"""
        for c in columns
    )
    return f"{name} AS ({parts})"


def _sql_steps(source: str) -> str:
    """Both distribution functions at every distinct value, in one ordered pass per column."""
    return f"""counts AS (SELECT col, x, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
        FROM {source} GROUP BY 1, 2),
    steps AS (SELECT col, x,
        sum(r) OVER (PARTITION BY col ORDER BY x) / sum(r) OVER (PARTITION BY col) AS f,
        sum(c) OVER (PARTITION BY col ORDER BY x) / sum(c) OVER (PARTITION BY col) AS g,
        lead(x) OVER (PARTITION BY col ORDER BY x) - x AS width FROM counts),
    spread AS (SELECT col, stddev_pop(x) FILTER (is_ref) AS sd, count(*) FILTER (is_ref) AS n_ref,
        count(*) FILTER (NOT is_ref) AS n_cur FROM {source} GROUP BY 1),
    ks AS (SELECT s.col, max(abs(f - g)) AS d, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur
        FROM steps s JOIN spread p ON s.col = p.col GROUP BY 1),
    w1 AS (SELECT s.col, coalesce(sum(abs(f - g) * width), 0) / greatest(any_value(sd), 0.001) AS w,
        any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur
        FROM steps s JOIN spread p ON s.col = p.col GROUP BY 1)"""


SQL_KS_ROWS = """, lam AS (SELECT *,
    (sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur))) * d AS lambda_
    FROM (SELECT col, d, n_ref::DOUBLE AS n_ref, n_cur::DOUBLE AS n_cur FROM ks))
    SELECT col AS "column", round(d, 6) AS statistic,
    round(least(1.0, greatest(0.0, (SELECT sum(2 * CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END
        * exp(-2.0 * k * k * lambda_ * lambda_)) FROM range(1, 101) t(k)))), 6) AS p_value,
    n_ref::BIGINT AS n_ref, n_cur::BIGINT AS n_cur FROM lam"""
SQL_W1_ROWS = """ SELECT col AS "column", round(w, 6) AS statistic, CAST(NULL AS DOUBLE) AS p_value,
    n_ref, n_cur FROM w1"""


def rounded(tested: DataFrame) -> DataFrame:
    return tested.withColumns(
        {name: F.round(name, 6) for name in ("statistic", "p_value") if name in tested.columns}
    )


@query(
    "drift_split",
    f"""WITH {SQL_EVENT_HALVES} SELECT is_ref, count(*) AS n_rows,
    CAST(sum(event_id) AS BIGINT) AS id_sum, min(ts) AS first_ts, max(ts) AS last_ts FROM halves GROUP BY 1""",
)
def drift_split(spark, sf_dir):
    return events_in_halves(spark, sf_dir).groupBy("is_ref").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("event_id").alias("id_sum"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


@query(
    "drift_split_rows",
    """SELECT o_orderkey, o_orderdate,
    row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(count(*) OVER () * 0.3) AS is_ref FROM orders""",
)
def drift_split_rows(spark, sf_dir):
    """Every order with its side; dates alone have many ties."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return split_at_fraction(orders, ["o_orderdate", "o_orderkey"], fraction=0.3)


def _sql_first(order: str, fraction: float, columns: str = "o_orderkey", source: str = "orders") -> str:
    return f"SELECT {columns}, row_number() OVER (ORDER BY {order}) <= floor(count(*) OVER () * {fraction}) AS is_ref FROM {source}"


@query("drift_split_text", _sql_first("o_orderpriority, o_orderkey", 0.3, "o_orderkey, o_orderpriority"))
def drift_split_text(spark, sf_dir):
    """Every order with its side, along a text of few values."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return split_at_fraction(orders, ["o_orderpriority", "o_orderkey"], fraction=0.3)


@query("drift_split_long_text", _sql_first("text, doc_id", 0.6, "doc_id", "documents"))
def drift_split_long_text(spark, sf_dir):
    """Every document with its side, along whole texts, many of which begin alike."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_at_fraction(documents, ["text", "doc_id"], fraction=0.6).select("doc_id", "is_ref")


@query("drift_split_double", _sql_first("price, o_orderkey", 0.5, "o_orderkey, price", "(SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -o_totalprice / 7 ELSE o_totalprice END AS price FROM orders)"))
def drift_split_double(spark, sf_dir):
    """Every order with its side, along doubles of both signs."""
    price = F.when(F.col("o_orderkey") % 3 == 0, -F.col("o_totalprice") / 7).otherwise(F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"))
    return split_at_fraction(orders, ["price", "o_orderkey"])


@query(
    "drift_split_decimal",
    _sql_first("value DESC, o_orderkey", 0.25, "o_orderkey", "(SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) * 1000000000000 AS DECIMAL(38, 2)) AS value FROM orders)"),
)
def drift_split_decimal(spark, sf_dir):
    """Every order with its side, along negative decimals of more digits than a long has."""
    value = (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(-(10**12)).cast("decimal(14,0)")).cast("decimal(38,4)")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"))
    return split_at_fraction(orders, ["value", "o_orderkey"], fraction=0.25).select("o_orderkey", "is_ref")


@query(
    "drift_side_sizes",
    f"""WITH {SQL_LINEITEM_SIDES} SELECT count(*) AS n_rows, count(*) FILTER (is_ref) AS n_ref,
    count(*) FILTER (NOT is_ref) AS n_cur FROM sides""",
)
def drift_side_sizes(spark, sf_dir):
    return side_sizes(lineitem_by_date(spark, sf_dir))


@query(
    "drift_ks",
    f"""WITH {SQL_EVENT_HALVES}, {_sql_long("halves", ["purchase_value"], "vals", "DOUBLE")},
    {_sql_steps("vals")} {SQL_KS_ROWS}""",
)
def drift_ks(spark, sf_dir):
    halves = events_in_halves(spark, sf_dir)
    distances = distribution.numeric_distances(halves, ["purchase_value"])
    return rounded(distribution.kolmogorov_smirnov(distances))


SQL_SUPPLIER_HALVES = """halves AS (SELECT *,
    row_number() OVER (ORDER BY s_suppkey) <= count(*) OVER () // 2 AS is_ref FROM supplier)"""


@query(
    "drift_ks_exact",
    f"""WITH RECURSIVE {SQL_SUPPLIER_HALVES}, {_sql_long("halves", ["s_acctbal", "s_nationkey"], "vals", "DOUBLE")},
    {_sql_steps("vals")}, size AS (SELECT col, d, CAST(n_ref AS BIGINT) AS n, CAST(n_cur AS BIGINT) AS m, CAST(round(d * n_ref * n_cur) AS BIGINT) AS bound FROM ks),
    walk AS (SELECT col, n, m, bound, 0 AS steps, list_transform(range(0, n + 1), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share FROM size
        UNION ALL SELECT col, n, m, bound, steps + 1, list_transform(range(0, n + 1), lambda i:
            CASE WHEN steps + 1 - i BETWEEN 0 AND m AND abs(i * m - (steps + 1 - i) * n) < bound
                THEN (CASE WHEN i > 0 THEN share[i] * i ELSE 0.0 END + share[i + 1] * (steps + 1 - i)) / (steps + 1) ELSE 0.0::DOUBLE END)
        FROM walk WHERE steps < n + m)
    SELECT s.col AS "column", round(d, 6) AS statistic, round(1 - share[s.n + 1], 6) AS p_value, s.n AS n_ref, s.m AS n_cur
    FROM size s JOIN walk w ON w.col = s.col AND steps = s.n + s.m""",
)
def drift_ks_exact(spark, sf_dir):
    """Small sides: p-values by counting all orders of the values."""
    halves = split_at_fraction(table(spark, sf_dir, "supplier"), ["s_suppkey"])
    distances = distribution.numeric_distances(halves, ["s_acctbal", "s_nationkey"])
    return rounded(distribution.kolmogorov_smirnov(distances, exact_pairs=1_000_000))


@query(
    "drift_ks_lineitem",
    f"""WITH {SQL_LINEITEM_SIDES}, {_sql_long("sides", LINEITEM_NUMBERS, "vals", "DOUBLE")},
    {_sql_steps("vals")} {SQL_KS_ROWS}""",
)
def drift_ks_lineitem(spark, sf_dir):
    distances = distribution.numeric_distances(lineitem_by_date(spark, sf_dir), LINEITEM_NUMBERS)
    return rounded(distribution.kolmogorov_smirnov(distances))


@query(
    "drift_wasserstein",
    f"""WITH {SQL_EVENT_HALVES}, {_sql_long("halves", ["purchase_value"], "vals", "DOUBLE")},
    {_sql_steps("vals")} {SQL_W1_ROWS}""",
)
def drift_wasserstein(spark, sf_dir):
    halves = events_in_halves(spark, sf_dir)
    distances = distribution.numeric_distances(halves, ["purchase_value"])
    return rounded(distribution.normed_wasserstein(distances))


@query(
    "drift_wasserstein_lineitem",
    f"""WITH {SQL_LINEITEM_SIDES}, {_sql_long("sides", LINEITEM_NUMBERS, "vals", "DOUBLE")},
    {_sql_steps("vals")} {SQL_W1_ROWS}""",
)
def drift_wasserstein_lineitem(spark, sf_dir):
    """Over bucketed distribution functions, as a table too large for one ordered pass needs."""
    sides = lineitem_by_date(spark, sf_dir)
    edges = distribution.find_edges(sides, LINEITEM_NUMBERS, count=32)
    distances = distribution.numeric_distances(sides, LINEITEM_NUMBERS, edges=edges)
    return rounded(distribution.normed_wasserstein(distances))


def _sql_shares(source: str) -> str:
    return f"""counts AS (SELECT col, x, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
        FROM {source} GROUP BY 1, 2),
    shares AS (SELECT *, sum(r) OVER (PARTITION BY col) AS n, sum(c) OVER (PARTITION BY col) AS m,
        r / sum(r) OVER (PARTITION BY col) AS p, c / sum(c) OVER (PARTITION BY col) AS q FROM counts)"""


SQL_JS = """js AS (SELECT col, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END)) / 2) AS js,
        CAST(max(n) AS BIGINT) AS n_ref, CAST(max(m) AS BIGINT) AS n_cur FROM shares GROUP BY 1)"""
SQL_JS_ROWS = """ SELECT col AS "column", round(js, 6) AS statistic, CAST(NULL AS DOUBLE) AS p_value,
    n_ref, n_cur FROM js"""


def _sql_gamma_tail(a: str, x: str) -> str:
    """Upper regularised gamma function as one minus the power series of the lower one."""
    return f"""greatest(0.0, 1 - (SELECT sum(exp(({a} + i) * ln({x}) - {x} - lgamma({a} + i + 1)))
        FROM range(0, CAST(2000 + 4 * ({x}) AS BIGINT)) t(i)))"""


@query(
    "drift_jensen_shannon",
    f"""WITH {SQL_EVENT_HALVES}, {_sql_long("halves", EVENT_COLUMNS[:3], "vals", "VARCHAR")},
    {_sql_shares("vals")}, {SQL_JS} {SQL_JS_ROWS}""",
)
def drift_jensen_shannon(spark, sf_dir):
    counts = categories.category_counts(events_in_halves(spark, sf_dir), EVENT_COLUMNS[:3])
    return rounded(categories.jensen_shannon(categories.category_measures(counts)))


@query(
    "drift_chi_square",
    f"""WITH {SQL_EVENT_HALVES}, {_sql_long("halves", EVENT_COLUMNS[:3], "vals", "VARCHAR")},
    {_sql_shares("vals")}, chi AS (SELECT col, sum(pow(c - r * m / n, 2) / (r * m / n)) AS x2,
        (count(*) - 1) / 2 AS a, CAST(max(n) AS BIGINT) AS n_ref, CAST(max(m) AS BIGINT) AS n_cur
        FROM shares GROUP BY 1)
    SELECT col AS "column", round(x2, 6) AS statistic,
        round({_sql_gamma_tail("a", "(x2 / 2)")}, 6) AS p_value, n_ref, n_cur FROM chi""",
)
def drift_chi_square(spark, sf_dir):
    counts = categories.category_counts(events_in_halves(spark, sf_dir), EVENT_COLUMNS[:3])
    return rounded(categories.chi_square(categories.category_measures(counts)))


@query(
    "drift_proportion_z",
    f"""WITH {SQL_LINEITEM_SIDES}, {_sql_long("sides", ["l_linestatus"], "vals", "VARCHAR")},
    {_sql_shares("vals")}, firsts AS (SELECT *, (r + c) / (n + m) AS both_ FROM shares
        WHERE x = (SELECT min(x) FROM vals)),
    z AS (SELECT col, (p - q) / sqrt(both_ * (1 - both_) * (1 / n + 1 / m)) AS z,
        CAST(n AS BIGINT) AS n_ref, CAST(m AS BIGINT) AS n_cur FROM firsts)
    SELECT col AS "column", round(z, 6) AS statistic,
        round({_sql_gamma_tail("0.5", "(z * z / 2)")}, 6) AS p_value, n_ref, n_cur FROM z""",
)
def drift_proportion_z(spark, sf_dir):
    counts = categories.category_counts(lineitem_by_date(spark, sf_dir), ["l_linestatus"])
    return rounded(categories.proportion_z(categories.category_measures(counts)))


SQL_ROLE = """CASE WHEN data_type = 'string' THEN CASE WHEN d > 0.5 * n THEN 'text' ELSE 'cat' END
    WHEN d <= 5 THEN 'cat' ELSE 'num' END"""


def _sql_roles(tables: list[tuple[str, list[tuple[str, str]]]]) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{source}' AS table_name, '{c}' AS "column", '{kind}' AS data_type,
        count(DISTINCT {c}) AS d, count({c}) AS n FROM {source}"""
        for source, columns in tables
        for c, kind in columns
    )
    return f"""seen AS ({parts})
    SELECT table_name, "column", {SQL_ROLE} AS kind, n AS n_values FROM seen"""


_ROLE_TABLES = [
    ("events", [("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")]),
    ("orders", [("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double")]),
    ("lineitem", [("l_linenumber", "int"), ("l_returnflag", "string"), ("l_discount", "double")]),
    ("documents", [("text", "string"), ("lang", "string"), ("n_chars", "bigint")]),
    ("labels", [("quality", "int"), ("toxic", "int")]),
]


@query("drift_roles", f"WITH {_sql_roles(_ROLE_TABLES)}")
def drift_roles(spark, sf_dir):
    rows = []
    for name, columns in _ROLE_TABLES:
        # roles look at all rows, so any flag will do
        frame = table(spark, sf_dir, name).withColumn("is_ref", F.lit(True))
        facts = settle_distinct(frame, table_facts(frame, [c for c, _ in columns]))
        rows += [
            (name, column, role, facts.columns[column].n_ref)
            for column, role in infer_roles(facts).items()
        ]
    return spark.createDataFrame(rows, "table_name string, column string, kind string, n_values bigint")


def _sql_verdicts(categorical: str, numeric: str) -> str:
    """Report rows of a table whose reference side is large."""
    return f"""report AS (SELECT "column", 'cat' AS kind, 'jensen_shannon' AS method, statistic,
        p_value, 0.1::DOUBLE AS threshold, statistic >= 0.1 AS drifted, n_ref, n_cur FROM ({categorical})
    UNION ALL SELECT "column", 'num', 'wasserstein', statistic, p_value, 0.1::DOUBLE, statistic >= 0.1,
        n_ref, n_cur FROM ({numeric}))"""


def _sql_report(sides: str, source: str, cats: list[str], nums: list[str]) -> str:
    categorical = f"""WITH {_sql_long(source, cats, "cats", "VARCHAR")}, {_sql_shares("cats")}, {SQL_JS} {SQL_JS_ROWS}"""
    numeric = f"""WITH {_sql_long(source, nums, "nums", "DOUBLE")}, {_sql_steps("nums")} {SQL_W1_ROWS}"""
    return f"{sides}, {_sql_verdicts(categorical, numeric)}"


SQL_EVENT_REPORT = _sql_report(SQL_EVENT_HALVES, "halves", EVENT_COLUMNS[:3], EVENT_COLUMNS[3:])
SQL_LINEITEM_REPORT = _sql_report(
    SQL_LINEITEM_SIDES, "sides", LINEITEM_CATEGORIES, ["l_linenumber", *LINEITEM_NUMBERS]
)
SQL_SUMMARY = """summary AS (SELECT CAST(count(*) AS INTEGER) AS n_columns,
    CAST(count(*) FILTER (drifted) AS INTEGER) AS drifted_count,
    count(*) FILTER (drifted) / count(*) AS drifted_share,
    count(*) FILTER (drifted) / count(*) >= 0.5 AS dataset_drift FROM report)"""


@query("drift_report", f"WITH {SQL_EVENT_REPORT} SELECT * FROM report")
def drift_report_events(spark, sf_dir):
    return rounded(drift_report(events_in_halves(spark, sf_dir), EVENT_COLUMNS))


@query("drift_report_lineitem", f"WITH {SQL_LINEITEM_REPORT} SELECT * FROM report")
def drift_report_lineitem(spark, sf_dir):
    columns = [*LINEITEM_CATEGORIES, "l_linenumber", *LINEITEM_NUMBERS]
    return rounded(drift_report(lineitem_by_date(spark, sf_dir), columns))


def _sql_full_report(sides: str, source: str, cats: list[str], nums: list[str]) -> str:
    """Report rows whatever the size of the reference side: p-values up to 1000 rows, else distances."""
    tests = f"""{_sql_long(source, cats, "cats", "VARCHAR")}, {_sql_shares("cats")}, {SQL_JS},
    firsts AS (SELECT *, (r + c) / (n + m) AS both_ FROM shares s
        WHERE x = (SELECT min(x) FROM cats v WHERE v.col = s.col)),
    two AS (SELECT col, CASE WHEN both_ < 1 THEN (p - q) / sqrt(both_ * (1 - both_) * (1 / n + 1 / m)) ELSE 0 END AS z
        FROM firsts),
    many AS (SELECT col, count(*) AS k, bool_or(r = 0) AS unseen, sum(CASE WHEN r > 0
        THEN pow(c - r * m / n, 2) / (r * m / n) END) AS x2 FROM shares GROUP BY 1),
    cat_rows AS (SELECT js.col, n_ref, n_cur,
        CASE WHEN n_ref > 1000 THEN 'jensen_shannon' WHEN k <= 2 THEN 'proportion_z' ELSE 'chi_square' END AS method,
        CASE WHEN n_ref > 1000 THEN js WHEN k <= 2 THEN z WHEN unseen THEN 'inf'::DOUBLE ELSE x2 END AS statistic,
        CASE WHEN n_ref > 1000 THEN NULL WHEN k > 2 AND unseen THEN 0.0
            WHEN k <= 2 AND z = 0 THEN 1.0 WHEN k > 2 AND x2 = 0 THEN 1.0
            WHEN k <= 2 THEN {_sql_gamma_tail("0.5", "(z * z / 2)")}
            ELSE {_sql_gamma_tail("((k - 1) / 2)", "(x2 / 2)")} END AS p_value
        FROM js JOIN two ON js.col = two.col JOIN many ON js.col = many.col)"""
    method = "CASE WHEN n_ref > 1000 THEN '{large}' ELSE '{small}' END"
    shape = """round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
        CASE WHEN n_ref > 1000 THEN 0.1::DOUBLE ELSE 0.05::DOUBLE END AS threshold,
        CASE WHEN n_ref > 1000 THEN statistic >= 0.1 ELSE p_value < 0.05 END AS drifted, n_ref, n_cur"""
    rows = f"""SELECT col AS "column", 'cat' AS kind, method, {shape} FROM cat_rows"""
    if nums:
        tests += f""", {_sql_long(source, nums, "nums", "DOUBLE")}, {_sql_steps("nums").replace("counts", "num_counts")},
    lam AS (SELECT *, (sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur)))
        * d AS lambda_ FROM ks),
    num_rows AS (SELECT lam.col, lam.n_ref, lam.n_cur, {method.format(large="wasserstein", small="ks")
        .replace("n_ref", "lam.n_ref")} AS method,
        CASE WHEN lam.n_ref > 1000 THEN w ELSE d END AS statistic,
        CASE WHEN lam.n_ref <= 1000 THEN least(1.0, greatest(0.0, (SELECT sum(2 * CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END
            * exp(-2.0 * k * k * lambda_ * lambda_)) FROM range(1, 101) t(k)))) END AS p_value
        FROM lam JOIN w1 ON lam.col = w1.col)"""
        rows += f""" UNION ALL SELECT col, 'num', method, {shape} FROM num_rows"""
    return f"WITH {sides}, {tests} {rows}"


SQL_DOCUMENT_HALVES = """halves AS (SELECT *,
    row_number() OVER (ORDER BY doc_id) <= count(*) OVER () // 2 AS is_ref FROM documents)"""
SQL_LABEL_HALVES = SQL_DOCUMENT_HALVES.replace("documents", "labels")


@query(
    "drift_report_document_facts",
    _sql_full_report(SQL_DOCUMENT_HALVES, "halves", ["lang", "source"], ["n_chars"]),
)
def drift_report_document_facts(spark, sf_dir):
    """Up to 2,000 documents have a small reference side, so tests with p-values."""
    halves = split_at_fraction(table(spark, sf_dir, "documents"), ["doc_id"])
    return rounded(drift_report(halves, ["lang", "source", "n_chars"]))


@query("drift_report_labels", _sql_full_report(SQL_LABEL_HALVES, "halves", ["quality", "toxic"], []))
def drift_report_labels(spark, sf_dir):
    """Two-valued numbers are categories; with a small reference side they take the proportion test."""
    halves = split_at_fraction(table(spark, sf_dir, "labels"), ["doc_id"])
    return rounded(drift_report(halves, ["quality", "toxic"]))


@query(
    "drift_report_orders",
    _sql_full_report(SQL_ORDER_HALVES, "halves", ["o_orderstatus", "o_orderpriority"], ["o_totalprice", "o_custkey"]),
)
def drift_report_orders(spark, sf_dir):
    columns = ["o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey"]
    return rounded(drift_report(orders_in_halves(spark, sf_dir), columns))


@query("drift_report_documents")
def drift_report_documents(spark, sf_dir):
    """A table with all three kinds of columns."""
    halves = split_at_fraction(table(spark, sf_dir, "documents"), ["doc_id"])
    return rounded(drift_report(halves, ["text", "lang", "source", "n_chars"]))


@query("drift_summary", f"WITH {SQL_EVENT_REPORT}, {SQL_SUMMARY} SELECT * FROM summary")
def drift_summary_events(spark, sf_dir):
    return drift_summary(drift_report(events_in_halves(spark, sf_dir), EVENT_COLUMNS))


@query(
    "drift_gauges",
    f"""WITH {SQL_EVENT_REPORT}, {SQL_SUMMARY}
    SELECT TIMESTAMP '2024-02-01 12:00:00' AS run_time, 'evidently_batch_validation' AS job,
    'model_data_drift_score' AS name, 'Data drift score' AS help, 'stg_user_events_v1' AS model_name,
    CAST(drifted_share AS DOUBLE) AS value FROM summary UNION ALL
    SELECT TIMESTAMP '2024-02-01 12:00:00', 'evidently_batch_validation', 'model_data_drift_detected',
    'Number of columns with drift', 'stg_user_events_v1',
    CAST(drifted_count AS DOUBLE) FROM summary""",
)
def drift_gauges_events(spark, sf_dir):
    summary = drift_summary(drift_report(events_in_halves(spark, sf_dir), EVENT_COLUMNS))
    made = drift_gauges(summary, "stg_user_events_v1", RUN_TIME)
    return made.selectExpr(
        "run_time", "job", "name", "help", "labels['model_name'] AS model_name", "value"
    )


def _sql_areas(source: str, columns: list[str]) -> str:
    parts = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS x, flag FROM {source} WHERE {c} IS NOT NULL" for c in columns)
    return f"""vals AS ({parts}),
    ranked AS (SELECT col, flag, rank() OVER (PARTITION BY col ORDER BY x) AS first_rank, count(*) OVER (PARTITION BY col, x) AS same FROM vals),
    sums AS (SELECT col, sum(first_rank + (same - 1) / 2.0) FILTER (flag) AS ranks, count(*) FILTER (flag) AS p, count(*) FILTER (NOT flag) AS n FROM ranked GROUP BY 1)
    SELECT col AS "column", round((ranks - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n), 9) AS auc, p AS n_pos, n AS n_neg FROM sums"""


@query(
    "score_auc",
    f"WITH scored AS (SELECT *, l_returnflag = 'R' AS flag FROM lineitem), {_sql_areas('scored', LINEITEM_NUMBERS)}",
)
def score_auc(spark, sf_dir):
    """How well each number of a line item tells returned ones from the rest; most of them have many ties."""
    lines = table(spark, sf_dir, "lineitem").withColumn("flag", F.col("l_returnflag") == "R")
    return areas(lines, LINEITEM_NUMBERS, "flag").withColumn("auc", F.round("auc", 9))


@query(
    "score_auc_documents",
    f"WITH scored AS (SELECT n_chars, d.doc_id, quality = 1 AS flag FROM documents d JOIN labels l ON d.doc_id = l.doc_id), {_sql_areas('scored', ['n_chars', 'doc_id'])}",
)
def score_auc_documents(spark, sf_dir):
    """How well a document's length tells its quality, and how badly its number does."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("flag"))
    scored = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(labels, "doc_id")
    return areas(scored, ["n_chars", "doc_id"], "flag").withColumn("auc", F.round("auc", 9))


@query("drift_text_classifier")
def drift_text_classifier(spark, sf_dir):
    """How well a classifier tells the first half of the documents from the rest."""
    halves = split_at_fraction(table(spark, sf_dir, "documents"), ["doc_id"])
    auc = domain_auc(halves, "text")
    return side_sizes(halves).select(
        F.lit("text").alias("column"), F.lit(auc).cast("double").alias("auc"), "n_ref", "n_cur"
    )


SQL_UNUSUAL = "u AS (SELECT event_id, is_ref, CASE event_id % 7 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN '-Infinity'::DOUBLE WHEN 3 THEN NULL ELSE purchase_value END AS x FROM halves)"


@query(
    "drift_unusable_values",
    f"""WITH {SQL_EVENT_HALVES}, {SQL_UNUSUAL}, vals AS (SELECT 'x' AS col, x, is_ref FROM u WHERE x IS NOT NULL AND isfinite(x)),
    {_sql_steps("vals")} {SQL_W1_ROWS}""",
)
def drift_unusable_values(spark, sf_dir):
    """NULL, NaN and infinite values take no part in a distance."""
    kind = F.col("event_id") % 7
    number = F.when(kind == 0, float("nan")).when(kind == 1, float("inf")).when(kind == 2, float("-inf")).when(kind > 3, F.col("purchase_value"))
    sides = events_in_halves(spark, sf_dir).withColumn("x", number)
    return rounded(distribution.normed_wasserstein(distribution.numeric_distances(sides, ["x"])))
