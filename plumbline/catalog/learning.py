"""Features, training, search, registry and scoring."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.catalog.base import SQL_V1, query, staged_v1, table
from plumbline.operators import features, ranking, registry, scoring, search, training
from plumbline.operators.split import in_share, sampled, train_test
from plumbline.plans import score as score_plan
from plumbline.session import scratch_path
from plumbline.sources.tables import append_rows, reused


def sql_share(key: str, share: float, seed: int = 42) -> str:
    """The share of keys whose digest, as a number, is below the share of all numbers."""
    return f"CAST('0x' || substr(md5({key} || '{seed}'), 1, 15) AS BIGINT) < {int(share * 16**15)}"


SQL_TEST = sql_share("{key}", 0.2)


@query(
    "split_hash_80_20",
    f"SELECT event_id, {SQL_TEST.format(key='CAST(event_id AS VARCHAR)')} AS is_test FROM events",
)
def split_hash_80_20(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", in_share(F.col("event_id"), 0.2, 42).alias("is_test"))


@query(
    "sample_by_key",
    """SELECT l_orderkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS total FROM lineitem
    WHERE """
    + sql_share("CAST(l_orderkey AS VARCHAR)", 0.1, 7)
    + " GROUP BY 1",
)
def sample_by_key(spark, sf_dir):
    """A tenth of the orders with all their lines."""
    lines = sampled(table(spark, sf_dir, "lineitem"), "l_orderkey", 0.1, seed=7)
    return lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("total")
    )


SHARES = (0.0, 0.00001, 0.1, 0.2, 1.0)


@query(
    "sample_shares",
    " UNION ALL ".join(
        f"SELECT CAST({share!r} AS DOUBLE) AS share, count(*) FILTER (WHERE {sql_share('k', share)}) AS n_rows, "
        f"count(DISTINCT k) FILTER (WHERE {sql_share('k', share)}) AS n_keys "
        "FROM (SELECT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem)"
        for share in SHARES
    ),
)
def sample_shares(spark, sf_dir):
    """How many rows and keys of a table fall into shares from none to all."""
    lines = table(spark, sf_dir, "lineitem")
    inside = [(share, in_share(F.col("l_orderkey"), share)) for share in SHARES]
    counts = lines.agg(
        *[F.count_if(held).alias(f"rows_{k}") for k, (_, held) in enumerate(inside)],
        *[F.count_distinct(F.when(held, F.col("l_orderkey"))).alias(f"keys_{k}") for k, (_, held) in enumerate(inside)],
    )
    rows = [
        F.struct(F.lit(share).alias("share"), F.col(f"rows_{k}").alias("n_rows"), F.col(f"keys_{k}").alias("n_keys"))
        for k, (share, _) in enumerate(inside)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _sql_ranks(column: str) -> str:
    return f"""SELECT CAST({column} AS VARCHAR) AS category, count(*) AS n_rows,
    row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1 AS index"""


@query("index_categories", f"WITH {SQL_V1} {_sql_ranks('user_id')} FROM stg GROUP BY 1")
def index_categories(spark, sf_dir):
    return ranking.rank_categories(staged_v1(table(spark, sf_dir, "events")), "user_id")


@query("index_categories_large", f"{_sql_ranks('l_orderkey')} FROM lineitem GROUP BY 1")
def index_categories_large(spark, sf_dir):
    """A column of many categories, numbered in ranges."""
    return ranking.rank_categories(table(spark, sf_dir, "lineitem"), "l_orderkey", small=1000)


SQL_INDEXES = f"""{SQL_V1},
    users AS ({_sql_ranks('user_id')} FROM stg GROUP BY 1),
    pages AS ({_sql_ranks('page')} FROM stg GROUP BY 1),
    types AS ({_sql_ranks('event_type')} FROM stg GROUP BY 1)"""


def _assembled(spark, sf_dir) -> DataFrame:
    staged = staged_v1(table(spark, sf_dir, "events")).fillna(0.0, ["purchase_value"])
    columns = ["user_id", "page"]
    indexed = features.index_categories(staged, columns, features.category_table(staged, columns))
    stages = [
        features.label_indexer("event_type"),
        features.assembler(["user_id_index", "page_index", "purchase_value"]),
    ]
    return features.fit_features(stages, indexed).transform(indexed)


@query(
    "assemble_many_categories",
    f"""WITH keys AS ({_sql_ranks('l_orderkey')} FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_linenumber, CAST(index AS DOUBLE) AS l_orderkey_index, l_quantity
    FROM lineitem JOIN keys ON category = CAST(l_orderkey AS VARCHAR)""",
)
def assemble_many_categories(spark, sf_dir):
    """A feature column with as many categories as there are orders."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    indexed = features.index_categories(lines, ["l_orderkey"], features.category_table(lines, ["l_orderkey"]))
    parts = vector_to_array("features")
    return features.assembler(["l_orderkey_index", "l_quantity"]).transform(indexed).select(
        "l_orderkey", "l_linenumber", parts[0].alias("l_orderkey_index"), parts[1].alias("l_quantity")
    )


@query(
    "assemble_features",
    f"""WITH {SQL_INDEXES} SELECT event_id, CAST(t.index AS DOUBLE) AS label,
    CAST(u.index AS DOUBLE) AS user_id_index, CAST(p.index AS DOUBLE) AS page_index, purchase_value
    FROM stg JOIN users u ON u.category = user_id JOIN pages p ON p.category = page
    JOIN types t ON t.category = event_type""",
)
def assemble_features(spark, sf_dir):
    parts = vector_to_array("features")
    return _assembled(spark, sf_dir).select(
        "event_id",
        "label",
        parts[0].alias("user_id_index"),
        parts[1].alias("page_index"),
        parts[2].alias("purchase_value"),
    )


@query(
    "index_joined",
    f"""WITH {SQL_INDEXES},
    clicked AS ({_sql_ranks('page')} FROM stg WHERE event_type = 'click' AND page <> '/cart' GROUP BY 1)
    SELECT event_id, CAST(u.index AS DOUBLE) AS user_id_index,
    CAST(coalesce(q.index, (SELECT count(*) FROM clicked)) AS DOUBLE) AS page_index
    FROM stg JOIN users u ON u.category = user_id LEFT JOIN clicked q ON q.category = page""",
)
def index_joined(spark, sf_dir):
    """Indexes by join; the second index knows only some of the pages it meets."""
    staged = staged_v1(table(spark, sf_dir, "events"))
    users = ranking.rank_categories(staged, "user_id")
    seen = staged.where((F.col("event_type") == "click") & (F.col("page") != "/cart"))
    pages = ranking.rank_categories(seen, "page")
    indexed = ranking.index_column(staged, "user_id", users, "user_id_index")
    indexed = ranking.index_column(indexed, "page", pages, "page_index")
    return indexed.select("event_id", "user_id_index", "page_index")


def labelled_texts(spark, sf_dir) -> DataFrame:
    """Documents that have a quality label, with it as the class."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return documents.join(labels, "doc_id")


@query(
    "training_table",
    f"""SELECT d.doc_id, n_chars, CAST(quality AS DOUBLE) AS label,
    {sql_share('CAST(d.doc_id AS VARCHAR)', 0.2)} AS is_test
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def training_table(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return documents.join(labels, "doc_id").withColumn("is_test", in_share(F.col("doc_id"), 0.2, 42))


def _text_features(spark, sf_dir):
    rows = labelled_texts(spark, sf_dir)
    before = features.fit_features(features.text_stages("text"), rows)
    ready = before.transform(rows).select("doc_id", "features", "label")
    return before, *train_test(ready, "doc_id")


@query("train_accuracy")
def train_accuracy(spark, sf_dir):
    """Text quality: fit on four fifths, judge on the rest."""
    before, train_rows, test_rows = _text_features(spark, sf_dir)
    with reused(train_rows) as ready:
        trained = training.train(ready, test_rows, training.Params(), before)
        rows = training.training_shape(ready)
    return spark.createDataFrame(
        [(trained.params.c, trained.params.solver, rows.rows, round(trained.accuracy, 6))],
        "c double, solver string, n_train bigint, accuracy double",
    )


@query("train_accuracy_classes")
def train_accuracy_classes(spark, sf_dir):
    """Text language, four classes: one class against the rest, and all classes jointly."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    stages = [features.label_indexer("lang"), *features.text_stages("text")]
    ready = features.fit_features(stages, documents).transform(documents)
    train_rows, test_rows = train_test(ready.select("doc_id", "features", "label"), "doc_id")
    trials = [training.Params(0.1, solver) for solver in ("liblinear", "lbfgs")]
    return search.run_trials(train_rows, test_rows, trials)


def _trials(spark, sf_dir) -> DataFrame:
    _, train_rows, test_rows = _text_features(spark, sf_dir)
    return search.run_trials(train_rows, test_rows, search.draw(), parallelism=8)


def _ledger(spark, sf_dir) -> DataFrame:
    """A ledger of many searches, written and read back: each user's events as trials, some of them finished twice or without an accuracy."""
    events = table(spark, sf_dir, "events")
    trial = events.select(
        F.concat(F.lit("search_"), "user_id").alias("search_id"),
        F.col("event_id").cast("int").alias("trial_id"),
        (F.lit(1.0) / (F.col("event_id") + 1)).alias("c"),
        F.get(F.array(*map(F.lit, training.SOLVERS)), (F.col("event_id") % 3).cast("int")).alias("solver"),
        F.when(F.col("event_type") != "error", F.floor(F.col("value") / 10) / 100).alias("accuracy"),
        F.col("ts").cast("timestamp").alias("finished_at"),
    )
    again = trial.where("trial_id % 4 = 0").select("*").withColumn("accuracy", F.lit(2.0)).withColumn("finished_at", F.col("finished_at") + F.expr("INTERVAL 1 DAY"))
    path = scratch_path(spark, "ledger")
    append_rows(trial, path)
    append_rows(again, path)
    return search.finished(search.Ledger(spark, path).rows)


SQL_LEDGER = """trial AS (SELECT 'search_' || user_id AS search_id, CAST(event_id AS INTEGER) AS trial_id, 1.0::DOUBLE / (event_id + 1) AS c,
    ['liblinear', 'saga', 'lbfgs'][1 + event_id % 3] AS solver, CASE WHEN event_type <> 'error' THEN floor(value / 10) / 100 END AS accuracy FROM events)"""


FIT = training.Params(0.5, "lbfgs")

SQL_FIT = f"""WITH RECURSIVE lines AS (SELECT l_quantity / 50 AS x, CASE WHEN l_quantity + 200 * l_discount > 35 THEN 1.0 ELSE 0.0 END AS y FROM lineitem
        WHERE NOT {sql_share("CAST(l_orderkey AS VARCHAR)", 0.2)}),
    groups_ AS (SELECT x, CAST(count(*) AS DOUBLE) AS n, sum(y) AS p FROM lines GROUP BY 1),
    data AS (SELECT list({{'x': x, 'n': n, 'p': p}}) AS points, sum(n) AS rows_, 1 / ({FIT.c} * sum(n)) AS penalty FROM groups_),
    newton AS (SELECT 0 AS step, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 UNION ALL
        SELECT step + 1, b0 + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b1 + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) FROM (
            SELECT step, b0, b1,
                list_sum(list_transform(points, lambda t: t.p - t.n / (1 + exp(-b0 - b1 * t.x)))) / rows_ AS g0,
                list_sum(list_transform(points, lambda t: t.x * (t.p - t.n / (1 + exp(-b0 - b1 * t.x))))) / rows_ - penalty * b1 AS g1,
                list_sum(list_transform(points, lambda t: t.n / (1 + exp(-b0 - b1 * t.x)) / (1 + exp(b0 + b1 * t.x)))) / rows_ AS h00,
                list_sum(list_transform(points, lambda t: t.x * t.n / (1 + exp(-b0 - b1 * t.x)) / (1 + exp(b0 + b1 * t.x)))) / rows_ AS h01,
                list_sum(list_transform(points, lambda t: t.x * t.x * t.n / (1 + exp(-b0 - b1 * t.x)) / (1 + exp(b0 + b1 * t.x)))) / rows_ + penalty AS h11
            FROM newton, data WHERE step < 25))"""


def _quantity_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Line items with one feature and a label that it tells in part; training and test rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.array(F.col("l_quantity") / 50).alias("x"),
        F.when(F.col("l_quantity") + 200 * F.col("l_discount") > 35, 1.0).otherwise(0.0).alias("label"),
    )
    return train_test(features.vector_of(lines, "x").select("l_orderkey", "features", "label"), "l_orderkey")


@query(
    "train_coefficients",
    f"{SQL_FIT} SELECT round(b0, 2) AS intercept, round(b1, 2) AS coefficient, CAST(rows_ AS BIGINT) AS n_train FROM newton, data WHERE step = 25",
)
def train_coefficients(spark, sf_dir):
    """A fit with one feature, against Newton's method by a recursive query."""
    train_rows, test_rows = _quantity_rows(spark, sf_dir)
    with reused(train_rows) as ready:
        model = training.train(ready, test_rows, FIT).model.stages[-1]
        rows = training.training_shape(ready).rows
    return spark.createDataFrame([(round(model.intercept, 2), round(float(model.coefficients[0]), 2), rows)], "intercept double, coefficient double, n_train bigint")


@query(
    "stored_accuracy",
    f"""{SQL_FIT}, test AS (SELECT l_quantity / 50 AS x, CASE WHEN l_quantity + 200 * l_discount > 35 THEN 1.0 ELSE 0.0 END AS y FROM lineitem
        WHERE {sql_share("CAST(l_orderkey AS VARCHAR)", 0.2)})
    SELECT round(avg(CASE WHEN (b0 + b1 * x > 0) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n_test FROM test, newton WHERE step = 25""",
)
def stored_accuracy(spark, sf_dir):
    """Held-out accuracy of a stored and loaded model, over its stored predictions."""
    train_rows, test_rows = _quantity_rows(spark, sf_dir)
    place = scratch_path(spark, "accuracy")
    with reused(train_rows) as ready:
        training.save_model(training.train(ready, test_rows.limit(0), FIT).model, f"{place}/model")
    scoring.score(training.load_model(f"{place}/model"), test_rows).select("l_orderkey", "label", "prediction").write.parquet(f"{place}/predictions")
    predictions = spark.read.parquet(f"{place}/predictions")
    return spark.createDataFrame([(round(training.accuracy(predictions), 6), predictions.count())], "accuracy double, n_test bigint")


@query("hpo_trials")
def hpo_trials(spark, sf_dir):
    return _trials(spark, sf_dir)


@query(
    "hpo_best",
    f"""WITH {SQL_LEDGER}, ranked AS (SELECT *, row_number() OVER (PARTITION BY search_id ORDER BY accuracy DESC NULLS LAST, trial_id) AS place FROM trial)
    SELECT search_id, trial_id, c, solver, accuracy FROM ranked WHERE place = 1""",
)
def hpo_best(spark, sf_dir):
    """The best trial of each search of a stored ledger; accuracies have many ties."""
    return search.best_trials(_ledger(spark, sf_dir))


@query(
    "run_log_rows",
    f"""WITH {SQL_LEDGER}, part AS (SELECT search_id || '-' || trial_id AS run_id, unnest([1, 2, 3]) AS at_, * FROM trial),
    rows_ AS (SELECT run_id, CASE WHEN at_ = 3 THEN 'metric' ELSE 'param' END AS kind, ['C', 'solver', 'accuracy'][at_] AS key,
        CASE at_ WHEN 1 THEN round(c, 9) WHEN 3 THEN round(accuracy, 9) END AS number, CASE WHEN at_ = 2 THEN solver END AS text FROM part)
    SELECT * FROM rows_ WHERE number IS NOT NULL OR text IS NOT NULL""",
)
def run_log_rows(spark, sf_dir):
    """A stored ledger as a run log; numbers are read back from their texts."""
    rows = registry.ledger_rows(_ledger(spark, sf_dir))
    is_text = F.col("key") == "solver"
    return rows.select(
        "run_id", "kind", "key", F.when(~is_text, F.round(F.col("value").cast("double"), 9)).alias("number"), F.when(is_text, F.col("value")).alias("text")
    )


def _registrations(events: DataFrame) -> DataFrame:
    """The event log read as a log of alias moves."""
    return events.select(
        F.concat(F.lit("model_"), F.col("user_id")).alias("name"),
        F.when(F.col("event_type") == "purchase", "Production").otherwise("Staging").alias("alias"),
        F.col("event_id").cast("int").alias("version"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("assigned_at"),
    )


SQL_REGISTRATIONS = """moves AS (SELECT 'model_' || user_id AS name,
    CASE WHEN event_type = 'purchase' THEN 'Production' ELSE 'Staging' END AS alias,
    CAST(event_id AS INTEGER) AS version, date_trunc('hour', ts) AS assigned_at FROM events)"""


@query(
    "registry_current_alias",
    f"""WITH {SQL_REGISTRATIONS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY name, alias ORDER BY assigned_at DESC, version DESC) AS place FROM moves)
    SELECT name, alias, version, CAST(assigned_at AS TIMESTAMP) AS assigned_at FROM ranked WHERE place = 1""",
)
def registry_current_alias(spark, sf_dir):
    return registry.current_aliases(_registrations(table(spark, sf_dir, "events")))


@query(
    "registry_next_version",
    """WITH asked AS (SELECT DISTINCT 'model_' || c_custkey AS name FROM customer),
    taken AS (SELECT 'model_' || user_id AS name, max(CAST(event_id AS INTEGER)) AS version FROM events GROUP BY 1)
    SELECT a.name, CAST(coalesce(version, 0) + 1 AS INTEGER) AS version FROM asked a
    LEFT JOIN taken t ON a.name = t.name""",
)
def registry_next_version(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(F.concat(F.lit("model_"), F.col("c_custkey")).alias("name"))
    return registry.next_versions(_registrations(table(spark, sf_dir, "events")), names.distinct())


@query(
    "score_request_expand",
    """WITH line AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, l_discount FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(0 AS INTEGER) AS row_no, l_discount AS discount,
        l_quantity AS quantity, CAST(NULL AS DOUBLE) AS tax FROM line
    UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 1, l_quantity, l_discount, NULL FROM line""",
)
def score_request_expand(spark, sf_dir):
    """Each line item becomes a request of two rows; features are asked for by name."""
    q, d = F.col("l_quantity"), F.col("l_discount")
    request = F.to_json(
        F.struct(
            F.struct(
                F.array(F.lit("quantity"), F.lit("discount")).alias("columns"),
                F.array(F.array(q, d), F.array(d, q)).alias("data"),
            ).alias("dataframe_split")
        )
    )
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    requests = table(spark, sf_dir, "lineitem").select(*keys, request.alias("request"))
    return scoring.expand_requests(requests, "request", ["discount", "quantity", "tax"], keys)


SCORED = [scoring.Input("flag", "string", required=False), scoring.Input("quantity"), scoring.Input("discount", fill="0.0")]


def _rule_model(spark, lines: DataFrame) -> registry.Registry:
    """A stored, registered and aliased model whose rule SQL can follow: a cut of discounted quantity, moved by the flag's index."""
    rows = lines.select(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"))
    models = registry.Registry(spark, scratch_path(spark, "registry"))
    uri = f"{models.root}/models/rule/1"
    features.category_table(rows, ["flag"]).write.parquet(training.categories_path(uri))
    scoring.input_rows(spark, SCORED).write.parquet(training.inputs_path(uri))
    cut = rows.agg(F.round(F.avg(F.col("quantity") * (1 - F.col("discount"))), 4)).first()[0]
    rule = f"SELECT *, CASE WHEN quantity * (1 - discount) - 5 * flag_index > {cut or 0.0!r} THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__"
    stages = [features.assembler(["flag_index", "quantity", "discount"]), SQLTransformer(statement=rule)]
    training.save_model(PipelineModel(stages), uri)
    at = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    models.point("rule", "Live", models.register("rule", "1", uri, at), at)
    return models


def _requests(lines: DataFrame) -> DataFrame:
    """Each line item as a request of two rows; by its number one of ten kinds, most of them faulty."""
    q, d, f = F.col("l_quantity"), F.col("l_discount"), F.concat(F.lit('"'), "l_returnflag", F.lit('"'))
    null, names = F.lit("null"), '"discount","quantity","flag"'

    def body(columns: str, *rows: Sequence[Column]) -> Column:
        data = F.concat_ws(",", *[F.concat(F.lit("["), F.concat_ws(",", *[c.cast("string") for c in row]), F.lit("]")) for row in rows])
        return F.concat(F.lit('{"dataframe_split":{"columns":[' + columns + '],"data":['), data, F.lit("]}}"))

    second = [F.lit("0.0"), q + 1, f]
    kinds = [
        F.lit("not json"),
        body('"discount","flag"', [d, f], [d, f]),
        body(names, [d, q, f], second[:2]),
        body(names, [d, null, f], second),
        body(names, [d, q, f], [F.lit("0.0"), F.lit('"many"'), f]),
        body(names, [d, q, F.lit('"?"')], second),
        body('"discount","quantity","flag","flag"', [d, q, f, f], [*second, f]),
        body(names),
        body(names, [null, q, f], second),
        body('"other","flag","quantity","discount"', [F.lit('"x"'), f, q, d], [F.lit("1"), f, q + 1, F.lit("0.0")]),
    ]
    return lines.select("l_orderkey", "l_linenumber", F.get(F.array(*kinds), ((F.col("l_orderkey") + F.col("l_linenumber")) % 10).cast("int")).alias("request"))


SQL_SCORED = f"""WITH flags AS ({_sql_ranks('l_returnflag')} FROM lineitem GROUP BY 1),
    cut AS (SELECT round(avg(l_quantity * (1 - l_discount)), 4) AS cut FROM lineitem),
    line AS (SELECT *, (l_orderkey + l_linenumber) % 10 AS kind FROM lineitem),
    part AS (SELECT l_orderkey, l_linenumber, kind, unnest(CASE WHEN kind IN (0, 1, 6, 7) THEN [-1] ELSE [0, 1] END) AS pos, l_returnflag, l_quantity, l_discount FROM line),
    cell AS (SELECT l_orderkey, l_linenumber, CASE WHEN pos >= 0 THEN CAST(pos AS INTEGER) END AS row_no,
        CASE WHEN kind = 0 THEN 'unreadable' WHEN kind = 1 THEN 'missing_feature' WHEN kind = 6 THEN 'repeated_feature' WHEN kind = 7 THEN 'no_rows'
            WHEN kind = 2 AND pos = 1 THEN 'wrong_length' WHEN kind = 3 AND pos = 0 OR kind = 4 AND pos = 1 THEN 'no_value' END AS problem,
        CASE WHEN pos < 0 OR kind = 2 AND pos = 1 THEN NULL WHEN kind = 5 AND pos = 0 THEN '?' ELSE l_returnflag END AS flag,
        CASE WHEN pos < 0 OR kind = 3 AND pos = 0 OR kind = 4 AND pos = 1 THEN NULL WHEN pos = 0 THEN l_quantity ELSE l_quantity + 1 END AS quantity,
        CASE WHEN pos < 0 OR kind = 8 AND pos = 0 THEN NULL WHEN pos = 0 THEN l_discount ELSE 0.0 END AS discount FROM part)
    SELECT l_orderkey, l_linenumber, row_no, problem, flag, quantity, discount, CASE WHEN problem IS NULL THEN
        CASE WHEN quantity * (1 - coalesce(discount, 0.0)) - 5 * coalesce(index, (SELECT count(*) FROM flags)) > cut THEN 1.0 ELSE 0.0 END END AS prediction
    FROM cell CROSS JOIN cut LEFT JOIN flags ON category = flag"""


@query("score_requests", SQL_SCORED)
def score_requests(spark, sf_dir):
    """Requests of all kinds through a stored model: predictions, and what could not be scored with its reason."""
    lines = table(spark, sf_dir, "lineitem")
    good, bad = score_plan.score_requests(_requests(lines), "request", [], ["l_orderkey", "l_linenumber"], _rule_model(spark, lines), "rule", "Live")
    return good.unionByName(bad, allowMissingColumns=True)


@query("score_batch")
def score_batch(spark, sf_dir):
    """Every document, also those without a label, scored by the model fitted on the labelled ones."""
    before, train_rows, test_rows = _text_features(spark, sf_dir)
    with reused(train_rows) as ready:
        trained = training.train(ready, test_rows, training.Params(), before)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scoring.score(trained.model, documents).select("doc_id", "prediction")


@query(
    "input_example",
    "SELECT n_chars, lang FROM documents ORDER BY doc_id LIMIT 5",
)
def input_example(spark, sf_dir):
    return training.input_example(table(spark, sf_dir, "documents"), "doc_id", ["n_chars", "lang"])
