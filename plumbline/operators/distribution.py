"""Two-sample distances between number columns, from their distribution functions.

The two empirical distribution functions need the values in order.  The order is built from
buckets of neighbouring values: running sums inside each bucket, and the sums of all earlier buckets added from a
small table.  Any bucket edges give the same result; they are found in levels.  Quantiles of a column are the first
edges; a bucket that still holds too much has a sketch and edges of its own, and so on until every one fits a task.

Columns whose values repeat become counts per distinct value before they are shuffled, so that a
value that fills a third of the table is one row per task.  Columns of nearly unique values would gain nothing
by that: their rows are shuffled once, straight to their buckets, and only values that repeat much are counted before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.tails import kolmogorov_p
from plumbline.operators.roles import TableFacts, as_number, table_facts, usable
from plumbline.session import ensure_checkpoint_dir

# Values per bucket that a running sum handles comfortably in one task.
ROWS_PER_BUCKET = 50_000
# Edges of a column's first level, which the driver holds; further levels lie in a table.
FIRST_EDGES = 4096
# Parts that a bucket which holds too much is cut into, and the size of its sketch.
_PARTS, _SKETCH = 64, 256
# A column is nearly unique if its values occur fewer times than this on average.
_UNIQUE = 4


@dataclass(frozen=True)
class Ranges:
    """First edges per column, which columns are nearly unique and which of their values repeat much, and whether buckets may hold too much."""

    edges: Mapping[str, Sequence[float]] = field(default_factory=dict)
    unique: Mapping[str, Sequence[float]] = field(default_factory=dict)
    refine: bool = False


def edges_for(n_rows: int, per_bucket: int | None = None) -> int:
    """How many first edges a column of this many rows needs."""
    return max(0, min(-(-n_rows // (per_bucket or ROWS_PER_BUCKET)) - 1, FIRST_EDGES))


def ranges_of(facts: TableFacts, columns: Sequence[str], n_edges: int) -> Ranges:
    """What the table's facts say about its number columns."""
    seen = {name: facts.columns[name] for name in columns if name in facts.columns}
    filled = {name: f.n_ref + f.n_cur for name, f in seen.items()}
    unique = {name: f.heavy for name, f in seen.items() if f.distinct * _UNIQUE > filled[name] > 0}
    return Ranges({name: f.edges for name, f in seen.items()}, unique, 0 < FIRST_EDGES <= n_edges)


def _long(df: DataFrame, columns: Sequence[str], edges: Mapping[str, Sequence[float]], flag: str) -> DataFrame:
    """Rows ``column, bucket, x, r, c`` of the values on either side; NULL, NaN and infinite values left out.

    Columns go by their place in ``columns``, which makes shorter shuffle keys than names.
    """
    wide = df.select(
        F.col(flag).alias("_ref"),
        *[usable(as_number(name, df.schema[name].dataType)).alias(f"x{at}") for at, name in enumerate(columns)],
    )
    cut = [at for at, name in enumerate(columns) if len(edges.get(name, ())) > 0]
    if cut:
        infinity = float("inf")
        wide = Bucketizer(
            splitsArray=[[-infinity, *edges[columns[at]], infinity] for at in cut],
            inputCols=[f"x{at}" for at in cut],
            outputCols=[f"b{at}" for at in cut],
            handleInvalid="keep",
        ).transform(wide)
    entries = F.array(
        *[
            F.struct(
                F.lit(at).alias("column"),
                (F.col(f"b{at}") if at in cut else F.lit(0)).cast("bigint").alias("bucket"),
                F.col(f"x{at}").alias("x"),
            )
            for at in range(len(columns))
        ]
    )
    # the bucket is never NULL beside a value; saying so keeps both uses of the counts
    # (running sums and bucket totals) on one shuffle
    rows = wide.select("_ref", F.inline(entries)).where(F.col("x").isNotNull() & F.col("bucket").isNotNull())
    sides = (F.col("_ref"), ~F.col("_ref"))
    return rows.select("column", "bucket", "x", *[F.when(side, 1).otherwise(0).cast("bigint").alias(n) for side, n in zip(sides, "rc", strict=True)])


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("column", "bucket", "x").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def _refined(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows with buckets cut until none holds more than twice ``most`` rows, or only one value does; and which hold one such value.

    Each level sketches the buckets that hold too much, and no others, and joins their edges back, a row per bucket.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    keys = ["column", "bucket"]
    while True:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        large = sizes.where(F.col("n") > 2 * most).checkpoint()
        wide = large.where("low < high").select(*keys, "low", "high")
        if wide.isEmpty():
            return rows, large.select(*keys)
        ranks = F.expr(f"array({', '.join(f'{i / _PARTS!r}D' for i in range(1, _PARTS))})")
        # a sketch per task and bucket, so what is shuffled is sketches
        sketched = rows.join(wide.select(*keys), keys).groupBy(*keys).agg(F.kll_sketch_agg_double("x", _SKETCH).alias("sketch"))
        found = sketched.join(wide, keys).select(
            *keys, "high", F.filter(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", ranks)), lambda e: e > F.col("low")).alias("edges")
        )
        # an edge at least, so that every level ends with smaller buckets
        edges = F.when(F.size("edges") > 0, F.array_sort("edges")).otherwise(F.array("high"))
        index = found.select(*keys, edges.alias("edges")).checkpoint()
        part = F.coalesce(F.size(F.filter("edges", lambda e: e <= F.col("x"))), F.lit(0))
        rows = rows.join(index, keys, "left").select("column", (F.col("bucket") * _PARTS + part).alias("bucket"), "x", "r", "c")


def value_counts(df: DataFrame, columns: Sequence[str], ranges: Ranges, flag: str = "is_ref", most: int | None = None) -> DataFrame:
    """Rows per (column, bucket, value) on either side, dealt out by (column, bucket)."""
    places = {name: at for at, name in enumerate(columns)}
    rows = _long(df, columns, ranges.edges, flag)
    plain = [places[name] for name in ranges.unique if name in places]
    if not plain:
        rows = _counted(rows)
    if ranges.refine or most is not None:
        rows, single = _refined(rows, most or ROWS_PER_BUCKET)
    else:
        single = None
    if plain:
        repeats: Column = ~F.col("column").isin(plain)
        for name, values in ranges.unique.items():
            if name in places and values:
                repeats = repeats | ((F.col("column") == places[name]) & F.col("x").isin([float(v) for v in values]))
        if single is not None:
            flagged = rows.join(single.withColumn("_single", F.lit(True)), ["column", "bucket"], "left")
            rows, repeats = flagged, repeats | F.coalesce("_single", F.lit(False))
        if single is not None or any(ranges.unique.values()) or len(plain) < len(columns):
            rows = rows.where(~repeats).select("column", "bucket", "x", "r", "c").unionByName(_counted(rows.where(repeats)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one shuffle serves the counts of a bucket's values and the running sums over them
    return _counted(rows.repartition(tasks, "column", "bucket"))


def _bucket_offsets(counts: DataFrame) -> DataFrame:
    """Per bucket: what all earlier buckets hold, where the next begins, and column totals."""
    sizes = counts.groupBy("column", "bucket").agg(
        F.sum("r").alias("r"),
        F.sum("c").alias("c"),
        F.sum(F.col("r") * F.col("x")).alias("rx"),
        F.min("x").alias("first_x"),
    )
    whole = Window.partitionBy("column")
    ordered = whole.orderBy("bucket")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "column",
        "bucket",
        F.coalesce(F.sum("r").over(earlier), F.lit(0)).alias("r_before"),
        F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("c_before"),
        F.lead("first_x").over(ordered).alias("next_x"),
        F.sum("r").over(whole).alias("n"),
        F.sum("c").over(whole).alias("m"),
        F.try_divide(F.sum("rx").over(whole), F.sum("r").over(whole)).alias("ref_mean"),
    )


def _distances(counts: DataFrame) -> DataFrame:
    """Per column: largest gap, area between the two functions, spread of the reference side."""
    joined = counts.join(_bucket_offsets(counts), ["column", "bucket"])
    ordered = Window.partitionBy("column", "bucket").orderBy("x")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    ref_share = F.try_divide(F.col("r_before") + F.sum("r").over(upto), F.col("n"))
    cur_share = F.try_divide(F.col("c_before") + F.sum("c").over(upto), F.col("m"))
    steps = joined.select(
        "column",
        "n",
        "m",
        F.abs(ref_share - cur_share).alias("gap"),
        (F.coalesce(F.lead("x").over(ordered), F.col("next_x")) - F.col("x")).alias("width"),
        (F.col("r") * F.pow(F.col("x") - F.col("ref_mean"), 2)).alias("ref_square"),
    )
    return steps.groupBy("column").agg(
        F.max("gap").alias("gap"),
        F.coalesce(F.sum(F.col("gap") * F.col("width")), F.lit(0.0)).alias("area"),
        F.sqrt(F.try_divide(F.sum("ref_square"), F.max("n"))).alias("ref_spread"),
        F.max("n").alias("n_ref"),
        F.max("m").alias("n_cur"),
    )


def numeric_distances(
    df: DataFrame,
    columns: Sequence[str],
    flag: str = "is_ref",
    edges: Mapping[str, Sequence[float]] | None = None,
    least_spread: float = 0.001,
    ranges: Ranges | None = None,
    most: int | None = None,
) -> DataFrame:
    """Kolmogorov-Smirnov and normed Wasserstein distances of every column.

    Columns ``column, ks, wasserstein, n_ref, n_cur``; NULL distances where a side is empty.
    ``ranges``, or ``edges`` alone, are found in a scan of their own if they are not given; ``most`` has
    buckets cut until none holds more than twice as many rows.
    """
    if ranges is None:
        ranges = find_ranges(df, columns, flag) if edges is None else Ranges(edges)
    found = _distances(value_counts(df, columns, ranges, flag, most))
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    spread = F.greatest(F.col("ref_spread"), F.lit(least_spread))
    names = F.array(*[F.lit(name) for name in columns])
    return found.select(
        F.get(names, F.col("column")).alias("column"),
        F.when(both, F.col("gap")).alias("ks"),
        F.when(both, F.col("area") / spread).alias("wasserstein"),
        "n_ref",
        "n_cur",
    )


def find_ranges(df: DataFrame, columns: Sequence[str], flag: str = "is_ref", count: int | None = None) -> Ranges:
    """Quantiles as first edges, as many as the table's size asks for, and which columns are nearly unique."""
    wanted = edges_for(df.count()) if count is None else count
    if wanted == 0:
        return Ranges()
    return ranges_of(table_facts(df, columns, flag, wanted), columns, wanted)


def find_edges(
    df: DataFrame, columns: Sequence[str], flag: str = "is_ref", count: int | None = None
) -> dict[str, tuple[float, ...]]:
    """The first edges per column."""
    return dict(find_ranges(df, columns, flag, count).edges)


def kolmogorov_smirnov(distances: DataFrame, exact_pairs: int = 0) -> DataFrame:
    """Statistic and p-value: asymptotic, or exact where the two sides have at most ``exact_pairs`` pairs of values."""
    sizes = [F.col(n).cast("double") for n in ("n_ref", "n_cur")]
    return distances.select(
        "column",
        F.col("ks").alias("statistic"),
        kolmogorov_p("ks", *sizes, F.lit(float(exact_pairs))).alias("p_value"),
        "n_ref",
        "n_cur",
    )


def normed_wasserstein(distances: DataFrame) -> DataFrame:
    """Area between the distribution functions over the reference side's standard deviation."""
    return distances.select(
        "column",
        F.col("wasserstein").alias("statistic"),
        F.lit(None).cast("double").alias("p_value"),
        "n_ref",
        "n_cur",
    )
