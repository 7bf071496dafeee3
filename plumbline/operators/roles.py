"""What kind of column is it, and how large is each side: one scan for the whole table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC, CATEGORICAL, TEXT = "num", "cat", "text"

# Partial sketches merge in this many groups before the last merge.
_MERGE_GROUPS = 256
# Columns of at most this many distinct values (by estimate) have them collected in one set.
_SMALL_SET = 1000


@dataclass(frozen=True)
class RoleRules:
    """Assumed defaults; the sources of the rules do not fix them."""

    few_values: int = 5
    text_share: float = 0.5
    include_timestamps: bool = False
    # whether an estimate that is clear of the threshold may decide between text and category
    estimate_texts: bool = False


@dataclass(frozen=True)
class ColumnFacts:
    """What one scan tells about a column; counts are of usable values."""

    name: str
    data_type: T.DataType
    n_ref: int
    n_cur: int
    distinct: int
    edges: tuple[float, ...] = ()
    # values that fill more than one of the quantiles that are the edges
    heavy: tuple[float, ...] = ()


@dataclass(frozen=True)
class TableFacts:
    n_ref: int
    n_cur: int
    columns: dict[str, ColumnFacts]


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def is_time(kind: T.DataType) -> bool:
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))


def can_be_tested(kind: T.DataType) -> bool:
    return is_number(kind) or is_time(kind) or isinstance(kind, (T.StringType, T.BooleanType))


def as_number(name: str, kind: T.DataType) -> Column:
    """The column as a double; timestamps as epoch seconds."""
    column = F.col(f"`{name}`")
    if is_time(kind):
        return (F.unix_micros(column.cast("timestamp")) / F.lit(1e6)).cast("double")
    return column.cast("double")


def usable(number: Column) -> Column:
    """The number, or NULL where it is NaN or infinite."""
    finite = ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(finite, number)


def table_facts(
    df: DataFrame,
    columns: Sequence[str],
    flag: str = "is_ref",
    edges_per_column: int = 0,
    with_distinct: bool = True,
) -> TableFacts:
    """Side sizes, usable values per side, distinct estimates and value quantiles per column.

    Columns of types that no test takes (arrays, maps, structs, bytes) are left out.

    Counters and sketches combine per task, then in groups of tasks, then once more, so that
    no single task merges one sketch per input split.  Quantiles serve as bucket edges, which
    never change a result.  All of it covers all rows.
    """
    # an error of about half a bucket, a whole one for the most edges
    sketch_size = min(8192, max(256, 8 * edges_per_column))
    fields = [df.schema[name] for name in columns if can_be_tested(df.schema[name].dataType)]

    ref, cur = F.col(flag), ~F.col(flag)
    level_1: list[Column] = [F.count_if(ref).alias("n_ref"), F.count_if(cur).alias("n_cur")]
    level_2: list[Column] = [F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")]
    numbers = {}
    for at, field in enumerate(fields):
        value = F.col(f"`{field.name}`")
        if is_number(field.dataType) or is_time(field.dataType):
            value = numbers[at] = usable(as_number(field.name, field.dataType))
        level_1 += [
            F.count(F.when(ref, value)).alias(f"ref_{at}"),
            F.count(F.when(cur, value)).alias(f"cur_{at}"),
        ]
        level_2 += [
            F.sum(f"ref_{at}").alias(f"ref_{at}"),
            F.sum(f"cur_{at}").alias(f"cur_{at}"),
        ]
        if with_distinct:
            hashed = F.when(value.isNotNull(), F.xxhash64(value))
            level_1.append(F.hll_sketch_agg(hashed, 12).alias(f"hll_{at}"))
            merged_sketch = F.hll_union_agg(f"hll_{at}")
            level_2.append(F.hll_sketch_estimate(merged_sketch).alias(f"distinct_{at}"))
        if edges_per_column and at in numbers:
            level_1.append(F.kll_sketch_agg_double(numbers[at], sketch_size).alias(f"kll_{at}"))
            level_2.append(F.kll_merge_agg_double(f"kll_{at}").alias(f"kll_{at}"))
    group = F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("merge_group")
    merged = df.groupBy(group).agg(*level_1).agg(*level_2)
    # one array of ranks, written as text, for all sketches: thousands of literals for each take the driver minutes
    listed = ", ".join(f"{i / (edges_per_column + 1)!r}D" for i in range(1, edges_per_column + 1))
    shown = [F.col(c) for c in merged.columns if not c.startswith("kll_")]
    places = [at for at in numbers if edges_per_column]
    if places:
        ranks = F.expr(f"array({listed})")
        edges_of = lambda k: F.when(F.kll_sketch_get_n_double(k) > 0, F.kll_sketch_get_quantile_double(k, ranks))
        shown.append(F.transform(F.array(*[f"kll_{at}" for at in places]), edges_of).alias("edges"))
    row = merged.select(*shown).first()

    facts = {}
    for at, field in enumerate(fields):
        edges = row["edges"][places.index(at)] if at in places else None
        facts[field.name] = ColumnFacts(
            field.name,
            field.dataType,
            row[f"ref_{at}"] or 0,
            row[f"cur_{at}"] or 0,
            (row[f"distinct_{at}"] or 0) if with_distinct else 0,
            tuple(sorted(set(edges or ()))),
            tuple(sorted(value for value, n in Counter(edges or ()).items() if n > 1)),
        )
    return TableFacts(row["n_ref"] or 0, row["n_cur"] or 0, facts)


def _settled(facts: ColumnFacts, rules: RoleRules) -> bool:
    """Whether the estimate can't be on the wrong side of a threshold that looks at distinct values."""
    if isinstance(facts.data_type, T.StringType):
        filled = facts.n_ref + facts.n_cur
        margin = 0.1 * rules.text_share * filled
        clear = abs(facts.distinct - rules.text_share * filled) > margin
        return rules.estimate_texts and clear and facts.distinct > 20 * rules.few_values + 100
    if is_number(facts.data_type):
        # few values fill as few places of the sketch, whose estimate is then about their number
        return facts.distinct > 20 * rules.few_values + 100
    return True


def settle_distinct(
    df: DataFrame, facts: TableFacts, rules: RoleRules = RoleRules()
) -> TableFacts:
    """Count distinct values exactly wherever the estimate does not settle role and test.

    Columns of few values collect them into one set per task; texts close to the threshold
    are counted with a shuffle.  Texts go by their digests, which are short however long they are.
    """
    unsettled = [f for f in facts.columns.values() if not _settled(f, rules)]
    if not unsettled:
        return facts
    counters = []
    for at, column in enumerate(unsettled):
        value = F.col(f"`{column.name}`")
        if is_number(column.data_type):
            value = usable(as_number(column.name, column.data_type))
        else:
            value = F.md5(value)
        few = column.distinct <= _SMALL_SET
        counter = F.size(F.collect_set(value)).cast("bigint") if few else F.count_distinct(value)
        counters.append(counter.alias(f"d_{at}"))
    counted = df.agg(*counters).first()
    exact = {f.name: replace(f, distinct=counted[f"d_{at}"]) for at, f in enumerate(unsettled)}
    return replace(facts, columns=facts.columns | exact)


def infer_roles(facts: TableFacts, rules: RoleRules = RoleRules()) -> dict[str, str]:
    """Role of each column; columns whose type has none are left out.

    Numbers with few distinct values count as categories.
    """
    roles = {}
    for name, column in facts.columns.items():
        if isinstance(column.data_type, T.BooleanType):
            roles[name] = CATEGORICAL
        elif isinstance(column.data_type, T.StringType):
            filled = column.n_ref + column.n_cur
            roles[name] = TEXT if column.distinct > rules.text_share * filled else CATEGORICAL
        elif is_number(column.data_type):
            roles[name] = CATEGORICAL if column.distinct <= rules.few_values else NUMERIC
        elif is_time(column.data_type) and rules.include_timestamps:
            roles[name] = NUMERIC
    return roles
