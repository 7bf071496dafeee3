"""The drift report: role and test per column, verdict per column, summary per table."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators import categories, distribution
from plumbline.operators.roles import (
    CATEGORICAL,
    NUMERIC,
    TEXT,
    RoleRules,
    TableFacts,
    infer_roles,
    settle_distinct,
    table_facts,
)
from plumbline.operators.text_drift import TextRules, domain_auc

KS, WASSERSTEIN = "ks", "wasserstein"
CHI_SQUARE, PROPORTION_Z, JENSEN_SHANNON = "chi_square", "proportion_z", "jensen_shannon"
DOMAIN_CLASSIFIER = "domain_classifier"


@dataclass(frozen=True)
class DriftRules:
    """Which test, and when it calls a column drifted.  All assumed defaults."""

    small_reference: int = 1000
    p_threshold: float = 0.05
    distance_threshold: float = 0.1
    auc_threshold: float = 0.55
    dataset_share: float = 0.5
    # number columns of at most so many pairs of values have exact p-values
    exact_pairs: int = 0
    roles: RoleRules = field(default_factory=RoleRules)
    text: TextRules = field(default_factory=TextRules)


def choose_tests(
    roles: Mapping[str, str], facts: TableFacts, rules: DriftRules = DriftRules()
) -> dict[str, str]:
    """Tests with p-values for a small reference side, distances for a large one."""
    small = facts.n_ref <= rules.small_reference
    chosen = {}
    for name, role in roles.items():
        if role == TEXT:
            chosen[name] = DOMAIN_CLASSIFIER
        elif role == NUMERIC:
            chosen[name] = KS if small else WASSERSTEIN
        elif not small:
            chosen[name] = JENSEN_SHANNON
        else:
            two_valued = facts.columns[name].distinct <= 2
            chosen[name] = PROPORTION_Z if two_valued else CHI_SQUARE
    return chosen


def _judged(
    tested: DataFrame, kind: str, chosen: Mapping[str, str], rules: DriftRules
) -> DataFrame:
    """Report rows; a column with an empty side has no statistic and counts as stable."""
    pairs = [F.lit(part) for pair in chosen.items() for part in pair]
    method = F.element_at(F.create_map(*pairs), F.col("column"))
    with_p = method.isin(KS, CHI_SQUARE, PROPORTION_Z)
    by_auc = method == DOMAIN_CLASSIFIER
    drifted = (
        F.when(with_p, F.col("p_value") < rules.p_threshold)
        .when(by_auc, F.col("statistic") > rules.auc_threshold)
        .otherwise(F.col("statistic") >= rules.distance_threshold)
    )
    threshold = (
        F.when(with_p, rules.p_threshold)
        .when(by_auc, rules.auc_threshold)
        .otherwise(rules.distance_threshold)
    )
    return tested.select(
        "column",
        F.lit(kind).alias("kind"),
        method.alias("method"),
        "statistic",
        "p_value",
        threshold.alias("threshold"),
        F.coalesce(drifted, F.lit(False)).alias("drifted"),
        "n_ref",
        "n_cur",
    )


def drift_report(
    df: DataFrame,
    columns: Sequence[str],
    flag: str = "is_ref",
    rules: DriftRules = DriftRules(),
) -> DataFrame:
    """One row per tested column of ``df``, whose ``flag`` marks the reference side.

    Scans: one for sizes, roles and bucket edges, one for all category columns and one for all
    number columns; few-valued columns are counted once more, and a text column adds its
    classifier's own passes.
    """
    names = list(columns)
    n_rows = df.count()
    n_edges = distribution.edges_for(n_rows)
    facts = table_facts(df, names, flag, n_edges)
    facts = settle_distinct(df, facts, rules.roles)
    roles = infer_roles(facts, rules.roles)
    tests = choose_tests(roles, facts, rules)
    small = facts.n_ref <= rules.small_reference

    parts: list[DataFrame] = []
    numeric = [name for name, role in roles.items() if role == NUMERIC]
    if numeric:
        ranges = distribution.ranges_of(facts, numeric, n_edges)
        distances = distribution.numeric_distances(df, numeric, flag, ranges=ranges)
        tested = distribution.kolmogorov_smirnov(distances, rules.exact_pairs) if small else distribution.normed_wasserstein(distances)
        parts.append(_judged(tested, NUMERIC, tests, rules))
    categorical = [name for name, role in roles.items() if role == CATEGORICAL]
    if categorical:
        measures = categories.category_measures(categories.category_counts(df, categorical, flag))
        shape = categories.two_valued_or_not if small else categories.jensen_shannon
        parts.append(_judged(shape(measures), CATEGORICAL, tests, rules))
    texts = [name for name, role in roles.items() if role == TEXT]
    if texts:
        rows = [
            (name, domain_auc(df, name, flag, rules.text), None, c.n_ref, c.n_cur)
            for name, c in ((name, facts.columns[name]) for name in texts)
        ]
        scores = df.sparkSession.createDataFrame(
            rows, "column string, statistic double, p_value double, n_ref bigint, n_cur bigint"
        )
        parts.append(_judged(scores, TEXT, tests, rules))
    if not parts:
        return df.sparkSession.createDataFrame([], schemas.DRIFT_COLUMN)
    return functools.reduce(DataFrame.unionByName, parts)


def drift_summary(report: DataFrame, dataset_share: float = 0.5) -> DataFrame:
    """How many of the tested columns drifted, and whether that makes the table drift."""
    counted = report.agg(
        F.count(F.lit(1)).cast("int").alias("n_columns"),
        F.count_if("drifted").cast("int").alias("drifted_count"),
    )
    share = F.coalesce(F.try_divide("drifted_count", "n_columns"), F.lit(0.0))
    return counted.select(
        "n_columns",
        "drifted_count",
        share.alias("drifted_share"),
        ((share >= dataset_share) & (F.col("n_columns") > 0)).alias("dataset_drift"),
    )
