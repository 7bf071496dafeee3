"""Text drift: how well can a classifier tell the two sides apart?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.ranks import area
from plumbline.operators.split import in_share
from plumbline.sources.tables import reused


@dataclass(frozen=True)
class TextRules:
    """``fit_rows`` bounds the texts that the classifier is fitted on, about; all held-out texts judge it."""

    buckets: int = 1 << 16
    test_share: float = 0.5
    seed: int = 42
    penalty: float = 0.01
    iterations: int = 50
    fit_rows: int = 200_000


def domain_auc(
    df: DataFrame, column: str, flag: str = "is_ref", rules: TextRules = TextRules()
) -> float | None:
    """Area under the ROC curve of a current-versus-reference classifier on held-out texts.

    Equal texts fall on the same side of the holdout, so copies do not leak into the test.
    ``None`` where either part lacks one of the two sides.
    """
    texts = df.where(F.col(f"`{column}`").isNotNull()).select(
        F.col(f"`{column}`").alias("text"),
        F.when(F.col(flag), 0.0).otherwise(1.0).alias("label"),
        in_share(F.col(f"`{column}`"), rules.test_share, rules.seed).alias("held_out"),
    )
    sides = texts.groupBy("held_out").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).collect()
    if len(sides) < 2 or any(row.low == row.high for row in sides):
        return None
    to_fit = sum(row.n for row in sides if not row.held_out)
    drawn = in_share(F.col("text"), min(1.0, rules.fit_rows / to_fit), rules.seed + 1)
    words = Pipeline(
        stages=[
            Tokenizer(inputCol="text", outputCol="words"),
            HashingTF(inputCol="words", outputCol="features", numFeatures=rules.buckets),
        ]
    ).fit(texts)
    with reused(words.transform(texts.where(~F.col("held_out") & drawn)).select("label", "features")) as ready:
        model = LogisticRegression(
            regParam=rules.penalty, maxIter=rules.iterations, standardization=False
        ).fit(ready)
    # the score is the margin: unlike the probability it doesn't run into 0 or 1
    scored = model.transform(words.transform(texts.where("held_out")).select("label", "features"))
    return area(scored.select(vector_to_array("rawPrediction")[1].alias("score"), (F.col("label") == 1).alias("is_current")), "score", "is_current")
