"""Probability calibration on score-aggregated rows.

Rows with the same raw score weigh in as one, so a hot score never skews the fit. The sigmoid is
Spark ML's logistic regression. The isotonic fit pools adjacent violators in ranges of the score in
parallel: what is pooled inside a range stays pooled in the whole fit, so ranges hand on blocks
only, and ranges whose blocks meet in the wrong order are pooled together until none do. Block
totals are integers, so order is decided exactly, at any distance between scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from riskframe.functions.local import local_rows
from riskframe.functions.scalars import clip, logit
from riskframe.functions.values import quoted
from riskframe.operators.metrics import score_counts, score_sketch
from riskframe.operators.order import bucketise
from riskframe.session import durable

STRATEGIES = ("none", "sigmoid", "isotonic")
BLOCK = "low double, high double, pos bigint, n bigint"
RANGED = f"{BLOCK}, _range int"


@dataclass(frozen=True)
class Calibrator:
    """Fitted probability map; ``none`` passes raw probabilities through."""

    strategy: str
    slope: float = 1.0
    intercept: float = 0.0
    isotonic: IsotonicRegressionModel | None = field(default=None, compare=False)

    def sigmoid(self, raw: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-(F.lit(self.slope) * logit(raw) + F.lit(self.intercept))))

    def apply(self, df: DataFrame, raw_col: str, out_col: str) -> DataFrame:
        if self.strategy == "none":
            return df.withColumn(out_col, quoted(raw_col).cast("double"))
        if self.strategy == "sigmoid":
            return df.withColumn(out_col, clip(self.sigmoid(quoted(raw_col)), 0.0, 1.0))
        model = self.isotonic.copy()
        model.setFeaturesCol("_raw").setPredictionCol("_calibrated")
        scored = model.transform(df.withColumn("_raw", quoted(raw_col).cast("double")))
        return scored.withColumn(out_col, clip(F.col("_calibrated"), 0.0, 1.0)).drop(
            "_raw", "_calibrated"
        )


def fit_calibrator(df: DataFrame, raw_col: str, label_col: str, strategy: str) -> Calibrator:
    """Fit on held-out rows; both classes must be present."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown calibration strategy {strategy!r}; use one of {STRATEGIES}")
    if strategy == "none":
        return Calibrator("none")
    counts = score_counts(df, label_col, raw_col)
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    if not totals.p or not totals.n:
        raise ValueError("calibration needs both label classes")
    if strategy == "sigmoid":
        sides = F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("label"), F.col("pos").cast("double").alias("weight")),
                F.struct(F.lit(0.0).alias("label"), F.col("neg").cast("double").alias("weight")),
            )
        )
        rows = (
            counts.select(
                array_to_vector(F.array(logit(F.col("score")))).alias("features"), sides.alias("s")
            )
            .select("features", "s.label", "s.weight")
            .filter("weight > 0")
        )
        # A unit penalty on the summed loss is 1/n on Spark's mean loss.
        fitted = LogisticRegression(
            weightCol="weight",
            regParam=1.0 / (totals.p + totals.n),
            standardization=False,
            maxIter=200,
            tol=1e-9,
        ).fit(rows)
        slope, intercept = float(fitted.coefficients[0]), float(fitted.intercept)
        if not (math.isfinite(slope) and math.isfinite(intercept)):
            raise ValueError("calibration did not converge to finite coefficients")
        return Calibrator("sigmoid", slope, intercept)
    return Calibrator("isotonic", isotonic=_as_model(isotonic_blocks(counts)))


def pool(blocks: Iterable[tuple[float, float, int, int]]) -> list[tuple[float, float, int, int]]:
    """Pool neighbouring ``low, high, pos, n`` until their positive shares rise strictly."""
    pooled: list[tuple[float, float, int, int]] = []
    for low, high, pos, n in blocks:
        while pooled and pooled[-1][2] * n >= pos * pooled[-1][3]:
            low, _, before, rows = pooled.pop()
            pos, n = pos + before, n + rows
        pooled.append((low, high, pos, n))
    return pooled


def _pooled(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("low")
    rows = pool(zip(*(part[c].tolist() for c in ("low", "high", "pos", "n"))))
    out = pd.DataFrame(rows, columns=["low", "high", "pos", "n"])
    return out.assign(_range=int(part["_range"].iloc[0]))


def _joined_ranges(edges: list[Row]) -> dict[int, int]:
    """Range -> first range of its run; a run ends where the next range starts in order."""
    runs: dict[int, int] = {}
    before = None
    for edge in sorted(edges, key=lambda e: e._range):
        wrong = before is not None and before.last.pos * edge.first.n >= edge.first.pos * before.last.n
        runs[edge._range] = runs[before._range] if wrong else edge._range
        before = edge
    return runs


def isotonic_blocks(counts: DataFrame) -> DataFrame:
    """``low, high, pos, n`` of the isotonic fit to ``score_counts``, shares strictly rising.

    Scores are dealt into ranges by quantiles of the distinct ones. The driver sees the first and
    the last block of every range, so as many rows as there are ranges, and ranges only get fewer.
    """
    splits, _, _ = score_sketch(counts)
    score = F.col("score")
    ranged = bucketise(counts, "score", splits, "_range").select(
        score.alias("low"), score.alias("high"), "pos", (F.col("pos") + F.col("neg")).alias("n"), "_range"
    )
    block = F.struct("pos", "n")
    while True:
        pooled = durable(ranged.groupBy("_range").applyInPandas(_pooled, RANGED))
        edges = (
            pooled.groupBy("_range")
            .agg(F.min_by(block, "low").alias("first"), F.max_by(block, "low").alias("last"))
            .collect()
        )
        runs = _joined_ranges(edges)
        if all(run == own for own, run in runs.items()):
            return pooled.drop("_range")
        moved = local_rows(counts.sparkSession, list(runs.items()), "_range int, _run int")
        ranged = pooled.join(F.broadcast(moved), "_range").select(
            "low", "high", "pos", "n", F.col("_run").alias("_range")
        )


def _as_model(blocks: DataFrame) -> IsotonicRegressionModel:
    """Spark's model over the ends of pooled blocks: they are in order, so it pools nothing more.

    0/1 labels leave at most about n^(2/3) blocks of n rows, and the model holds two points each.
    """
    ends = F.array_distinct(F.array("low", "high"))
    points = blocks.select(
        F.explode(ends).alias("features"),
        (F.col("pos") / F.col("n")).alias("label"),
        (F.col("n") / F.size(ends)).alias("weight"),
    )
    return IsotonicRegression(weightCol="weight").fit(points)
