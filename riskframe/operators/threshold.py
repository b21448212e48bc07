"""Decision-threshold selection from the score curve."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.local import local_rows
from riskframe.functions.scalars import evenly_spaced, ratio_or_zero, require_cost
from riskframe.functions.values import quoted
from riskframe.operators.metrics import (
    curve_of,
    score_counts,
    score_sketch,
    sound_label,
    sound_score,
)

STRATEGIES = ("fixed", "best_f1", "target_recall", "cost_based")
RESULT = (
    "strategy string, threshold double, expected_cost double, "
    "false_negative_cost double, false_positive_cost double"
)


def select_threshold(
    df: DataFrame,
    label_col: str,
    score_col: str,
    strategy: str = "best_f1",
    fixed_threshold: float = 0.5,
    target_recall: float = 0.80,
    fn_cost: float = 25.0,
    fp_cost: float = 1.0,
    candidates: int | None = None,
) -> DataFrame:
    """One row: strategy, threshold and its expected cost. Scores are probabilities in [0, 1].

    * ``best_f1``: highest F1, lowest threshold on ties
    * ``target_recall``: highest threshold that still reaches the recall, 0.0 if none does
    * ``cost_based``: cheapest of all distinct scores, lowest threshold on ties; with
      ``candidates`` the cheapest of that many evenly spaced quantiles of the distinct scores
    """
    require_cost(fn_cost, "fn_cost")
    require_cost(fp_cost, "fp_cost")
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown threshold strategy {strategy!r}; use one of {STRATEGIES}")
    if strategy == "fixed":
        flagged = sound_score(score_col) >= F.lit(float(fixed_threshold))
        label = sound_label(label_col)
        picked = df.agg(
            F.count_if(label == 1).alias("p"),
            F.lit(float(fixed_threshold)).alias("threshold"),
            F.count_if(flagged & (label == 1)).alias("tp"),
            F.count_if(flagged & (label == 0)).alias("fp"),
        )
    elif strategy == "cost_based" and candidates is not None:
        return _cheapest_of(df, label_col, score_col, fn_cost, fp_cost, candidates)
    else:
        counts = score_counts(df, label_col, score_col)
        splits, positives, negatives = score_sketch(counts)
        curve = curve_of(counts, splits=splits)
        if strategy == "cost_based":
            picked = cheapest(curve, positives, fn_cost, fp_cost)
        elif strategy == "best_f1":
            picked = best_f1(curve, positives)
        else:
            picked = highest_with_recall(curve, positives, negatives, target_recall)
    cost = (F.col("p") - F.col("tp")) * F.lit(float(fn_cost)) + F.col("fp") * F.lit(float(fp_cost))
    return picked.select(
        F.lit(strategy).alias("strategy"),
        "threshold",
        cost.alias("expected_cost"),
        F.lit(float(fn_cost)).alias("false_negative_cost"),
        F.lit(float(fp_cost)).alias("false_positive_cost"),
    )


def best_f1(curve: DataFrame, positives: int) -> DataFrame:
    """Arg-max by aggregate, not by sorting the curve. 0.5 when there are no scores."""
    f1 = ratio_or_zero(2.0 * F.col("tp"), positives + F.col("tp") + F.col("fp"))
    best = curve.agg(
        F.max(
            F.struct(f1.alias("f1"), (-F.col("score")).alias("low"), "score", "tp", "fp")
        ).alias("b")
    )
    return best.select(
        F.lit(positives).alias("p"),
        F.coalesce(F.col("b.score"), F.lit(0.5)).alias("threshold"),
        F.coalesce(F.col("b.tp"), F.lit(0)).alias("tp"),
        F.coalesce(F.col("b.fp"), F.lit(0)).alias("fp"),
    )


def highest_with_recall(
    curve: DataFrame, positives: int, negatives: int, target: float
) -> DataFrame:
    recall = F.lit(1.0) if positives == 0 else F.col("tp") / F.lit(positives)
    best = curve.agg(
        F.max(F.when(recall >= F.lit(target), F.struct("score", "tp", "fp"))).alias("b"),
        F.count("*").alias("scores"),
    )
    none = F.when(F.col("scores") > 0, 0.0).otherwise(0.5)
    return best.select(
        F.lit(positives).alias("p"),
        F.coalesce(F.col("b.score"), none).alias("threshold"),
        F.coalesce(F.col("b.tp"), F.lit(positives)).alias("tp"),
        F.coalesce(F.col("b.fp"), F.lit(negatives)).alias("fp"),
    )


def cheapest(curve: DataFrame, positives: int, fn_cost: float, fp_cost: float) -> DataFrame:
    """Arg-min over every point of the curve. 0.5 and no cost when there are no scores."""
    cost = (F.lit(positives) - F.col("tp")) * F.lit(float(fn_cost)) + F.col("fp") * F.lit(
        float(fp_cost)
    )
    best = curve.agg(F.min(F.struct(cost.alias("cost"), "score", "tp", "fp")).alias("b"))
    return best.select(
        F.lit(positives).alias("p"),
        F.coalesce(F.col("b.score"), F.lit(0.5)).alias("threshold"),
        F.col("b.tp").alias("tp"),
        F.col("b.fp").alias("fp"),
    )


def _cheapest_of(
    df: DataFrame,
    label_col: str,
    score_col: str,
    fn_cost: float,
    fp_cost: float,
    candidates: int,
) -> DataFrame:
    """Twice ``candidates`` points of the curve, those the candidates fall between, are read."""
    counts = score_counts(df, label_col, score_col)
    m = counts.count()
    splits, positives, _ = score_sketch(counts)
    threshold, cost = 0.5, None
    if m:
        places = [(m - 1) * q for q in evenly_spaced(candidates)]
        wanted = sorted({i for h in places for i in (math.floor(h), math.ceil(h))})
        index = F.lit(m - 1) - F.col("distinct_above")
        points = {
            r["place"]: r
            for r in curve_of(counts, splits=splits)
            .select(index.alias("place"), "score", "tp", "fp")
            .filter(F.col("place").isin(wanted))
            .collect()
        }
        for h in places:
            low, high = points[math.floor(h)], points[math.ceil(h)]
            candidate = _between(low.score, high.score, h - math.floor(h))
            at = low if candidate <= low.score else high
            total = (positives - at.tp) * fn_cost + at.fp * fp_cost
            if cost is None or total < cost:
                threshold, cost = candidate, float(total)
    row = ("cost_based", float(threshold), cost, float(fn_cost), float(fp_cost))
    return local_rows(df.sparkSession, [row], RESULT)


def _between(low: float, high: float, share: float) -> float:
    if share < 0.5:
        return low + (high - low) * share
    return high - (high - low) * (1.0 - share)
