"""Exact classification metrics from one pre-aggregated score curve.

Rows collapse to one per distinct score before anything is ordered, so a score shared by a
third of all rows is one row of the curve. Every metric is an aggregate over that curve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalars import clip, ratio_or_zero, require_cost
from riskframe.functions.values import quoted
from riskframe.operators.order import bucket_count, quantile_splits, running_totals

# Fixed value: double machine epsilon, the clip applied before the logarithm.
LOG_EPSILON = 2.220446049250313e-16


def sound_label(label_col: str) -> Column:
    """The label as 0 or 1; anything else stops the job instead of leaving the metrics."""
    label = quoted(label_col).cast("double")
    refused = F.raise_error(F.lit(f"labels in {label_col} must be 0 or 1")).cast("int")
    return F.when(label.isin(0.0, 1.0), label.cast("int")).otherwise(refused)


def sound_score(score_col: str) -> Column:
    """The score as a double; NULL, NaN and infinities stop the job."""
    score = quoted(score_col).cast("double")
    refused = F.raise_error(F.lit(f"scores in {score_col} must be finite")).cast("double")
    known = score.isNotNull() & ~F.isnan(score) & (F.abs(score) < F.lit(float("inf")))
    return F.when(known, score).otherwise(refused)


def score_counts(
    df: DataFrame, label_col: str, score_col: str, groups: Sequence[str] = ()
) -> DataFrame:
    """``groups, score, pos, neg``: one row per distinct score."""
    rows = df.select(
        *[quoted(g).alias(g) for g in groups],
        sound_score(score_col).alias("score"),
        sound_label(label_col).alias("label"),
    )
    return rows.groupBy(*groups, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def score_sketch(counts: DataFrame) -> tuple[list[float], int, int]:
    """Bucket bounds, positives and negatives from ``score_counts``.

    The bounds are quantiles of distinct scores, which is what the buckets will hold: a score
    shared by nearly all rows takes one place among them.
    """
    splits, _, totals = quantile_splits(
        counts,
        F.col("score"),
        bucket_count(counts),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("p"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n"),
    )
    return splits, totals.p, totals.n


def curve_of(
    counts: DataFrame, groups: Sequence[str] = (), splits: Sequence[float] | None = None
) -> DataFrame:
    """The curve of ``score_counts``; ``splits`` are bounds the caller has already."""
    bounds = score_sketch(counts)[0] if splits is None else splits
    curve = running_totals(
        counts.withColumn("distinct", F.lit(1)),
        "score",
        ["pos", "neg", "distinct"],
        list(groups),
        bounds,
    )
    return curve.drop("distinct").select(
        "*",
        (F.col("pos_above") + F.col("pos")).alias("tp"),
        (F.col("neg_above") + F.col("neg")).alias("fp"),
    )


def score_curve(
    df: DataFrame, label_col: str, score_col: str, groups: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct score with the confusion counts of "score >= this one".

    Adds ``pos_above``, ``neg_above`` (strictly higher scores), ``distinct_above``, ``tp``, ``fp``.
    """
    return curve_of(score_counts(df, label_col, score_col, groups), groups)


def precision_recall_curve(
    df: DataFrame, label_col: str, score_col: str, groups: Sequence[str] = ()
) -> DataFrame:
    """``groups, score, tp, fp, precision`` per distinct score; recall is tp over all positives."""
    return score_curve(df, label_col, score_col, groups).select(
        *groups,
        "score",
        "tp",
        "fp",
        ratio_or_zero(F.col("tp").cast("double"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def confusion(predicted: Column, label: Column) -> list[Column]:
    """Four counts with the label set fixed to {0, 1}."""
    return [
        F.count_if(~predicted & (label == 0)).alias("tn"),
        F.count_if(predicted & (label == 0)).alias("fp"),
        F.count_if(~predicted & (label == 1)).alias("fn"),
        F.count_if(predicted & (label == 1)).alias("tp"),
    ]


def confusion_metrics(
    df: DataFrame,
    label_col: str,
    score_col: str,
    threshold: float = 0.5,
    fn_cost: float | None = None,
    fp_cost: float | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Threshold-dependent metrics only: one aggregate, no curve."""
    predicted = sound_score(score_col) >= F.lit(threshold)
    label = sound_label(label_col)
    counted = df.groupBy(*groups).agg(
        *confusion(predicted, label), F.count("*").alias("n_samples")
    )
    return with_rates(counted, fn_cost, fp_cost)


def with_rates(
    counted: DataFrame, fn_cost: float | None = None, fp_cost: float | None = None
) -> DataFrame:
    """Precision, recall, F1 (0 where undefined) and, with both costs, the expected cost."""
    if (fn_cost is None) != (fp_cost is None):
        raise ValueError("fn_cost and fp_cost must be given together")
    tp, fp, fn = F.col("tp").cast("double"), F.col("fp"), F.col("fn")
    out = counted.select(
        "*",
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"),
    )
    if fn_cost is None or fp_cost is None:
        return out
    cost = F.col("fn") * F.lit(require_cost(fn_cost, "fn_cost")) + F.col("fp") * F.lit(
        require_cost(fp_cost, "fp_cost")
    )
    return out.select(
        "*",
        cost.alias("expected_cost"),
        F.try_divide(cost, F.col("n_samples")).alias("expected_cost_per_sample"),
    )


def compute_metrics(
    df: DataFrame,
    label_col: str,
    score_col: str,
    threshold: float | str = 0.5,
    fn_cost: float | None = None,
    fp_cost: float | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """All metrics, one row per group. ``threshold`` is a number or a column constant per group.

    Scores that are not finite and labels other than 0 and 1 stop the job. ROC-AUC, average precision and
    log loss are NULL where a group holds a single class.
    """
    if isinstance(threshold, str):
        keys = [*groups, threshold]
        limit = quoted(threshold)
    else:
        keys = list(groups)
        limit = F.lit(float(threshold))
    curve = score_curve(df, label_col, score_col, keys)
    score, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    flagged = score >= limit
    # Twice the pairs ranked right (ties count one half), in exact integers.
    pairs = neg.cast("decimal(18,0)") * (2 * F.col("pos_above") + pos).cast("decimal(19,0)")
    safe = clip(score, LOG_EPSILON, 1.0 - LOG_EPSILON)
    zero = F.lit(0)
    sums = curve.groupBy(*keys).agg(
        F.sum(pos).alias("p"),
        F.sum(neg).alias("n"),
        F.sum(F.when(~flagged, neg).otherwise(zero)).alias("tn"),
        F.sum(F.when(flagged, neg).otherwise(zero)).alias("fp"),
        F.sum(F.when(~flagged, pos).otherwise(zero)).alias("fn"),
        F.sum(F.when(flagged, pos).otherwise(zero)).alias("tp"),
        F.sum(pairs).cast("double").alias("pairs"),
        F.sum(
            F.when(pos > 0, pos * (F.col("tp") / (F.col("tp") + F.col("fp")))).otherwise(0.0)
        ).alias("gain"),
        F.sum(pos * F.pow(1.0 - score, F.lit(2.0)) + neg * F.pow(score, F.lit(2.0))).alias("sq"),
        F.sum(-pos * F.ln(safe) - neg * F.ln(1.0 - safe)).alias("ll"),
    )
    total = F.col("p") + F.col("n")
    both = (F.col("p") > 0) & (F.col("n") > 0)
    area = F.col("pairs") / (2.0 * F.col("p").cast("double") * F.col("n"))
    counted = sums.select(
        *keys,
        F.when(both, area).alias("roc_auc"),
        F.when(both, F.col("gain") / F.col("p")).alias("pr_auc"),
        F.when(both, F.col("ll") / total).alias("log_loss"),
        F.try_divide("sq", total).alias("brier_score"),
        F.try_divide(F.col("p").cast("double"), total).alias("base_rate"),
        total.alias("n_samples"),
        "tn",
        "fp",
        "fn",
        "tp",
        *([] if isinstance(threshold, str) else [limit.alias("threshold")]),
    )
    return with_rates(counted, fn_cost, fp_cost)
