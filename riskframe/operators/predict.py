"""Decisions from probabilities, and checks of prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.scalars import require_probability
from riskframe.functions.values import (
    finite_or_null,
    is_finite,
    quoted,
    to_number,
    valid_probability,
)

PROBABILITY_COL = "fraud_probability"
DECISION_COL = "fraud_prediction"
THRESHOLD_COL = "threshold"


class PredictionError(ValueError):
    """A prediction table does not follow its own threshold or range."""


def decide(
    df: DataFrame,
    threshold: float,
    override: float | None = None,
    probability_col: str = PROBABILITY_COL,
    decision_col: str = DECISION_COL,
    threshold_col: str = THRESHOLD_COL,
) -> DataFrame:
    """Append the 0/1 decision and the threshold it used; ``override`` replaces the default."""
    used = float(threshold if override is None else override)
    return df.withColumn(
        decision_col, (quoted(probability_col) >= F.lit(used)).cast("int")
    ).withColumn(threshold_col, F.lit(used))


def close_to(value: Column, target: float) -> Column:
    """Equality within 1e-8 plus a relative 1e-5."""
    return F.abs(value - F.lit(target)) <= F.lit(1e-8 + 1e-5 * abs(target))


def prediction_violations(
    df: DataFrame,
    threshold: float,
    label_col: str | None = None,
    probability_col: str = PROBABILITY_COL,
    decision_col: str = DECISION_COL,
    threshold_col: str = THRESHOLD_COL,
) -> DataFrame:
    """One row of counts; a sound table has zeros everywhere but ``row_count`` and classes."""
    schema = df.schema
    p = to_number(quoted(probability_col), schema[probability_col].dataType)
    d = to_number(quoted(decision_col), schema[decision_col].dataType)
    t = to_number(quoted(threshold_col), schema[threshold_col].dataType)
    expected = F.when(p >= F.lit(threshold), 1.0).otherwise(0.0)
    measures = [
        F.count("*").alias("row_count"),
        F.count_if(~valid_probability(p)).alias("invalid_probabilities"),
        F.count_if(~F.coalesce(d == expected, F.lit(False))).alias("inconsistent_decisions"),
        F.count_if(~(is_finite(t) & F.coalesce(close_to(t, threshold), F.lit(False)))).alias(
            "wrong_thresholds"
        ),
    ]
    if label_col is not None:
        label = quoted(label_col)
        measures += [
            F.count_if(F.coalesce(label == 1, F.lit(False))).alias("positives"),
            F.count_if(F.coalesce(label == 0, F.lit(False))).alias("negatives"),
        ]
    return df.agg(*measures)


def check_predictions(
    df: DataFrame, threshold: float, label_col: str | None = None, rows: int | None = None, **names
) -> None:
    require_probability(threshold, "threshold")
    wanted = [
        names.get("probability_col", PROBABILITY_COL),
        names.get("decision_col", DECISION_COL),
        names.get("threshold_col", THRESHOLD_COL),
    ]
    absent = sorted(set(wanted) - set(df.columns))
    if absent:
        raise PredictionError(f"prediction table lacks columns {absent}")
    found = prediction_violations(df, threshold, label_col, **names).first()
    if rows is not None and found.row_count != rows:
        raise PredictionError(f"expected {rows} predictions, found {found.row_count}")
    for name in ("invalid_probabilities", "inconsistent_decisions", "wrong_thresholds"):
        if found[name]:
            raise PredictionError(f"{found[name]} rows with {name.replace('_', ' ')}")
    if label_col is not None and not (found.positives and found.negatives):
        raise PredictionError("evaluation needs both label classes")


def align_predictions(
    labels: DataFrame, predictions: DataFrame, id_col: str, label_col: str
) -> DataFrame:
    """Labels beside the predictions of the same ids, one to one.

    An id that is missing on a side or repeated stops the job, whatever columns are read later: the
    check decides which rows there are. Counting and joining share one shuffle of each side.
    """
    same_id = Window.partitionBy(quoted(id_col))
    wanted = labels.select(
        quoted(id_col).alias("_id"),
        quoted(label_col).alias("_label"),
        F.count("*").over(Window.partitionBy(quoted(id_col))).alias("_labels"),
    )
    given = predictions.withColumn("_predictions", F.count("*").over(same_id))
    fits = (F.col("_labels") == 1) & (F.col("_predictions") == 1)
    refused = F.raise_error(
        F.concat(
            F.lit("labels and predictions do not align at id "),
            F.coalesce(F.col("_id").cast("string"), quoted(id_col).cast("string"), F.lit("null")),
        )
    )
    both = wanted.join(given, F.col("_id") == quoted(id_col), "full")
    sound = F.coalesce(fits, F.lit(False))
    return both.where(F.when(sound, True).otherwise(refused.cast("boolean"))).select(
        quoted(id_col),
        F.col("_label").alias(label_col),
        *[quoted(c) for c in predictions.columns if c not in (id_col, label_col)],
    )


def alignment(labels: DataFrame, predictions: DataFrame, id_col: str) -> DataFrame:
    """One row: labelled ids without prediction, predicted ids without label, repeated ids."""
    sides = (
        labels.select(quoted(id_col), F.lit(1).alias("l"), F.lit(0).alias("p"))
        .unionByName(predictions.select(quoted(id_col), F.lit(0).alias("l"), F.lit(1).alias("p")))
        .groupBy(id_col)
        .agg(F.sum("l").alias("l"), F.sum("p").alias("p"))
    )
    return sides.agg(
        F.count_if((F.col("l") > 0) & (F.col("p") == 0)).alias("without_prediction"),
        F.count_if((F.col("p") > 0) & (F.col("l") == 0)).alias("without_label"),
        F.count_if((F.col("l") > 1) | (F.col("p") > 1)).alias("repeated"),
    )


def check_alignment(labels: DataFrame, predictions: DataFrame, id_col: str) -> None:
    """Every labelled row has exactly one prediction and the other way round."""
    found = alignment(labels, predictions, id_col).first()
    if found.without_prediction or found.without_label or found.repeated:
        raise PredictionError(f"labels and predictions do not align: {found.asDict()}")


def finite_output(df: DataFrame) -> DataFrame:
    """NaN and infinities to NULL in every double column before a strict JSON write."""
    return df.select(
        *[
            finite_or_null(quoted(c)).alias(c) if kind in ("double", "float") else quoted(c)
            for c, kind in df.dtypes
        ]
    )
