"""Structural validation, source audit and split summaries; one aggregate pass each."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.values import is_missing, quoted


class DataValidationError(ValueError):
    """The input does not have the structure the later steps rely on."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def duplicate_count(df: DataFrame, key: str) -> Column:
    """Rows beyond the first of each key; all missing keys count as one key."""
    column = quoted(key)
    missing = is_missing(column, df.schema[key].dataType)
    has_missing = F.coalesce(F.max(missing.cast("int")), F.lit(0))
    distinct = F.count_distinct(F.when(~missing, column))
    return (F.count("*") - distinct - has_missing).cast("long")


def structural_checks(
    df: DataFrame, id_col: str, time_col: str, label_col: str | None = None
) -> DataFrame:
    """One row of violation counts."""
    time = quoted(time_col)
    if isinstance(
        df.schema[time_col].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)
    ):
        negative = time < F.lit("1970-01-01").cast(df.schema[time_col].dataType)
    else:
        negative = time < 0
    measures = [
        F.count("*").alias("row_count"),
        duplicate_count(df, id_col).alias("duplicate_ids"),
        F.count_if(is_missing(quoted(id_col), df.schema[id_col].dataType)).alias("missing_ids"),
        F.count_if(negative).alias("negative_times"),
        F.count_if(is_missing(time, df.schema[time_col].dataType)).alias("missing_times"),
    ]
    if label_col is not None:
        label = quoted(label_col)
        missing = is_missing(label, df.schema[label_col].dataType)
        measures += [
            F.count_if(~missing & ~label.isin(0, 1)).alias("non_binary_labels"),
            F.count_if(missing).alias("missing_labels"),
        ]
    return df.agg(*measures)


def validate_transactions(
    df: DataFrame,
    id_col: str = "TransactionID",
    time_col: str = "TransactionDT",
    amount_col: str | None = "TransactionAmt",
    label_col: str | None = None,
    strict: bool = False,
) -> None:
    """Raise on the first broken rule. ``strict`` also refuses missing ids and times."""
    required = [c for c in (id_col, time_col, amount_col) if c is not None]
    absent = missing_columns(df, required)
    if absent:
        raise DataValidationError(f"missing required columns: {absent}")
    if label_col is not None and label_col not in df.columns:
        raise DataValidationError(f"missing required label column {label_col!r}")
    found = structural_checks(df, id_col, time_col, label_col).first()
    rules = []
    if label_col is not None:
        rules += [
            (found.non_binary_labels, f"{label_col} has values other than 0 and 1"),
            (found.missing_labels, f"{label_col} contains missing values"),
        ]
    rules += [
        (found.duplicate_ids, f"{id_col} has {found.duplicate_ids} duplicate values"),
        (found.negative_times, f"{time_col} contains negative values"),
    ]
    if strict:
        rules += [
            (found.missing_ids, f"{id_col} contains missing values"),
            (found.missing_times, f"{time_col} contains missing values"),
        ]
    for count, message in rules:
        if count:
            raise DataValidationError(message)
    if found.row_count == 0:
        raise DataValidationError("the table is empty")


def require_unique(df: DataFrame, key: str) -> None:
    """Refuse repeated keys, of which a join would make repeated rows."""
    repeated = df.agg(duplicate_count(df, key)).first()[0]
    if repeated:
        raise DataValidationError(f"{repeated} rows repeat a key in {key}")


def null_profile(df: DataFrame) -> DataFrame:
    """``column_name, row_count, missing_count, missing_fraction`` from one wide aggregate."""
    totals = df.agg(
        F.count("*").alias("n"),
        *[
            F.count_if(is_missing(quoted(f.name), f.dataType)).alias(f"m{i}")
            for i, f in enumerate(df.schema.fields)
        ],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing_count"))
            for i, c in enumerate(df.columns)
        ]
    )
    return totals.select("n", F.explode(entries).alias("e")).select(
        F.col("e.column_name"),
        F.col("n").alias("row_count"),
        F.col("e.missing_count"),
        F.try_divide(F.col("e.missing_count"), F.col("n")).alias("missing_fraction"),
    )


def missing_summary(profile: DataFrame) -> DataFrame:
    """Largest missing fraction and the number of fully missing columns."""
    return profile.agg(
        F.max("missing_fraction").alias("max_missing_fraction"),
        F.count_if(F.col("missing_fraction") == 1.0).alias("fully_missing_columns"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return (
        df.groupBy(quoted(key).alias(key))
        .agg(F.count("*").alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def split_summary(df: DataFrame, split: str, time_col: str, label_col: str) -> DataFrame:
    """Rows, time bounds, positives and positive rate of each split."""
    return df.groupBy(split).agg(
        F.count("*").alias("row_count"),
        F.min(time_col).alias("dt_min"),
        F.max(time_col).alias("dt_max"),
        F.sum(quoted(label_col).cast("long")).alias("positives"),
        F.avg(quoted(label_col).cast("double")).alias("positive_rate"),
    )


def time_overlaps(summary: DataFrame, split: str) -> DataFrame:
    """Add ``overlaps``: the split starts before the previous one ended (ties are fine).

    ``summary`` has one row per split, so the single ordered window is a handful of rows.
    """
    ordered = Window.orderBy("dt_min", "dt_max")
    return summary.withColumn(
        "overlaps",
        F.coalesce(F.col("dt_min") < F.lag("dt_max").over(ordered), F.lit(False)),
    ).select(split, "dt_min", "dt_max", "overlaps")


def reserve_columns(summary: DataFrame, split: str, reserved: str) -> DataFrame:
    """Withhold everything but the row count of a reserved split."""
    hidden = F.col(split) == reserved
    kept = (split, "row_count")
    return summary.select(
        *[c if c in kept else F.when(~hidden, F.col(c)).alias(c) for c in summary.columns],
        hidden.alias("reserved"),
    )
