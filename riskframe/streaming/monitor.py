"""Windowed counters, rates, alerts and drift over arriving data.

Every function but the ``start_`` ones takes a batch or a streaming table alike; the watermark bounds
the state of a stream and changes nothing in batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.functions.scalars import status
from riskframe.functions.values import is_measured, quoted
from riskframe.operators.drift import (
    BUCKETED,
    CONSTANT,
    NUMERIC,
    ReferenceState,
    numeric_columns,
    total_variation,
)
from riskframe.operators.records import code_label
from riskframe.plans.drift_report import run_drift

# Upper bounds of the request-size histogram.
SIZE_BOUNDS = (1, 2, 5, 10, 25, 50, 100, 250, 500)


def _windowed(
    df: DataFrame, time_col: str, length: str, slide: str | None, late: str, *keys: Column
):
    marked = df.withWatermark(time_col, late)
    span = F.window(time_col, length, slide) if slide else F.window(time_col, length)
    return marked.groupBy(span.alias("w"), *keys)


def _flat(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "w"]
    return df.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest
    )


def prediction_counters(
    predictions: DataFrame,
    time_col: str,
    decision_col: str,
    length: str = "10 minutes",
    slide: str | None = None,
    late: str = "10 minutes",
) -> DataFrame:
    """Predictions, flagged predictions and flagged rate per window."""
    flagged = F.count_if(quoted(decision_col) == 1)
    return _flat(
        _windowed(predictions, time_col, length, slide, late).agg(
            F.count("*").alias("predictions"),
            flagged.alias("flagged"),
            (flagged / F.count("*")).alias("flagged_rate"),
        )
    )


def flagged_rate(predictions: DataFrame, time_col: str, decision_col: str) -> DataFrame:
    """Rolling flagged rate over one hour, moved every five minutes."""
    return prediction_counters(predictions, time_col, decision_col, "1 hour", "5 minutes")


def reject_counters(
    issues: DataFrame, time_col: str, length: str = "10 minutes", late: str = "10 minutes"
) -> DataFrame:
    """Rejections per window and bounded code label."""
    label = code_label(F.col("code")).alias("label")
    return _flat(
        _windowed(issues, time_col, length, None, late, label).agg(F.count("*").alias("rejects"))
    )


def size_bucket(size: Column) -> Column:
    """Smallest histogram bound that holds the request size, NULL above the last."""
    bound = F.lit(None).cast("int")
    for limit in reversed(SIZE_BOUNDS):
        bound = F.when(size <= limit, F.lit(limit)).otherwise(bound)
    return bound


def request_sizes(
    requests: DataFrame,
    time_col: str,
    size_col: str,
    length: str = "10 minutes",
    late: str = "10 minutes",
) -> DataFrame:
    """Requests per window and size bucket."""
    bucket = size_bucket(quoted(size_col)).alias("size_bound")
    return _flat(
        _windowed(requests, time_col, length, None, late, bucket).agg(
            F.count("*").alias("requests")
        )
    )


def service_levels(
    requests: DataFrame,
    time_col: str,
    failed: Column,
    latency_col: str,
    length: str = "5 minutes",
    late: str = "10 minutes",
    digits: int = 3,
) -> DataFrame:
    """Error rate and exact 95th percentile latency per window.

    A window holds one count per distinct latency, rounded to ``digits`` decimals: its state is bounded
    by the range of latencies, not by the requests, and merges across batches.
    """
    return _flat(
        _windowed(requests, time_col, length, None, late).agg(
            F.count("*").alias("requests"),
            (F.count_if(failed) / F.count("*")).alias("error_rate"),
            F.percentile(F.round(quoted(latency_col).cast("double"), digits), 0.95).alias("latency_p95"),
        )
    )


def rejection_alerts(
    requests: DataFrame,
    time_col: str,
    rejected: Column,
    more_than: int = 10,
    share: float = 0.01,
    length: str = "10 minutes",
    late: str = "10 minutes",
) -> DataFrame:
    """Windows whose rejections exceed both a count and a share of the traffic."""
    counted = _windowed(requests, time_col, length, None, late).agg(
        F.count("*").alias("requests"), F.count_if(rejected).alias("rejects")
    )
    return _flat(
        counted.filter(
            (F.col("rejects") > more_than) & (F.col("rejects") > share * F.col("requests"))
        )
    )


def event_alerts(
    events: DataFrame,
    time_col: str,
    kind_col: str,
    more_than: int = 10,
    length: str = "10 minutes",
    late: str = "10 minutes",
) -> DataFrame:
    """Windows in which one kind of failure occurs more often than allowed."""
    counted = _windowed(
        events, time_col, length, None, late, quoted(kind_col).alias(kind_col)
    ).agg(F.count("*").alias("occurrences"))
    return _flat(counted.filter(F.col("occurrences") > more_than))


def start_drift_monitor(
    current: DataFrame, state: ReferenceState, checks_path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Drift checks of every micro-batch against a reference frozen before the stream starts.

    The state holds settled tables only, so no batch goes back to the reference rows.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        kept = batch.persist()
        try:
            checks = run_drift(state, kept, state.contract).checks
            checks.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                f"{checks_path}/batch={batch_id}"
            )
        finally:
            kept.unpersist()

    return (
        current.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


#: Positions of values that have no bucket.
MISSING_AT, INVALID_AT = -1, -2


def _edges_upto(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda e: e <= value))


def window_buckets(
    current: DataFrame,
    state: ReferenceState,
    time_col: str,
    length: str = "1 hour",
    late: str = "10 minutes",
) -> DataFrame:
    """``window_start, window_end, feature, position, row_count`` of the numeric features.

    Counts merge: on a stream the state store holds one per window, feature and bucket, so a window that
    spans micro-batches, late rows included, is counted whole and leaves the store once.
    """
    rules = {r.feature: r for r in state.bins.where(F.col("strategy").isin(*BUCKETED)).collect()}
    cells = []
    for name, value in numeric_columns(current, state.contract):
        if name not in rules:
            continue
        rule = rules[name]
        if rule.strategy == CONSTANT:
            at = F.lit(rule.constant)
            place = F.when(value < at, 0).when(value > at, 2).otherwise(1)
        else:
            edges = F.array(*[F.lit(float(e)) for e in rule.edges]).cast("array<double>")
            place = _edges_upto(edges, value)
        place = F.when(value.isNull(), MISSING_AT).when(is_measured(value), place).otherwise(INVALID_AT)
        cells.append(F.struct(F.lit(name).alias("feature"), place.alias("position")))
    rows = current.select(quoted(time_col).alias("at"), F.explode(F.array(*cells)).alias("cell"))
    flat = rows.select("at", "cell.feature", "cell.position")
    counted = _windowed(flat, "at", length, None, late, F.col("feature"), F.col("position"))
    return _flat(counted.agg(F.count("*").alias("row_count")))


def window_drift(
    counts: DataFrame, state: ReferenceState, warn: float = 0.10, breach: float = 0.20
) -> DataFrame:
    """Distance to the reference and verdict of every window and feature, from ``window_buckets``."""
    keys = ["window_start", "window_end", "feature"]

    def at(position: int) -> Column:
        return F.sum(F.when(F.col("position") == position, F.col("row_count")).otherwise(0))

    seen = counts.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"),
        at(MISSING_AT).alias("missing_count"),
        at(INVALID_AT).alias("invalid_count"),
    )
    expected = state.buckets.where(F.col("kind") == NUMERIC).select(
        "feature", "position", "reference_count"
    )
    # Buckets that a window left empty count as well.
    full = (
        seen.select(*keys)
        .join(expected, "feature")
        .join(counts, [*keys, "position"], "left")
        .select(
            F.struct(*keys).alias("feature"),
            "reference_count",
            F.coalesce("row_count", F.lit(0)).alias("current_count"),
        )
    )
    apart = total_variation(full).select("feature.*", "total_variation")
    verdict = status(F.col("total_variation"), F.lit(float(warn)), F.lit(float(breach)))
    return seen.join(apart, keys).withColumn("status", verdict)


def start_window_drift(
    current: DataFrame,
    state: ReferenceState,
    time_col: str,
    out: str,
    checkpoint: str,
    length: str = "1 hour",
    late: str = "10 minutes",
    warn: float = 0.10,
    breach: float = 0.20,
    **trigger,
) -> StreamingQuery:
    """Judge every event-time window once, when the watermark has passed its end."""

    def judge(closed: DataFrame, batch_id: int) -> None:
        kept = closed.persist()
        try:
            if not kept.isEmpty():
                found = window_drift(kept, state, warn, breach)
                found.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        finally:
            kept.unpersist()

    counts = window_buckets(current, state, time_col, length, late)
    return (
        counts.writeStream.outputMode("append")
        .foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
