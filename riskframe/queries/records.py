"""Record validation, windowed counters and the training job."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.values import quoted
from riskframe.operators import records
from riskframe.plans.train import TrainingConfig, run_training
from riskframe.queries.base import rounded, scored_events, table
from riskframe.queries.features import transactions
from riskframe.streaming import monitor

CONTRACT = records.RecordContract(("amount", "k"), ("kind",))


def json_records(spark, folder):
    """Records spelled from the events: numbers, numeric text, bad text, null, nested values."""
    user = F.col("user_id").cast("string")
    amount = (
        F.when(F.col("event_type") == "click", user)
        .when(F.col("event_type") == "view", F.concat(F.lit('"'), user, F.lit('"')))
        .when(F.col("event_type") == "error", F.lit('"bad"'))
        .when(F.col("event_type") == "signup", F.lit("null"))
        .otherwise(F.lit("[1]"))
    )
    kind = F.when(F.col("value") < 1.0, F.lit('" "')).when(
        F.col("value") < 2.0, F.lit("true")
    ).when(F.col("value") < 20.0, F.lit("null")).otherwise(F.lit('"new"'))
    text = F.concat(
        F.lit('{"amount": '), amount, F.lit(', "kind": '), kind, F.lit(', "extra": {"a": 1}}')
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("record_id"), "ts", text.alias("record")
    )


def validated(spark, folder):
    return records.validate_records(json_records(spark, folder), CONTRACT)


def record_issues(spark, folder):
    return records.issue_table(validated(spark, folder)).drop("message")


def reject_reasons(spark, folder):
    return (
        validated(spark, folder)
        .filter(~F.col("accepted"))
        .groupBy(records.reason_label(F.col("issues")).alias("reason"))
        .agg(F.count("*").alias("rejects"))
    )


def request_reasons(spark, folder):
    issues = records.issue_table(validated(spark, folder))
    return records.request_reasons(issues, "record_id")


def accepted_records(spark, folder):
    good, _ = records.split_records(validated(spark, folder))
    fields = records.record_fields(good, CONTRACT, ["record_id"])
    return fields.select("record_id", "amount", "kind")


def flagged_events(spark, folder):
    return scored_events(spark, folder).withColumn("flag", (F.col("score") >= 0.5).cast("int"))


def _instants(df, column="ts"):
    return df.withColumn(column, quoted(column).cast("timestamp"))


def _naive(df):
    """Window bounds without zone, like the given tables' times."""
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return df.withColumns(bounds)


def prediction_counters(spark, folder):
    counters = monitor.prediction_counters(
        _instants(flagged_events(spark, folder)), "ts", "flag"
    )
    return _naive(rounded(counters))


def flagged_rate(spark, folder):
    rates = monitor.flagged_rate(_instants(flagged_events(spark, folder)), "ts", "flag")
    return _naive(rounded(rates))


def reject_counters(spark, folder):
    codes = records.issue_table(validated(spark, folder), "ts").select("ts", "code")
    return _naive(monitor.reject_counters(_instants(codes), "ts", "1 day"))


def request_sizes(spark, folder):
    events = table(spark, folder, "events").select(
        "ts", F.get_json_object("props", "$.k").cast("int").alias("size")
    )
    return _naive(monitor.request_sizes(_instants(events), "ts", "size", "1 day"))


def rejection_alerts(spark, folder):
    rows = _instants(validated(spark, folder))
    alerts = monitor.rejection_alerts(rows, "ts", ~F.col("accepted"), length="6 hours")
    return _naive(alerts)


def event_alerts(spark, folder):
    events = _instants(table(spark, folder, "events"))
    return _naive(monitor.event_alerts(events, "ts", "event_type", 10, "6 hours"))


def service_levels(spark, folder):
    events = _instants(table(spark, folder, "events"))
    levels = monitor.service_levels(
        events, "ts", F.col("event_type") == "error", "value", "1 hour"
    )
    return _naive(rounded(levels))


def training_scores(spark, folder):
    """Trains on the events and scores the reserved split."""
    config = TrainingConfig(
        id_col="event_id",
        time_col="ts",
        label_col="label",
        amount_col="amount",
        exclude=("ts",),
        max_distinct=100,
        categorical_strategy="frequency_high_cardinality",
        calibration="sigmoid",
    )
    result = run_training(transactions(spark, folder), config, {"events": "given"})
    final = result.rows.filter(F.col("split") == "final_test").drop("split")
    return result.model.score(final, ["event_id", "label"])


_KIND = """CASE WHEN value < 1 THEN 'invalid_categorical' WHEN value < 2 THEN 'invalid_categorical'
                WHEN value < 20 THEN NULL ELSE 'usable' END"""
_RECORDS = f"""
f AS (
  SELECT event_id AS record_id, ts, event_type, user_id, value,
         CASE event_type WHEN 'click' THEN 'usable' WHEN 'view' THEN 'usable'
              WHEN 'error' THEN 'invalid_numeric' WHEN 'signup' THEN NULL
              ELSE 'non_scalar_feature' END AS amount, {_KIND} AS kind
  FROM events),
issues AS (
  SELECT record_id, ts, 'amount' AS field, amount AS code FROM f WHERE amount <> 'usable'
  UNION ALL SELECT record_id, ts, 'kind', kind FROM f WHERE kind <> 'usable'
  UNION ALL SELECT record_id, ts, NULL, 'no_usable_features' FROM f
  WHERE amount IS NULL AND kind IS NULL),
reasons AS (SELECT record_id, CASE WHEN count(*) = 1 THEN min(code) ELSE 'multiple' END AS reason
            FROM issues GROUP BY record_id)
"""
_FLAGGED = """
p AS (SELECT ts, CAST(value / (value + 50.0::DOUBLE) >= 0.5 AS INTEGER) AS flag FROM events)
"""


def _bucket(length: str, column: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{length}', {column})"


def _span(length: str) -> str:
    return (
        f"{_bucket(length)} AS window_start, "
        f"{_bucket(length)} + INTERVAL '{length}' AS window_end"
    )


QUERIES = {
    "record_issues": (
        record_issues,
        f"WITH {_RECORDS} SELECT record_id, field, code FROM issues",
    ),
    "reject_reasons": (
        reject_reasons,
        f"WITH {_RECORDS} SELECT reason, count(*) AS rejects FROM reasons GROUP BY reason",
    ),
    "request_reasons": (request_reasons, f"WITH {_RECORDS} SELECT record_id, reason FROM reasons"),
    "accepted_records": (
        accepted_records,
        f"""
        WITH {_RECORDS}
        SELECT record_id, CASE WHEN event_type IN ('click', 'view') THEN user_id::VARCHAR END AS amount,
               CASE WHEN value >= 20 THEN 'new' END AS kind
        FROM f WHERE record_id NOT IN (SELECT record_id FROM issues)
        """,
    ),
    "prediction_counters": (
        prediction_counters,
        f"""
        WITH {_FLAGGED}
        SELECT {_span('10 minutes')}, count(*) AS predictions,
               CAST(sum(flag) AS BIGINT) AS flagged, round(avg(flag), 9) AS flagged_rate
        FROM p GROUP BY ALL
        """,
    ),
    "flagged_rate": (
        flagged_rate,
        f"""
        WITH {_FLAGGED}, w AS (
          SELECT {_bucket('5 minutes')} - INTERVAL '5 minutes' * i AS s, flag
          FROM p, range(12) t(i))
        SELECT s AS window_start, (s + INTERVAL '1 hour') AS window_end,
               count(*) AS predictions, CAST(sum(flag) AS BIGINT) AS flagged,
               round(avg(flag), 9) AS flagged_rate FROM w GROUP BY s
        """,
    ),
    "reject_counters": (
        reject_counters,
        f"""
        WITH {_RECORDS}
        SELECT {_span('1 day')}, code AS label, count(*) AS rejects FROM issues GROUP BY ALL
        """,
    ),
    "request_sizes": (
        request_sizes,
        f"""
        WITH q AS (SELECT ts, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
        SELECT {_span('1 day')},
               CAST(list_min(list_filter([1, 2, 5, 10, 25, 50, 100, 250, 500], lambda x: x >= k))
                    AS INTEGER) AS size_bound, count(*) AS requests FROM q GROUP BY ALL
        """,
    ),
    "rejection_alerts": (
        rejection_alerts,
        f"""
        WITH {_RECORDS}, a AS (
          SELECT ts, record_id IN (SELECT record_id FROM issues) AS bad FROM f)
        SELECT {_span('6 hours')}, count(*) AS requests, count(*) FILTER (bad) AS rejects
        FROM a GROUP BY ALL
        HAVING count(*) FILTER (bad) > 10 AND count(*) FILTER (bad) > 0.01 * count(*)
        """,
    ),
    "event_alerts": (
        event_alerts,
        f"""
        SELECT {_span('6 hours')}, event_type, count(*) AS occurrences
        FROM events GROUP BY ALL HAVING count(*) > 10
        """,
    ),
    "service_levels": (
        service_levels,
        f"""
        SELECT {_span('1 hour')}, count(*) AS requests,
               round(count(*) FILTER (event_type = 'error')::DOUBLE / count(*)::DOUBLE, 9) AS error_rate,
               round(quantile_cont(value, 0.95), 9) AS latency_p95
        FROM events GROUP BY ALL
        """,
    ),
    "training_scores": (training_scores, None),
}
