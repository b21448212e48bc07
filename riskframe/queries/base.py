"""Shared inputs of the registered queries and the matching SQL fragments.

Roles played by the given tables: ``events`` are transactions (id, time, amount, category),
``documents`` with sparse ``labels`` are a table with an optional side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 42


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    """Label: the event is an error. Score: the amount squeezed into (0, 1)."""
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        (F.col("event_type") == "error").cast("int").alias("label"),
        (F.col("value") / (F.col("value") + 50.0)).alias("score"),
    )


SCORED = """
scored AS (
  SELECT event_id, ts, CAST(event_type = 'error' AS INTEGER) AS label,
         value / (value + 50.0::DOUBLE) AS score
  FROM events)
"""

THREE_WAY = """
sized AS (SELECT count(*) AS n FROM events),
cuts AS (
  SELECT CAST(round_even(n * 0.7::DOUBLE, 0) AS BIGINT) AS a,
         CAST(round_even(n * 0.15::DOUBLE, 0) AS BIGINT) AS b FROM sized),
placed AS (
  SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r FROM scored),
split AS (
  SELECT p.* EXCLUDE (r),
         CASE WHEN r <= a THEN 'train' WHEN r <= a + b THEN 'validation' ELSE 'test' END AS split
  FROM placed p, cuts)
"""

FIVE_WAY = """
sized AS (SELECT count(*) AS n FROM events),
cuts AS (
  SELECT CAST(round_even(n * 0.7::DOUBLE, 0) AS BIGINT) AS a,
         CAST(round_even(n * 0.15::DOUBLE, 0) AS BIGINT) AS b FROM sized),
half AS (
  SELECT a, b, greatest(1, least(b - 1, CAST(round_even(b * 0.5::DOUBLE, 0) AS BIGINT))) AS d
  FROM cuts),
quarter AS (
  SELECT a, b, d, greatest(1, least(d - 1, CAST(round_even(d * 0.5::DOUBLE, 0) AS BIGINT))) AS c
  FROM half),
placed AS (
  SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r FROM scored),
split AS (
  SELECT p.* EXCLUDE (r),
         CASE WHEN r <= a THEN 'train' WHEN r <= a + c THEN 'calibration_fit'
              WHEN r <= a + d THEN 'selection_validation'
              WHEN r <= a + b THEN 'promotion_evaluation' ELSE 'final_test' END AS split
  FROM placed p, quarter)
"""


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded, so summation order does not show in a comparison."""
    return df.select(
        *[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )
