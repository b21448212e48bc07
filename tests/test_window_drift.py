"""Drift over event-time windows: one verdict per window however its rows arrive."""

import datetime as dt
import math
import random

import pytest

from riskframe.operators.contract import Contract
from riskframe.operators.drift import fit_reference
from riskframe.streaming import monitor

SCHEMA = "at timestamp, fee double, flat double, score double"
START = dt.datetime(2024, 1, 1)


def reference(spark):
    rng = random.Random(1)
    rows = [(START, rng.gauss(0, 1), 5.0, rng.random()) for _ in range(400)]
    return spark.createDataFrame(rows, SCHEMA)


def draw_bad(rng):
    return rng.choice([math.nan, math.inf])


def arrivals():
    """Three hours; the second one drifts. Rows come up to half an hour late."""
    rng = random.Random(2)
    rows = []
    for minute in range(180):
        for _ in range(4):
            shift = 3.0 if 60 <= minute < 120 else 0.0
            fee = None if rng.random() < 0.1 else draw_bad(rng) if rng.random() < 0.1 else rng.gauss(shift, 1)
            at = START + dt.timedelta(minutes=minute)
            rows.append((minute + rng.randrange(30), (at, fee, rng.choice([4.0, 5.0, 5.0]), rng.random())))
    return [row for _, row in sorted(rows, key=lambda r: r[0])] + [
        (START + dt.timedelta(hours=20), 0.0, 5.0, 0.5)
    ]


@pytest.fixture(scope="module")
def state(spark):
    return fit_reference(reference(spark), Contract(("fee", "flat", "score"), ()))


def plain(rows, edges, name):
    """Distance of one window from the reference by counting."""
    index = SCHEMA.split(", ").index(name + " double")
    return [sum(e <= r[index] for e in edges) for r in rows if r[index] is not None and math.isfinite(r[index])]


@pytest.mark.parametrize("files", [1, 10])
def test_a_window_has_one_verdict_however_its_rows_arrive(spark, state, tmp_path, files):
    rows = arrivals()
    size = -(-len(rows) // files)
    for i in range(files):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    stream = (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    )
    monitor.start_window_drift(
        stream, state, "at", str(tmp_path / "out"), str(tmp_path / "state"), late="2 hours"
    ).awaitTermination(180)
    streamed = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    whole = monitor.window_drift(
        monitor.window_buckets(spark.createDataFrame(rows, SCHEMA), state, "at"), state
    )
    closed = whole.where(f"window_end <= timestamp'{START + dt.timedelta(hours=18)}'")
    order = ["window_start", "feature"]
    got = streamed.select(whole.columns).orderBy(*order).collect()
    assert got == closed.orderBy(*order).collect()
    found = {(r.window_start.hour, r.feature): r for r in got}
    assert len(got) == 9 and found[1, "fee"].status == "BREACH" and found[1, "score"].status != "BREACH"
    edges = next(r.edges for r in state.bins.collect() if r.feature == "fee")
    then = plain(reference(spark).collect(), edges, "fee")
    for hour in range(3):
        own = [r for r in rows if r[0] - START < dt.timedelta(hours=3) and r[0].hour == hour]
        now = plain(own, edges, "fee")
        apart = sum(abs(then.count(i) / len(then) - now.count(i) / len(now)) for i in range(len(edges) + 1)) / 2
        assert found[hour, "fee"].total_variation == pytest.approx(apart)
        assert found[hour, "fee"].missing_count == sum(r[1] is None or math.isnan(r[1]) for r in own)
        assert found[hour, "fee"].invalid_count == sum(r[1] == math.inf for r in own)
