import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import order, quantiles
from riskframe.functions.canonical import digest, row_text
from riskframe.operators import fingerprint
from riskframe.operators.fingerprint import observed_identity, ordered_fingerprint


def frames(spark):
    rng = random.Random(5)
    shapes = {
        "ties": [(rng.randrange(20), i) for i in range(700)],
        "third_in_one_value": [(7 if i % 3 == 0 else i * 11, i) for i in range(900)],
        "missing": [(None if i % 4 == 0 else rng.randrange(5000), i) for i in range(600)],
        "constant": [(3, i) for i in range(300)],
        "negative": [(rng.randrange(-(2**62), 2**62), i) for i in range(500)],
    }
    for name, rows in shapes.items():
        rng.shuffle(rows)
        yield name, rows, spark.createDataFrame(rows, "t bigint, id bigint").repartition(5)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_rank_rows_matches_sorting(spark):
    for name, rows, df in frames(spark):
        ranked = order.rank_rows(df, "t", "id", buckets=16).collect()
        expected = {row: i for i, row in enumerate(in_order(rows))}
        assert {(r.t, r.id): r["rank"] for r in ranked} == expected, name


@pytest.mark.parametrize("bins,direct", [(4096, 4096), (4, 1)])
def test_cut_keys_match_sorting(spark, monkeypatch, bins, direct):
    monkeypatch.setattr(order, "HISTOGRAM_BINS", bins)
    monkeypatch.setattr(order, "DIRECT_ROWS", direct)
    for name, rows, df in frames(spark):
        positions = [0, 1, len(rows) // 3, len(rows) // 2 + 1, len(rows) - 1]
        cuts = order.cut_keys(df, "t", "id", positions)
        ordered = in_order(rows)
        for position in positions:
            got = {
                (r.t, r.id) for r in df.filter(order.before(df, "t", "id", cuts[position])).collect()
            }
            assert got == set(ordered[:position]), (name, position)


def test_cut_keys_on_doubles_and_timestamps(spark):
    values = [float(np.exp(i / 10.0 - 20)) for i in range(400)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "t double, id bigint")
    assert order.cut_keys(df, "t", "id", [123])[123].value == values[123]
    stamped = spark.range(500).select(
        F.timestamp_micros(F.col("id") * 1_234_567).alias("t"), F.col("id")
    )
    cut = order.cut_keys(stamped, "t", "id", [250])[250]
    assert stamped.filter(order.before(stamped, "t", "id", cut)).count() == 250


def test_ranks_do_not_depend_on_layout(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 11).alias("t"), "id")
    expected = {(r.id, r["rank"]) for r in order.rank_rows(df, "t", "id").collect()}
    for parts in (1, 7, 31):
        again = order.rank_rows(df.repartition(parts).orderBy(F.desc("id")), "t", "id").collect()
        assert {(r.id, r["rank"]) for r in again} == expected


def test_rank_plan_has_no_single_partition_sort(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 11).alias("t"), "id")
    plan = order.rank_rows(df, "t", "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    rows, expected = [], {}
    probabilities = [0.0, 0.05, 0.1, 0.5, 0.95, 1.0]
    samples = {
        "normal": rng.normal(size=3000),
        "ties": rng.integers(0, 4, size=2000).astype(float),
        "hot": np.where(np.arange(3000) % 3 == 0, 1.5, rng.random(3000)),
        "one": np.array([4.0]),
    }
    for name, values in samples.items():
        rows += [(name, float(v)) for v in values]
        expected[name] = np.quantile(values, probabilities)
    rows += [("none", None), ("none", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = quantiles.exact_quantiles(df, ["g"], "v", probabilities).collect()
    by_group = {r.g: r.quantiles for r in got}
    assert by_group.pop("none") is None
    for name, values in by_group.items():
        np.testing.assert_allclose(values, expected[name], rtol=1e-12)


def test_ordered_fingerprint_with_repeated_keys_ignores_layout(spark):
    rows = [(i % 40, i % 10, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "t int, k int, v int")
    layouts = (df.coalesce(1), df.repartition(7), df.orderBy(F.desc("v")).repartition(3))
    found = {ordered_fingerprint(x, "t", "k").first().fingerprint for x in layouts}
    assert len(found) == 1
    assert ordered_fingerprint(df.where("v > 0"), "t", "k").first().fingerprint not in found


def test_ordered_fingerprint_sees_every_exchange_and_equals_a_plain_fold(spark):
    rows = [(i, None if i % 7 == 0 else i % 3, f"v{i % 11}") for i in range(60)]
    df = spark.createDataFrame(rows, "t int, k int, v string")

    def of(frame):
        return ordered_fingerprint(frame, "t", "k", ["v"]).first()

    base = of(df.repartition(9))
    for i in range(59):
        swapped = [list(r) for r in rows]
        swapped[i][2], swapped[i + 1][2] = swapped[i + 1][2], swapped[i][2]
        if i % 20 == 0:
            assert of(spark.createDataFrame(swapped, df.schema)) != base
    hashes = [r[0] for r in df.orderBy("t").select(digest(row_text(df.schema, ["v"]))).collect()]
    lanes = []
    for (start, length), power in zip(fingerprint.LANES, fingerprint.BASES):
        own = [int(h[start - 1 : start - 1 + length], 16) for h in hashes]
        lanes.append(sum(r * power ** (59 - i) for i, r in enumerate(own)) % fingerprint.PRIME)
    text = "|".join(['["v"]', "60", *map(str, lanes)])
    assert (base.row_count, base.fingerprint) == (60, hashlib.sha256(text.encode()).hexdigest())
    empty = of(df.limit(0))
    assert empty.row_count == 0 and len(empty.fingerprint) == 64
    # A time on most rows is spread over ranges by the digest, and missing times come last.
    hot = spark.createDataFrame([(None if i % 5 else 1, 0, f"v{i}") for i in range(2000)], df.schema)
    assert len({of(x).fingerprint for x in (hot.coalesce(1), hot.repartition(8))}) == 1


def test_one_missing_id_is_no_repeat(spark):
    rows = [(1, 1, 0), (2, 2, 1), (None, 3, 1)]
    one = spark.createDataFrame(rows, "i int, t int, y int")
    assert observed_identity(one, "i", "t", "y").first().repeated_ids == 0
    assert observed_identity(one.union(one), "i", "t", "y").first().repeated_ids == 3


def test_times_without_zone_ignore_the_session_zone(spark):
    """Around a clock change, where two such times may be one instant in the session's zone."""
    df = spark.range(400).select(
        F.expr("timestamp_ntz'2024-03-10 00:00:00' + id * interval '30.000001' second").alias("t"),
        "id",
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for position in (1, 241, 299, 399):
            cut = order.cut_keys(df, "t", "id", [position])[position]
            kept = df.filter(order.before(df, "t", "id", cut)).agg(F.max("id")).first()[0]
            assert kept == position - 1
        ranked = order.rank_rows(df, "t", "id", buckets=16).collect()
        assert all(r.id == r["rank"] for r in ranked)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
