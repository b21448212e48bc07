import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators.order import cut_keys, order_bounds
from riskframe.operators.quantiles import _Span, _wide_bins, exact_quantiles, feature_quantiles, wide_quantiles


def test_hot_values_infinities_and_missing(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(size=9000), np.full(9000, 0.125), [math.inf] * 50, [-math.inf] * 70])
    rows = [("a", float(v)) for v in rng.permutation(values)] + [("b", None), ("b", math.nan)]
    rows += [("c", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    wanted = [0.0, 0.001, 0.3, 0.5, 0.77, 0.9, 1.0]
    found = {r.g: r.quantiles for r in exact_quantiles(df, ["g"], "v", wanted).collect()}
    ranked = np.sort(values)
    for p, got in zip(wanted, found["a"]):
        place = (len(ranked) - 1) * p
        low, high = ranked[math.floor(place)], ranked[math.ceil(place)]
        share = place - math.floor(place)
        assert got == (low if low == high else pytest.approx(low * (1 - share) + high * share))
    assert found["b"] is None and found["c"] == [5.0] * len(wanted)


def test_neighbouring_doubles(spark):
    base = 1e300
    values = [base]
    for _ in range(6000):
        values.append(math.nextafter(values[-1], math.inf))
    df = spark.createDataFrame([(0, v) for v in values], "g int, v double")
    got = exact_quantiles(df, ["g"], "v", [0.25]).first().quantiles
    assert got == [values[1500]]


def test_many_columns_in_shared_passes(spark):
    names = [f"c{i}" for i in range(60)]
    wide = spark.range(5000).select(*[(F.col("id") * (i + 1)).cast("double").alias(n) for i, n in enumerate(names)])

    def long_of(features):
        return wide.select(*features).unpivot([], list(features), "feature", "value")

    found = feature_quantiles(long_of, names, [0.5])
    assert found == {n: [2499.5 * (i + 1)] for i, n in enumerate(names)}


def jobs_of(spark, group, action):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return result, len(tracker.getJobIdsForGroup(group))


def test_cuts_end_with_infinities_and_share_tie_passes(spark):
    n = 20000
    times = F.when(F.col("id") == 7, math.inf).when(F.col("id") == 9, -math.inf)
    df = spark.range(n).withColumn("t", times.otherwise(F.floor(F.col("id") / 5000).cast("double")))
    ranks = [2500, 7000, 12000, 17000]
    found, jobs = jobs_of(spark, "cuts", lambda: cut_keys(df, "t", "id", ranks, order_bounds(df, "t")[None]))
    rows = sorted((r.t, r.id) for r in df.collect())
    for rank in ranks:
        cut = found[rank]
        assert (cut.value, cut.tie) == rows[rank]
    # Four tie groups, opened together.
    assert jobs <= 16


def plain_quantile(values, p):
    ranked = np.sort(values)
    place = (len(ranked) - 1) * p
    low, high = ranked[math.floor(place)], ranked[math.ceil(place)]
    share = place - math.floor(place)
    return low if low == high else pytest.approx(low * (1 - share) + high * share)


def test_wide_quantiles_equal_a_full_sort(spark):
    rng = np.random.default_rng(1)
    n = 9000
    columns = {
        "a.normal": rng.normal(size=n),
        "hot": np.where(rng.random(n) < 0.7, 0.125, rng.normal(size=n)),
        "whole": rng.integers(0, 7, n).astype(float),
        "ends": np.where(rng.random(n) < 0.1, math.inf, np.where(rng.random(n) < 0.1, -math.inf, rng.normal(size=n))),
        "near": np.nextafter(1e300, math.inf) * np.ones(n),
        "tiny": rng.random(n) * 1e-9,
        "gone": np.full(n, math.nan),
    }
    columns["near"][: n // 2] = 1e300
    columns["hot"][::10] = math.nan
    rows = list(zip(*(c.tolist() for c in columns.values())))
    rows += [(None,) * len(columns)] * 50
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(5)
    wanted = [0.0, 0.001, 0.1, 0.5, 0.77, 1.0]
    found = wide_quantiles(df, list(columns), wanted)
    for name, values in columns.items():
        known = values[~np.isnan(values)]
        if not len(known):
            assert found[name] is None
            continue
        assert found[name] == [plain_quantile(known, p) for p in wanted]
    assert wide_quantiles(df.limit(0), list(columns), wanted) == dict.fromkeys(columns)


def test_four_hundred_columns_multiply_no_rows(spark):
    names = [f"c{i}" for i in range(400)]
    n, parts = 3000, 4
    ids = spark.range(0, n, 1, parts)
    wide = ids.select(*[((F.col("id") * (i + 1)) % 1000).cast("double").alias(c) for i, c in enumerate(names)])
    ids = np.arange(n)
    want = {c: [plain_quantile((ids * (i + 1)) % 1000, 0.5)] for i, c in enumerate(names)}
    assert wide_quantiles(wide, names, [0.5]) == want
    # What leaves the tasks are bins: at most one per value and task, not one row per cell.
    spans = [_Span(i, 0.0, 999.0, 0, n, (n // 2,)) for i in range(400)]
    bins = _wide_bins(wide, spans)
    assert bins.agg(F.sum("n")).first()[0] == 400 * n
    assert "Expand" not in bins._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in bins._jdf.queryExecution().executedPlan().toString()
