import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators.calibrate import Calibrator, fit_calibrator, isotonic_blocks
from riskframe.operators.metrics import (
    compute_metrics,
    confusion_metrics,
    score_counts,
    score_curve,
    score_sketch,
    with_rates,
)
from riskframe.operators.order import bucketise
from riskframe.operators.predict import (
    PredictionError,
    align_predictions,
    check_alignment,
    check_predictions,
    decide,
)
from riskframe.operators.threshold import select_threshold


def by_hand(y, s, threshold):
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    p, n = int(y.sum()), int((1 - y).sum())
    pairs = sum((a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0])
    ap = 0.0
    for value in np.unique(s)[::-1]:
        at, tp = s >= value, int(y[s >= value].sum())
        ap += (int(y[s == value].sum()) / p) * tp / at.sum()
    flagged = s >= threshold
    return {
        "roc_auc": pairs / (p * n),
        "pr_auc": ap,
        "brier_score": float(np.mean((s - y) ** 2)),
        "tp": int((flagged & (y == 1)).sum()),
        "fp": int((flagged & (y == 0)).sum()),
    }


def table(spark, rows, schema="y int, s double"):
    return spark.createDataFrame(rows, schema).repartition(4)


def test_metrics_match_definitions(spark):
    rng = random.Random(2)
    samples = {
        "continuous": [(int(rng.random() < 0.3), rng.random()) for _ in range(300)],
        "ties": [(int(rng.random() < 0.4), rng.randrange(6) / 5) for _ in range(300)],
        "hot_score": [(int(rng.random() < 0.4), 0.25 if i % 3 == 0 else rng.random()) for i in range(300)],
        "tiny_scores": [(int(rng.random() < 0.4), rng.random() ** 30) for _ in range(300)],
    }
    for name, rows in samples.items():
        want = by_hand(*zip(*rows), 0.5)
        got = compute_metrics(table(spark, rows), "y", "s", 0.5, 25.0, 1.0).first()
        for key, value in want.items():
            assert got[key] == pytest.approx(value, rel=1e-12), (name, key)
        assert got.n_samples == 300 and got.expected_cost == got.fn * 25 + got.fp
    six = [(1, 0.9), (0, 0.8), (1, 0.3), (0, 0.2), (0, 0.1), (1, 0.05)]
    assert compute_metrics(table(spark, six), "y", "s").first().pr_auc == pytest.approx(
        by_hand(*zip(*six), 0.5)["pr_auc"]
    )


def test_grouped_metrics_equal_separate_ones(spark):
    rng = random.Random(4)
    rows = [(g, int(rng.random() < 0.4), round(rng.random(), 2)) for g in "ab" for _ in range(100)]
    df = table(spark, rows, "g string, y int, s double")
    both = {r.g: r for r in compute_metrics(df, "y", "s", groups=["g"]).collect()}
    for g in "ab":
        one = compute_metrics(df.filter(F.col("g") == g), "y", "s").first()
        for key in ("roc_auc", "pr_auc", "log_loss", "tp", "fp"):
            assert both[g][key] == pytest.approx(one[key])


def test_single_class_costs_and_reference_counts(spark):
    single = compute_metrics(table(spark, [(0, 0.2), (0, 0.7)]), "y", "s").first()
    assert single.roc_auc is None and single.pr_auc is None and single.recall == 0.0
    four = [(0, 0.1), (1, 0.4), (0, 0.6), (1, 0.9)]
    row = confusion_metrics(table(spark, four), "y", "s", 0.5, 25.0, 1.0).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (1, 1, 1, 1)
    assert (row.expected_cost, row.expected_cost_per_sample) == (26.0, 6.5)
    published = spark.createDataFrame(
        [(83456, 2042, 1459, 1624, 88581)], "tn long, fp long, fn long, tp long, n_samples long"
    )
    row = with_rates(published, 25.0, 1.0).first()
    assert row.precision == pytest.approx(0.4429896344789962)
    assert row.recall == pytest.approx(0.5267596496918586)
    assert row.f1 == pytest.approx(0.4812564824418432)
    assert (row.expected_cost, row.expected_cost_per_sample) == (
        38517.0,
        pytest.approx(0.434822365970129),
    )
    with pytest.raises(ValueError):
        confusion_metrics(table(spark, four), "y", "s", 0.5, fn_cost=1.0)


def numpy_threshold(y, s, strategy, target=0.8, fn=25.0, fp=1.0, grid=None):
    y, s = np.asarray(y), np.asarray(s)
    scores = np.unique(s)
    p = y.sum()
    if strategy == "best_f1":
        f1 = [2 * y[s >= t].sum() / (p + (s >= t).sum()) for t in scores]
        return float(scores[int(np.argmax(f1))])
    if strategy == "target_recall":
        return float(max((t for t in scores if y[s >= t].sum() / p >= target), default=0.0))
    candidates = scores if grid is None else np.quantile(scores, np.linspace(0, 1, grid))
    costs = [(y[s < t].sum()) * fn + ((1 - y)[s >= t].sum()) * fp for t in candidates]
    return float(candidates[int(np.argmin(costs))])


@pytest.mark.parametrize(
    "strategy,grid",
    [("best_f1", None), ("target_recall", None), ("cost_based", None), ("cost_based", 200)],
)
def test_threshold_strategies(spark, strategy, grid):
    rng = random.Random(9)
    for rows in (
        [(int(rng.random() < 0.3), rng.random()) for _ in range(700)],
        [(int(rng.random() < 0.3), rng.randrange(11) / 10) for _ in range(200)],
    ):
        got = select_threshold(table(spark, rows), "y", "s", strategy, candidates=grid).first()
        want = numpy_threshold(*zip(*rows), strategy, grid=grid)
        assert got.threshold == pytest.approx(want, rel=1e-12)
        y, s = map(np.asarray, zip(*rows))
        cost = (y[s < want]).sum() * 25.0 + (1 - y)[s >= want].sum()
        assert got.expected_cost == cost


def test_fixed_threshold_and_unknown_strategy(spark):
    df = table(spark, [(0, 0.1), (1, 0.4), (0, 0.6), (1, 0.9)])
    row = select_threshold(df, "y", "s", "fixed").first()
    assert (row.threshold, row.expected_cost) == (0.5, 26.0)
    with pytest.raises(ValueError):
        select_threshold(df, "y", "s", "best")


def test_prediction_checks(spark):
    scored = decide(
        spark.createDataFrame([(0.2, 0), (0.5, 1), (0.9, 1)], "fraud_probability double, y int"), 0.5
    )
    assert [r.fraud_prediction for r in scored.collect()] == [0, 1, 1]
    check_predictions(scored, 0.5, "y", rows=3)
    with pytest.raises(PredictionError):
        check_predictions(scored, 0.6, "y")
    for bad in (float("nan"), math.inf, -0.1, 1.1):
        broken = scored.withColumn("fraud_probability", F.lit(bad))
        with pytest.raises(PredictionError):
            check_predictions(broken, 0.5)


def test_calibration(spark):
    rng = np.random.default_rng(0)
    raw = rng.random(800)
    y = (rng.random(800) < raw**2).astype(int)
    df = table(spark, [(int(a), float(b)) for a, b in zip(y, raw)])
    base = compute_metrics(df, "y", "s").first()
    for strategy in ("sigmoid", "isotonic"):
        fitted = fit_calibrator(df, "s", "y", strategy).apply(df, "s", "c")
        after = compute_metrics(fitted, "y", "c").first()
        assert after.brier_score < base.brier_score
        bounds = fitted.agg(F.min("c"), F.max("c")).first()
        assert 0.0 <= bounds[0] <= bounds[1] <= 1.0
    with pytest.raises(ValueError):
        fit_calibrator(df.filter("y = 1"), "s", "y", "sigmoid")
    with pytest.raises(ValueError):
        fit_calibrator(df, "s", "y", "platt")


def plain_isotonic(points):
    """Fitted share of every (score, pos, n), by pooling one after the other."""
    blocks = []
    for score, pos, n in sorted(points):
        blocks.append([[score], pos, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return [(min(s), max(s), pos, n) for s, pos, n in blocks]


@pytest.mark.parametrize("scale", [1.0, 1e-9])
@pytest.mark.parametrize("shape", ["rising", "falling", "random"])
def test_isotonic_blocks_equal_plain_pooling(spark, scale, shape):
    rng = np.random.default_rng(5)
    raw = np.concatenate([rng.random(1500), np.full(400, 0.25)]) * scale
    chance = {"rising": raw / scale, "falling": 1 - raw / scale, "random": np.full(len(raw), 0.02)}[shape]
    y = (rng.random(len(raw)) < chance).astype(int)
    df = table(spark, [(int(a), float(b)) for a, b in zip(y, raw)])
    points = {}
    for score, label in zip(raw.tolist(), y.tolist()):
        pos, n = points.get(score, (0, 0))
        points[score] = (pos + label, n + 1)
    want = plain_isotonic([(s, p, n) for s, (p, n) in points.items()])
    found = isotonic_blocks(score_counts(df, "y", "s")).collect()
    assert sorted(tuple(r) for r in found) == want
    fitted = fit_calibrator(df, "s", "y", "isotonic").apply(df, "s", "c")
    share = {s: next(p / n for low, high, p, n in want if low <= s <= high) for s in points}
    for r in fitted.collect():
        assert r.c == pytest.approx(share[r.s], rel=1e-12, abs=1e-15)
    if scale < 1 and shape == "rising":
        assert len(want) > 10  # scores below 1e-6 are still told apart


def test_curve_plan_has_no_unbounded_window(spark):
    df = table(spark, [(i % 2, i / 100) for i in range(100)])
    plan = score_curve(df, "y", "s")._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "SinglePartition" in line]
    # Only the bucket totals, at most one row per bucket, meet in one partition.
    assert len(lines) <= 1


def test_alignment(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "id int, y int")
    scores = spark.createDataFrame([(1, 0.2), (2, 0.9)], "id int, s double")
    check_alignment(labels, scores, "id")
    for wrong in (scores.limit(1), scores.unionByName(scores), scores.withColumn("id", F.lit(9))):
        with pytest.raises(PredictionError):
            check_alignment(labels, wrong, "id")


def test_unusable_scores_and_labels_stop_the_job(spark):
    good = [(0, 0.2), (1, 0.7), (1, 0.9)]
    for row in ((1, None), (1, float("nan")), (0, math.inf), (None, 0.5), (2, 0.5)):
        df = table(spark, [*good, row])
        for job in (
            lambda: compute_metrics(df, "y", "s").collect(),
            lambda: confusion_metrics(df, "y", "s").collect(),
            lambda: select_threshold(df, "y", "s", "best_f1").collect(),
            lambda: select_threshold(df, "y", "s", "fixed").collect(),
            lambda: fit_calibrator(df, "s", "y", "sigmoid"),
        ):
            with pytest.raises(Exception, match="must be"):
                job()
    unknown = table(spark, [(0, None), (1, float("nan"))])
    mapped = Calibrator("sigmoid", 1.0, 0.0).apply(unknown, "s", "c").collect()
    assert [r.c for r in mapped] == [None, None]


def test_curve_buckets_hold_distinct_scores_evenly(spark):
    rows = [(i % 2, 0.5) for i in range(9900)] + [(i % 2, i / 7000) for i in range(100)]
    counts = score_counts(table(spark, rows), "y", "s")
    splits, positives, negatives = score_sketch(counts)
    assert (positives, negatives) == (5000, 5000)
    placed = bucketise(counts, "score", splits, "b").groupBy("b").count().collect()
    assert len(placed) >= 12 and max(r["count"] for r in placed) <= 20


def test_alignment_is_checked_while_joining(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "id int, y int")
    scores = spark.createDataFrame([(1, 0.2), (2, 0.9)], "id int, s double")
    good = align_predictions(labels, scores, "id", "y").collect()
    assert sorted((r.id, r.y, r.s) for r in good) == [(1, 0, 0.2), (2, 1, 0.9)]
    for wrong in (scores.limit(1), scores.unionByName(scores), scores.withColumn("id", F.lit(9))):
        with pytest.raises(Exception, match="do not align"):
            align_predictions(labels, wrong, "id", "y").collect()
        # The refusal holds for plans that never read the id.
        with pytest.raises(Exception, match="do not align"):
            align_predictions(labels, wrong, "id", "y").select("y", "s").collect()
        with pytest.raises(Exception, match="do not align"):
            compute_metrics(align_predictions(labels, wrong, "id", "y"), "y", "s").collect()
