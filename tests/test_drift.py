import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift
from riskframe.operators.contract import Contract, ContractError, Limit, TimeWindow, limits_from
from riskframe.plans.drift_report import drift_report, run_drift

FEES = (2.5, 4.0, 4.0, 7.25, 9.0, 11.5, 12.0, 20.0)
CHANNELS = ("web", "app", "web", "branch", None, "app", "web", "phone")


def table(spark, fees=FEES, channels=CHANNELS):
    rows = [(f, -3, None, c) for f, c in zip(fees, channels)]
    return spark.createDataFrame(rows, "fee double, flat int, void double, channel string")


def plan(**options):
    return Contract(("fee", "flat", "void"), ("channel",), **{"bins": 2, "top_k": 2, **options})


def checks_of(result):
    return {r.check_id: r for r in result.checks.collect()}


def buckets_of(result, feature):
    rows = result.comparison.buckets.where(F.col("feature") == feature).collect()
    return {r.bucket: (r.reference_count, r.current_count) for r in rows}


def test_a_table_does_not_drift_from_itself(spark):
    result = run_drift(table(spark), table(spark).repartition(5), plan())
    found = checks_of(result)
    assert {found[f"feature.{n}.distribution_shift"].observed for n in ("fee", "channel")} == {0.0}
    untold = {k for k, r in found.items() if r.status == "NOT_EVALUATED"}
    assert untold == {
        "feature.flat.standardized_mean_shift",
        "feature.void.distribution_shift",
        "feature.void.standardized_mean_shift",
        "prediction.availability",
    }
    assert result.summary.first().overall_status == "PASS"
    rules = {r.feature: (r.strategy, r.edges, r.constant) for r in result.state.bins.collect()}
    assert rules["fee"] == ("reference_quantiles", [(7.25 + 9.0) / 2], None)
    assert rules["flat"] == ("constant_reference", None, -3.0)
    assert rules["void"] == ("unavailable_all_nonfinite", None, None)
    assert buckets_of(result, "fee") == {"BIN_00": (4, 4), "BIN_01": (4, 4)}


def test_columns_that_are_gone_or_no_longer_numbers(spark):
    found = checks_of(run_drift(table(spark), table(spark).select("flat", "void"), plan()))
    assert found["feature.fee.column_presence"].status == "BREACH"
    assert found["feature.fee.distribution_shift"].observed == 0.5
    assert found["feature.channel.missing_rate_shift"].observed == pytest.approx(1 - 1 / 8)
    texts = [("4.0",), (" 9 ",), ("nine",), ("Infinity",), ("nan",)]
    found = checks_of(run_drift(table(spark), spark.createDataFrame(texts, "fee string"), plan()))
    assert found["feature.fee.invalid_rate_increase"].observed == pytest.approx(3 / 5)
    numbers = spark.createDataFrame([(4.0,), (-math.inf,), (math.nan,), (None,)], "fee double")
    found = checks_of(run_drift(table(spark), numbers, plan()))
    rates = [found[f"feature.fee.{c}"].observed for c in ("invalid_rate_increase", "missing_rate_shift")]
    assert sum(rates) == pytest.approx(3 / 4)


def test_values_leave_a_constant_on_both_sides(spark):
    moved = table(spark).withColumn("flat", (F.col("fee") - 7).cast("int"))
    result = run_drift(table(spark), moved, plan())
    (constant,) = {r.flat for r in table(spark).collect()}
    values = [r.flat for r in moved.collect()]
    want = {
        "BELOW_CONSTANT": (0, sum(v is not None and v < constant for v in values)),
        "AT_CONSTANT": (8, values.count(constant)),
        "ABOVE_CONSTANT": (0, sum(v is not None and v > constant for v in values)),
    }
    assert min(n for _, n in want.values()) > 0
    assert buckets_of(result, "flat") == want


def test_categories_new_and_beyond_the_top(spark):
    now = table(spark, channels=("fax", "web", "phone", "fax", "fax", None, "branch", "app"))
    result = run_drift(table(spark), now, plan(top_k=1))
    counts = buckets_of(result, "channel")
    token = next(b for b in counts if b.startswith("CATEGORY_"))
    assert counts == {token: (3, 1), "OTHER": (4, 3), "MISSING": (1, 1), "UNKNOWN": (0, 3)}
    assert checks_of(result)["feature.channel.unknown_rate"].observed == pytest.approx(3 / 8)


def test_verdicts_are_exact_at_their_level(spark):
    # 3 of 7 against 5 of 7: the distance is 2/7 whatever the layout and the order of sums.
    before = [("x",)] * 3 + [("y",)] * 4
    after = [("x",)] * 5 + [("y",)] * 2
    for level, verdict in ((math.nextafter(2 / 7, 1), "WARN"), (2 / 7, "BREACH")):
        own = Contract((), ("k",), limits=limits_from({"distribution_breach": level}))
        for parts in (1, 3):
            sides = [spark.createDataFrame(s, "k string").repartition(parts) for s in (before, after)]
            check = checks_of(run_drift(*sides, own))["feature.k.distribution_shift"]
            assert (check.observed, check.status) == (2 / 7, verdict)


def test_predictions_are_compared_only_where_valid(spark):
    own = Contract(("z",), (), probability="score", decision="flag")

    def side(scores, flags):
        rows = [(float(i), s, f) for i, (s, f) in enumerate(zip(scores, flags))]
        return spark.createDataFrame(rows, "z double, score double, flag int")

    reference = side((0.2, 0.4, 0.6, 0.8), (0, 0, 1, 0))
    state = drift.fit_reference(reference, own)
    assert {r.feature: r.mean for r in state.profile.collect()}["flag"] == 0.25
    now = checks_of(run_drift(state, side((0.1, 0.2, 0.3, 7.0), (1, 1, 1, 9)), own))
    assert now["prediction.probability.mean_shift"].observed == pytest.approx(0.3)
    assert now["prediction.decision.positive_rate_shift"].observed == pytest.approx(0.75)
    assert now["prediction.decision.invalid_rate_increase"].observed == pytest.approx(0.25)
    unusable = side((-1.0, math.nan, None, 2.0), (None, 5, -1, 3))
    blind = checks_of(run_drift(state, unusable, own))
    for name in ("probability.mean_shift", "probability.distribution_shift", "decision.positive_rate_shift"):
        assert blind[f"prediction.{name}"].status == "NOT_EVALUATED"
    assert blind["prediction.probability.valid_data_availability"].status == "BREACH"
    for sides in ((unusable, own), (reference.limit(0), own)):
        with pytest.raises(ContractError):
            drift.fit_reference(*sides)
    with pytest.raises(ContractError):
        run_drift(state, reference.limit(0), own)


GOOD_FILE = {
    "contract_schema_version": "1.0",
    "model": {"model_name": "m", "model_version": "3", "run_id": "r"},
    "feature_schema": {"numeric_cols": ["b", "a"], "categorical_cols": ["c"]},
    "monitoring": {"numeric_bin_count": 7},
    "thresholds": {"missing_rate_warn": 0.01},
}


def test_contract_files():
    built = Contract.build(GOOD_FILE)
    assert (built.numeric, built.bins, built.top_k) == (("a", "b"), 7, 10)
    assert built.limits["missing_rate"] == Limit(0.01, 0.10)
    for change in (
        {"contract_schema_version": "2.0"},
        {"contract_schema_version": None},
        {"model": {"model_name": "m"}},
        {"model": {**GOOD_FILE["model"], "threshold": 0.5}},
        {"model": {**GOOD_FILE["model"], "threshold": 1.5, "threshold_source": "s"}},
        {"feature_schema": {"numeric_cols": "a"}},
        {"feature_schema": {"numeric_cols": ["a", "a"]}},
        {"feature_schema": []},
        {"monitoring": {"numeric_bin_count": 51}},
        {"monitoring": {"colour": "red"}},
        {"thresholds": {"missing_rate_warn": "much"}},
        {"thresholds": {"missing_rate_warn": 0.5}},
        {"thresholds": [1]},
        {"surplus": 1},
    ):
        with pytest.raises(ContractError):
            Contract.build({**GOOD_FILE, **change})
    for wrong in (
        lambda: Contract((), ()),
        lambda: Contract(("a",), (), probability="a"),
        lambda: Contract(("a",), (), top_k=0),
        lambda: limits_from({"unheard_of": 1}),
        lambda: TimeWindow.build("2024-05-01 10:00", "2024-05-02T10:00:00Z"),
        lambda: TimeWindow.build("2024-05-03T10:00:00Z", "2024-05-02T10:00:00Z"),
    ):
        with pytest.raises(ContractError):
            wrong()


def test_report_does_not_depend_on_layout(spark):
    window = TimeWindow.build("2024-05-01T10:00:00Z", "2024-05-02T10:00:00+02:00")
    now = table(spark, fees=tuple(f + 1 for f in FEES))
    for i in range(25):
        now = now.withColumn(f"more{i}", F.lit(i))
    reports = [
        drift_report(table(spark).repartition(n), now.repartition(n), plan(), "a", "b", window, window)
        for n in (1, 4)
    ]
    assert reports[0]["digest"] == reports[1]["digest"]
    content = reports[0]["content"]
    assert len(content["other_columns"]) == 25
    assert set(content["tables"]) == {"checks", "profiles", "bins", "buckets", "distances", "summary"}
    assert content["compared"]["current"]["rows"] == 8


def test_a_saved_reference_compares_the_same(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(float(v), f"k{int(abs(v) * 4)}") for v in rng.gamma(2.0, size=3000)]
    reference = spark.createDataFrame(rows, "x double, k string")
    now = reference.withColumn("x", F.col("x") * 1.1)
    own = Contract(("x",), ("k",), bins=8)
    state = drift.fit_reference(reference, own)
    state.save(str(tmp_path / "state"))
    loaded = drift.ReferenceState.load(spark, str(tmp_path / "state"), own)
    kept = ("check_id", "observed", "status")
    first, second = (
        sorted(tuple(r) for r in run_drift(s, now, own).checks.select(*kept).collect())
        for s in (state, loaded)
    )
    assert first == second
    edges = {r.feature: r.edges for r in state.bins.collect()}["x"]
    assert edges == pytest.approx(np.quantile([v for v, _ in rows], [i / 8 for i in range(1, 8)]))


def test_wide_tables_are_profiled_in_chunks(spark):
    names = [f"n{i}" for i in range(drift.PROFILE_CHUNK + 3)]
    wide = spark.range(5).select(*[(F.col("id") + i).cast("double").alias(n) for i, n in enumerate(names)])
    rows, _ = drift.side_profile(wide, Contract(tuple(names), ()))
    assert {r["feature"]: (r["min"], r["q50"]) for r in rows} == {
        n: (float(i), float(i + 2)) for i, n in enumerate(names)
    }
