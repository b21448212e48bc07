"""Drift checks with verdicts, their rollup, and the nested report."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.canonical import canonical_json, json_digest
from riskframe.functions.local import local_rows
from riskframe.functions.scalars import (
    BREACH,
    NOT_EVALUATED,
    PASS,
    WARN,
    severity,
    severity_rank,
    status,
)
from riskframe.operators.contract import Contract, ContractError, Limit, TimeWindow
from riskframe.operators.drift import (
    CATEGORICAL,
    DECISION,
    MISSING,
    PROBABILITY,
    UNAVAILABLE,
    UNKNOWN,
    Comparison,
    ReferenceState,
    bucket_shares,
    compare_current,
    fit_reference,
)
from riskframe.operators.fingerprint import table_fingerprint

LAYOUT = 2

# Check ids, metric names and verdicts that monitors already watch stand where
# the checks are made.
CHECKS = (
    "check_id string, feature string, metric string, observed double, warn double, "
    "breach double, fixed_status string"
)


def _rate(row: dict, part: str) -> float:
    return row[f"{part}_count"] / row["row_count"]


class _Checks:
    """Collects observations; verdicts are taken by Spark in one place."""

    def __init__(self, limits: dict[str, Limit]) -> None:
        self.limits = limits
        self.rows: list[tuple] = []

    def measured(
        self, check: str, feature: str, metric: str, observed: float | None, limit: str
    ) -> None:
        bound = self.limits[limit]
        self.rows.append((check, feature, metric, observed, bound.warn, bound.breach, None))

    def settled(
        self, check: str, feature: str | None, metric: str, observed: float, verdict: str
    ) -> None:
        self.rows.append((check, feature, metric, float(observed), None, None, verdict))

    def presence(self, prefix: str, feature: str, present: bool) -> None:
        verdict = PASS if present else BREACH
        self.settled(f"{prefix}.column_presence", feature, "column_presence", present, verdict)


def drift_checks(state: ReferenceState, comparison: Comparison, extra_columns: int) -> DataFrame:
    """``check_id, feature, metric, observed, warn, breach, status, severity`` by check id.

    Everything observed is already reduced to a few numbers per feature at this point.
    """
    contract, spark = state.contract, state.profile.sparkSession
    checks = _Checks(contract.limits)
    before = {r.feature: r.asDict() for r in state.profile.collect()}
    after = {r.feature: r.asDict() for r in comparison.profile.collect()}
    strategies = {r.feature: r.strategy for r in state.bins.collect()}
    distance = {r.feature: r.total_variation for r in comparison.distances.collect()}
    for name in contract.numeric:
        usable = strategies[name] != UNAVAILABLE
        _numeric_checks(
            checks,
            name,
            comparison.present[name],
            before[name],
            after[name],
            distance.get(name) if usable else None,
        )
    shares = _category_shares(comparison)
    for name in contract.categorical:
        prefix = f"feature.{name}"
        checks.presence(prefix, name, comparison.present[name])
        (ref_missing, _), (cur_missing, unknown) = shares[name]
        checks.measured(
            f"{prefix}.missing_rate_shift",
            name,
            "absolute_missing_rate_shift",
            abs(cur_missing - ref_missing),
            "missing_rate",
        )
        checks.measured(
            f"{prefix}.unknown_rate", name, "unknown_category_rate", unknown, "unknown_rate"
        )
        checks.measured(
            f"{prefix}.distribution_shift",
            name,
            "total_variation_distance",
            distance[name],
            "distribution",
        )
    for kind, name in ((PROBABILITY, contract.probability), (DECISION, contract.decision)):
        if name is not None:
            _prediction_checks(
                checks,
                kind,
                name,
                comparison.present[name],
                before[name],
                after[name],
                distance.get(name),
            )
    if contract.probability is None and contract.decision is None:
        checks.settled(
            "prediction.availability", None, "prediction_data_availability", False, NOT_EVALUATED
        )
    checks.settled(
        "schema.unexpected_current_columns",
        None,
        "unexpected_current_column_count",
        extra_columns,
        WARN if extra_columns else PASS,
    )
    observed, warn, breach = F.col("observed"), F.col("warn"), F.col("breach")
    return (
        local_rows(spark, sorted(checks.rows, key=lambda row: row[0]), CHECKS)
        .withColumn("status", F.coalesce("fixed_status", status(observed, warn, breach)))
        .drop("fixed_status")
        .withColumn("severity", severity(F.col("status")))
    )


def _numeric_checks(
    checks: _Checks, name: str, present: bool, ref: dict, cur: dict, distance: float | None
) -> None:
    prefix = f"feature.{name}"
    checks.presence(prefix, name, present)
    checks.measured(
        f"{prefix}.missing_rate_shift",
        name,
        "absolute_missing_rate_shift",
        abs(_rate(cur, "missing") - _rate(ref, "missing")),
        "missing_rate",
    )
    checks.measured(
        f"{prefix}.invalid_rate_increase",
        name,
        "invalid_rate_increase",
        max(0.0, _rate(cur, "invalid") - _rate(ref, "invalid")),
        "invalid_rate",
    )
    checks.measured(
        f"{prefix}.distribution_shift", name, "total_variation_distance", distance, "distribution"
    )
    shift = None
    if ref["std"] and cur["mean"] is not None:
        shift = abs(cur["mean"] - ref["mean"]) / ref["std"]
    checks.measured(
        f"{prefix}.standardized_mean_shift",
        name,
        "standardized_mean_shift",
        shift,
        "standardized_mean",
    )


def _prediction_checks(
    checks: _Checks,
    kind: str,
    name: str,
    present: bool,
    ref: dict,
    cur: dict,
    distance: float | None,
) -> None:
    """Availability first; shifts only where the current side has valid values."""
    prefix = f"prediction.{kind}"
    usable = present and cur["finite_count"] > 0
    checks.presence(prefix, name, present)
    checks.settled(
        f"{prefix}.valid_data_availability",
        name,
        f"valid_{kind}_count",
        cur["finite_count"],
        PASS if usable else BREACH,
    )
    checks.measured(
        f"{prefix}.invalid_rate_increase",
        name,
        f"invalid_{kind}_rate_increase",
        max(0.0, _rate(cur, "invalid") - _rate(ref, "invalid")),
        "invalid_rate",
    )
    shift = abs(cur["mean"] - ref["mean"]) if usable else None
    if kind == DECISION:
        checks.measured(
            f"{prefix}.positive_rate_shift",
            name,
            "absolute_positive_decision_rate_shift",
            shift,
            "positive_rate",
        )
        return
    checks.measured(
        f"{prefix}.distribution_shift",
        name,
        "total_variation_distance",
        distance if usable else None,
        "distribution",
    )
    checks.measured(
        f"{prefix}.mean_shift", name, "absolute_mean_probability_shift", shift, "prediction_mean"
    )


def _category_shares(comparison: Comparison) -> dict[str, list[tuple[float, float]]]:
    """Per categorical feature: (missing, unknown) share of the reference, then of the current."""
    sizes: dict[str, dict[str, tuple[int, int]]] = {}
    for row in comparison.buckets.collect():
        if row.kind == CATEGORICAL:
            counts = (row.reference_count, row.current_count)
            sizes.setdefault(row.feature, {})[row.bucket] = counts
    out = {}
    for name, buckets in sizes.items():
        totals = [sum(pair[side] for pair in buckets.values()) for side in (0, 1)]
        out[name] = [
            (buckets[MISSING][side] / totals[side], buckets[UNKNOWN][side] / totals[side])
            for side in (0, 1)
        ]
    return out


def check_rollup(checks: DataFrame) -> DataFrame:
    """One row: count per status with zeros, overall status and exit code."""
    worst = F.max(severity_rank(F.col("status")))
    overall = F.when(worst == 2, BREACH).when(worst == 1, WARN).otherwise(PASS)
    return checks.agg(
        *[
            F.count_if(F.col("status") == s).alias(f"n_{s.lower()}")
            for s in (BREACH, NOT_EVALUATED, PASS, WARN)
        ],
        overall.alias("overall_status"),
        F.when(worst == 2, 1).otherwise(0).alias("exit_code"),
    )


@dataclass(frozen=True)
class DriftResult:
    state: ReferenceState
    comparison: Comparison
    checks: DataFrame
    summary: DataFrame
    unexpected: list[str]


def unexpected_columns(current: DataFrame, contract: Contract) -> list[str]:
    return sorted(set(current.columns) - set(contract.columns))


def run_drift(
    reference: DataFrame | ReferenceState,
    current: DataFrame,
    contract: Contract,
    summary: bool = False,
) -> DriftResult:
    """All checks of a current table against a reference table or its frozen state."""
    state = (
        reference
        if isinstance(reference, ReferenceState)
        else fit_reference(reference, contract)
    )
    extra = unexpected_columns(current, contract)
    comparison = compare_current(state, current, summary)
    checks = drift_checks(state, comparison, len(extra))
    return DriftResult(state, comparison, checks, check_rollup(checks), extra)


def report_tables(result: DriftResult) -> dict[str, DataFrame]:
    """All a report says about the data, as tables in a fixed order.

    Each is bounded by the contract (features, buckets, checks), never by the rows compared.
    """
    state, comparison = result.state, result.comparison
    profiles = state.profile.withColumn("side", F.lit("reference")).unionByName(
        comparison.profile.withColumn("side", F.lit("current"))
    )
    rates = [
        F.try_divide(F.col(f"{part}_count"), F.col("row_count")).alias(f"{part}_rate")
        for part in ("finite", "missing", "invalid")
    ]
    return {
        "checks": result.checks.orderBy("check_id"),
        "profiles": profiles.select("*", *rates).orderBy("feature", "side"),
        "bins": state.bins.orderBy("feature"),
        "buckets": bucket_shares(comparison.buckets).orderBy("feature", "side", "position"),
        "distances": comparison.distances.orderBy("feature"),
        "summary": result.summary,
    }


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    contract: Contract,
    reference_source: str,
    current_source: str,
    reference_window: TimeWindow,
    current_window: TimeWindow,
    generated_at: str | None = None,
) -> dict[str, Any]:
    """The tables of a run with what was compared. ``digest`` covers all but ``created``."""
    sides = {
        "reference": (reference, reference_source, reference_window),
        "current": (current, current_source, current_window),
    }
    if not all(source.strip() for _, source, _ in sides.values()):
        raise ContractError("a side has no source name")
    result = run_drift(reference, current, contract, summary=True)
    compared = {}
    for side, (table, source, window) in sides.items():
        identity = table_fingerprint(table).first()
        compared[side] = {
            "source": source,
            "window": window.described(),
            "rows": identity.row_count,
            "digest": identity.fingerprint,
        }
    settings = contract.described()
    said = {
        "compared": compared,
        "settings": settings,
        "settings_digest": json_digest(settings),
        "present": dict(sorted(result.comparison.present.items())),
        # Names of columns outside the contract may be private; all are listed, as digests.
        "other_columns": [hashlib.sha256(n.encode()).hexdigest() for n in result.unexpected],
        "tables": {
            name: [row.asDict(recursive=True) for row in table.collect()]
            for name, table in report_tables(result).items()
        },
    }
    created = generated_at or datetime.now(timezone.utc).isoformat()
    report = {"layout": LAYOUT, "created": created, "digest": json_digest(said), "content": said}
    canonical_json(report)
    return report
