"""Candidate against champion on one frozen table, with gates and a decision.

What must hold before a decision is a table of rules: those about the case, those about every
model's rows (one aggregate for all models) and those about the metrics. A later group is judged
only if the groups before it hold; a report lists all broken rules of its group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.local import freeze
from riskframe.functions.scalars import require_cost, require_probability
from riskframe.functions.values import quoted, valid_probability
from riskframe.operators.joins import same_rows
from riskframe.operators.metrics import compute_metrics
from riskframe.operators.predict import (
    DECISION_COL,
    PROBABILITY_COL,
    THRESHOLD_COL,
    PredictionError,
)
from riskframe.plans.train import RiskModel
from riskframe.session import durable
from riskframe.sources.frozen import evidence_identity, load_evaluation

# Metric names and decisions that reports of other tools share.
COMPARED = (
    "roc_auc",
    "pr_auc",
    "precision",
    "recall",
    "f1",
    "brier_score",
    "log_loss",
    "expected_cost",
    "expected_cost_per_sample",
)
COUNTS = ("tn", "fp", "fn", "tp")
BLOCKED = "blocked"
COSTS_DIFFER = "one comparison needs one price of a miss and one of a false alarm"


@dataclass(frozen=True)
class Gates:
    """Default promotion policy."""

    min_pr_auc: float = 0.10
    min_recall: float = 0.10
    max_regression: float = 0.02


@dataclass(frozen=True)
class ModelScores:
    """A model's columns on the frozen table and what it was trained to assume.

    ``decision_col`` and ``threshold_col`` name what the model itself decided and by which
    threshold; both are verified against its probabilities. Without them only the
    probabilities can be.
    """

    name: str
    probability_col: str
    threshold: float
    fn_cost: float = 25.0
    fp_cost: float = 1.0
    decision_col: str | None = None
    threshold_col: str | None = None

    def __post_init__(self) -> None:
        require_probability(self.threshold, "threshold")
        require_cost(self.fn_cost, "fn_cost")
        require_cost(self.fp_cost, "fp_cost")


def comparison_violations(
    frozen: DataFrame, label_col: str, models: Sequence[ModelScores]
) -> DataFrame:
    """One row per model: how many rows contradict its threshold, range or own decisions."""
    spark_null = F.lit(None)
    per_model = []
    for m in models:
        decided = spark_null if m.decision_col is None else quoted(m.decision_col)
        used = spark_null if m.threshold_col is None else quoted(m.threshold_col)
        per_model.append(
            F.struct(
                F.lit(m.name).alias("model"),
                F.lit(float(m.threshold)).alias("threshold"),
                quoted(m.probability_col).try_cast("double").alias("p"),
                decided.try_cast("double").alias("d"),
                used.try_cast("double").alias("t"),
                F.lit(m.decision_col is not None).alias("decides"),
                F.lit(m.threshold_col is not None).alias("tells"),
            )
        )
    rows = frozen.select(
        quoted(label_col).alias("label"), F.explode(F.array(*per_model)).alias("m")
    ).select("label", "m.*")
    expected = F.when(F.col("p") >= F.col("threshold"), 1.0).otherwise(0.0)
    same = F.abs(F.col("t") - F.col("threshold")) <= 1e-8 + 1e-5 * F.abs("threshold")

    def off(applies: Column, sound: Column, name: str) -> Column:
        return F.count_if(applies & ~F.coalesce(sound, F.lit(False))).alias(name)

    return rows.groupBy("model").agg(
        F.count("*").alias("row_count"),
        off(F.lit(True), valid_probability(F.col("p")), "invalid_probabilities"),
        off(F.col("decides"), F.col("d") == expected, "inconsistent_decisions"),
        off(F.col("tells"), same, "wrong_thresholds"),
        off(F.lit(True), F.col("label").isin(0, 1), "unusable_labels"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"),
    )


def long_scores(frozen: DataFrame, label_col: str, models: Sequence[ModelScores]) -> DataFrame:
    """``model, threshold, score, label``: one scan of the frozen table for all models."""
    per_model = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(m.name).alias("model"),
                    F.lit(float(m.threshold)).alias("threshold"),
                    quoted(m.probability_col).cast("double").alias("score"),
                )
                for m in models
            ]
        )
    )
    return frozen.select(quoted(label_col).cast("int").alias("label"), per_model.alias("m")).select(
        "m.model", "m.threshold", "m.score", "label"
    )


def model_metrics(frozen: DataFrame, label_col: str, models: Sequence[ModelScores]) -> DataFrame:
    """All metrics, one row per model, each at its own threshold."""
    costs = {(m.fn_cost, m.fp_cost) for m in models}
    if len(costs) != 1:
        raise PredictionError(COSTS_DIFFER)
    fn_cost, fp_cost = costs.pop()
    return compute_metrics(
        long_scores(frozen, label_col, models),
        "label",
        "score",
        "threshold",
        fn_cost,
        fp_cost,
        groups=["model"],
    )


def metric_rows(metrics: DataFrame) -> DataFrame:
    """``model, metric, value`` incl. confusion counts and threshold."""
    names = [*COMPARED, *COUNTS, "threshold"]
    return metrics.select("model", *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        ["model"], names, "metric", "value"
    )


def metric_differences(rows: DataFrame, candidate: str, champion: str) -> DataFrame:
    """``metric, candidate, champion, difference``."""
    return (
        rows.groupBy("metric")
        .agg(
            F.max(F.when(F.col("model") == candidate, F.col("value"))).alias("candidate"),
            F.max(F.when(F.col("model") == champion, F.col("value"))).alias("champion"),
        )
        .withColumn("difference", F.col("candidate") - F.col("champion"))
    )


def gate_table(metrics: DataFrame, candidate: str, champion: str | None, gates: Gates) -> DataFrame:
    """``gate, actual, required, passed``; without a champion regression does not apply."""

    def of(model: str, column: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(column)))

    values = metrics.agg(
        of(candidate, "pr_auc").alias("pr_auc"),
        of(candidate, "recall").alias("recall"),
        (
            F.lit(None).cast("double")
            if champion is None
            else of(candidate, "pr_auc") - of(champion, "pr_auc")
        ).alias("delta"),
    )

    def gate(name: str, actual: Column, required: float, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("gate"),
            actual.alias("actual"),
            F.lit(float(required)).alias("required"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    pr, recall, delta = F.col("pr_auc"), F.col("recall"), F.col("delta")
    regression = F.lit(True) if champion is None else delta >= F.lit(-gates.max_regression)
    return values.select(
        F.explode(
            F.array(
                gate("min_pr_auc", pr, gates.min_pr_auc, pr >= F.lit(gates.min_pr_auc)),
                gate("min_recall", recall, gates.min_recall, recall >= F.lit(gates.min_recall)),
                gate("max_champion_regression", delta, -gates.max_regression, regression),
            )
        ).alias("g")
    ).select("g.*")


def decision(gates: DataFrame, has_champion: bool) -> DataFrame:
    """One row: decision and number of failed gates."""
    good = "candidate_at_least_as_good" if has_champion else "promote_candidate_no_champion"
    passed = F.bool_and("passed")
    return gates.agg(
        F.when(passed, F.lit(good)).otherwise(F.lit("candidate_worse")).alias("decision"),
        F.count_if(~F.col("passed")).alias("failed_gates"),
    )


@dataclass(frozen=True)
class Case:
    """What is compared. The columns of all models are in ``frozen``."""

    frozen: DataFrame
    label_col: str
    models: tuple[ModelScores, ...]
    evidence: tuple[Mapping, Mapping] | None = None
    champion_frozen: DataFrame | None = None


def _other_rows(case: Case) -> bool:
    theirs = case.champion_frozen
    if theirs is None:
        return False
    if not set(theirs.columns) <= set(case.frozen.columns):
        return True
    return not same_rows(case.frozen.select(*[quoted(c) for c in theirs.columns]), theirs)


#: Rules about the case: name, when it is broken, what a report says.
CASE_RULES: tuple[tuple[str, Callable[[Case], bool], str], ...] = (
    ("costs", lambda c: len({(m.fn_cost, m.fp_cost) for m in c.models}) > 1, COSTS_DIFFER),
    (
        "evidence",
        lambda c: c.evidence is not None and dict(c.evidence[0]) != dict(c.evidence[1]),
        "the models name two evaluation tables",
    ),
    ("rows", _other_rows, "the champion was judged on other rows"),
)
#: Rules about a model's rows: a count of ``comparison_violations`` and what it counts.
ROW_RULES = {
    "invalid_probabilities": "scores that are no probability",
    "inconsistent_decisions": "decisions that its score and threshold do not give",
    "wrong_thresholds": "rows that state another threshold",
    "unusable_labels": "labels that are neither 0 nor 1",
}


def _broken_rows(case: Case) -> Iterator[str]:
    for row in comparison_violations(case.frozen, case.label_col, case.models).orderBy("model").collect():
        for count, what in ROW_RULES.items():
            if row[count]:
                yield f"{row.model} has {row[count]} {what}"
        for side in ("positives", "negatives"):
            if not row[side]:
                yield f"{row.model} meets no {side}"


def _broken_metrics(metrics: Mapping[str, Mapping]) -> Iterator[str]:
    for model, values in metrics.items():
        yield from (f"{model} has no {name}" for name in COMPARED if values[name] is None)


class _Blocked(Exception):
    """Broken rules of one group."""


def _demand(broken: Iterator[str]) -> None:
    found = list(broken)
    if found:
        raise _Blocked("; ".join(found))


def compare_models(
    frozen: DataFrame,
    label_col: str,
    candidate: ModelScores,
    champion: ModelScores | None = None,
    gates: Gates = Gates(),
    evidence: tuple[Mapping, Mapping] | None = None,
    champion_frozen: DataFrame | None = None,
) -> dict:
    """A report with the decision, or ``blocked`` and the broken rules.

    ``evidence`` are the two manifests' identities; ``champion_frozen`` is the champion's own copy of
    the table.
    """
    models = (candidate,) if champion is None else (candidate, champion)
    case = Case(frozen, label_col, models, evidence, champion_frozen)
    report: dict = {"decision": BLOCKED, "reason": "", "gates": [], "metrics": {}, "diff": {}}
    try:
        _demand(text for _, broken, text in CASE_RULES if broken(case))
        _demand(_broken_rows(case))
        metrics = freeze(model_metrics(frozen, label_col, models))
        report["metrics"] = {row.model: row.asDict() for row in metrics.collect()}
        _demand(_broken_metrics(report["metrics"]))
    except _Blocked as rules:
        return report | {"reason": str(rules)}
    rivals = None if champion is None else champion.name
    judged = freeze(gate_table(metrics, candidate.name, rivals, gates))
    verdict = decision(judged, champion is not None).first()
    report["gates"] = [r.asDict() for r in judged.collect()]
    if rivals is not None:
        rows = metric_differences(metric_rows(metrics), candidate.name, rivals).collect()
        report["diff"] = {r.metric: r.difference for r in rows}
    return report | {"decision": verdict.decision, "reason": f"gates not passed: {verdict.failed_gates}"}


def score_together(
    rows: DataFrame, label_col: str, models: Mapping[str, RiskModel]
) -> tuple[DataFrame, list[ModelScores]]:
    """Label and every model's probability, decision and threshold, by one scan of the rows.

    The raw row rides along as one struct, so every model prepares it by its own schema.
    """
    done: list[str] = []
    scores = []
    scored = rows.select(F.struct("*").alias("_row"))
    for i, (name, model) in enumerate(models.items()):
        kept = ["_row", *done]
        own = [f"_probability{i}", f"_decision{i}", f"_threshold{i}"]
        found = model.score(scored.select(*kept, "_row.*"), keep=kept)
        given = zip(own, (PROBABILITY_COL, DECISION_COL, THRESHOLD_COL))
        scored = found.select(*kept, *[F.col(c).alias(alias) for alias, c in given])
        done += own
        config = model.metadata.get("config", {})
        scores.append(
            ModelScores(
                name, own[0], model.threshold, config.get("fn_cost", 25.0), config.get("fp_cost", 1.0),
                own[1], own[2],
            )
        )
    return scored.select(F.col(f"_row.`{label_col}`").alias(label_col), *done), scores


def compare_saved_models(
    spark: SparkSession,
    evaluation: str,
    candidate: str | RiskModel,
    champion: str | RiskModel | None = None,
    gates: Gates = Gates(),
) -> dict:
    """Score the frozen rows with the models themselves, then :func:`compare_models`.

    Models are saved folders or loaded models. Rows must match the candidate's seal and the
    champion's seal must name the same table. A model that cannot score blocks the comparison.
    """
    blocked: dict[str, Any] = {"decision": BLOCKED, "gates": [], "metrics": {}, "diff": {}}
    try:
        given = {"candidate": candidate} | ({} if champion is None else {"champion": champion})
        models = {k: RiskModel.load(spark, m) if isinstance(m, str) else m for k, m in given.items()}
        seals = [m.metadata.get("evaluation") for m in models.values()]
        if None in seals:
            return blocked | {"reason": "a model names no evaluation table"}
        rows = load_evaluation(spark, evaluation, seals[0])
        identities = [evidence_identity(seal) for seal in seals]
        label_col = identities[0]["about.keys"][2]
        table, scores = score_together(rows, label_col, models)
        table = durable(table)
    except Exception as error:  # whatever a model does wrong is the finding
        return blocked | {"reason": f"not scored: {type(error).__name__}: {str(error).splitlines()[0][:300]}"}
    evidence = None if champion is None else (identities[0], identities[1])
    return compare_models(table, label_col, *scores, gates=gates, evidence=evidence)


def variant_table(
    selection: DataFrame,
    label_col: str,
    variant_col: str,
    score_col: str,
    threshold: float,
    fn_cost: float = 25.0,
    fp_cost: float = 1.0,
) -> DataFrame:
    """Metrics per model variant on one selection table."""
    return compute_metrics(
        selection, label_col, score_col, threshold, fn_cost, fp_cost, groups=[variant_col]
    )


def gates_passed(checks: DataFrame) -> DataFrame:
    """One row: whether every check of a ``passed`` column holds."""
    return checks.agg(F.bool_and("passed").alias("eligible"), F.count("*").alias("check_count"))
