"""Metrics, thresholds, calibration and model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import calibrate, metrics, predict, split, threshold
from riskframe.plans import compare
from riskframe.queries.base import FIVE_WAY, SCORED, THREE_WAY, rounded, scored_events, table

FN_COST, FP_COST = 25.0, 1.0


def split_metrics(spark, folder):
    """Flagship: leakage-safe split, then decision metrics and cost of every split."""
    rows = split.temporal_split(scored_events(spark, folder), "ts", "event_id")
    found = metrics.confusion_metrics(
        rows, "label", "score", 0.5, FN_COST, FP_COST, groups=["split"]
    )
    return rounded(found)


def classification_metrics(spark, folder):
    return rounded(
        metrics.compute_metrics(
            scored_events(spark, folder), "label", "score", 0.5, FN_COST, FP_COST
        )
    )


def metrics_by_split(spark, folder):
    rows = split.five_way_split(scored_events(spark, folder), "ts", "event_id")
    return rounded(
        metrics.compute_metrics(
            rows, "label", "score", 0.5, FN_COST, FP_COST, groups=["split"]
        )
    )


def pr_curve(spark, folder):
    return metrics.precision_recall_curve(scored_events(spark, folder), "label", "score")


def volume_metrics(spark, folder):
    """Large table: returned lines against their discount, a score with few distinct values."""
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_discount") * 10.0).alias("score"),
        "l_linestatus",
    )
    return rounded(metrics.compute_metrics(lines, "label", "score", 0.5, groups=["l_linestatus"]))


def _threshold(strategy, **options):
    def run(spark, folder):
        return rounded(
            threshold.select_threshold(
                scored_events(spark, folder), "label", "score", strategy, **options
            )
        )

    return run


def comparison_violations(spark, folder):
    """A candidate whose decisions were taken before its scores were stretched."""
    score = F.col("score")
    frozen = scored_events(spark, folder).select(
        "label",
        "score",
        (score * 1.25).alias("stretched"),
        (score >= 0.5).cast("int").alias("decided"),
        F.lit(0.6).alias("used"),
    )
    models = [
        compare.ModelScores("candidate", "stretched", 0.5, decision_col="decided", threshold_col="used"),
        compare.ModelScores("champion", "score", 0.5),
    ]
    return compare.comparison_violations(frozen, "label", models)


def finite_output(spark, folder):
    """Logarithms of amounts and of their negatives: NaN and infinities on the way to JSON."""
    value = F.col("value")
    return predict.finite_output(
        table(spark, folder, "events").select(
            "event_id",
            F.when(value < 1, F.lit(float("inf"))).otherwise(value).alias("large"),
            F.when(value < 2, F.lit(float("nan"))).otherwise(-value).alias("unknown"),
        )
    )


def decisions(spark, folder):
    scored = scored_events(spark, folder).withColumnRenamed("score", predict.PROBABILITY_COL)
    return rounded(predict.decide(scored, 0.5, override=0.25).drop("ts"))


def prediction_violations(spark, folder):
    """Decisions taken at another threshold than the one they claim."""
    scored = scored_events(spark, folder).select(
        "label",
        (F.col("score") * 1.25).alias(predict.PROBABILITY_COL),
        (F.col("score") >= 0.5).cast("int").alias(predict.DECISION_COL),
        F.lit(0.5).alias(predict.THRESHOLD_COL),
    )
    return predict.prediction_violations(scored, 0.5, "label")


def document_scores(spark, folder):
    """A score per document, longer ones higher; labels exist for some documents only."""
    length = F.col("n_chars")
    return table(spark, folder, "documents").select(
        "doc_id", (length / (length + 1000.0)).alias("score")
    )


def aligned_metrics(spark, folder):
    """Only labelled documents are predicted on; every one of them must be."""
    labels = table(spark, folder, "labels")
    predictions = document_scores(spark, folder).join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = predict.align_predictions(labels, predictions, "doc_id", "quality")
    return rounded(metrics.compute_metrics(rows, "quality", "score", 0.5, FN_COST, FP_COST))


def alignment(spark, folder):
    return predict.alignment(
        table(spark, folder, "labels"), document_scores(spark, folder), "doc_id"
    )


def two_models(spark, folder):
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, folder, "events").select(
        (F.col("event_type") == "error").cast("int").alias("label"),
        (F.col("value") / (F.col("value") + 50.0)).alias("candidate"),
        (k / 100.0).alias("champion"),
    )


MODELS = (
    compare.ModelScores("candidate", "candidate", 0.40, FN_COST, FP_COST),
    compare.ModelScores("champion", "champion", 0.50, FN_COST, FP_COST),
)


def model_differences(spark, folder):
    found = compare.model_metrics(two_models(spark, folder), "label", MODELS)
    return rounded(
        compare.metric_differences(compare.metric_rows(found), "candidate", "champion")
    )


def promotion_gates(spark, folder):
    found = compare.model_metrics(two_models(spark, folder), "label", MODELS)
    return rounded(compare.gate_table(found, "candidate", "champion", compare.Gates()))


def promotion_decision(spark, folder):
    found = compare.model_metrics(two_models(spark, folder), "label", MODELS)
    gates = compare.gate_table(found, "candidate", "champion", compare.Gates())
    return compare.decision(gates, has_champion=True)


def gates_eligible(spark, folder):
    found = compare.model_metrics(two_models(spark, folder), "label", MODELS)
    return compare.gates_passed(
        compare.gate_table(found, "candidate", "champion", compare.Gates())
    )


def variant_table(spark, folder):
    rows = two_models(spark, folder).select(
        "label",
        F.explode(
            F.array(
                F.struct(F.lit("amount").alias("variant"), F.col("candidate").alias("score")),
                F.struct(F.lit("key").alias("variant"), F.col("champion").alias("score")),
                F.struct(
                    F.lit("mean").alias("variant"),
                    ((F.col("candidate") + F.col("champion")) / 2.0).alias("score"),
                ),
            )
        ).alias("v"),
    )
    flat = rows.select("label", "v.variant", "v.score")
    return rounded(compare.variant_table(flat, "label", "variant", "score", 0.5))


def final_test_metrics(spark, folder):
    rows = split.five_way_split(scored_events(spark, folder), "ts", "event_id")
    final = rows.filter(F.col("split") == "final_test")
    return rounded(
        metrics.compute_metrics(final, "label", "score", 0.5, FN_COST, FP_COST)
    )


def _calibrated(strategy):
    def run(spark, folder):
        rows = split.five_way_split(scored_events(spark, folder), "ts", "event_id")
        fit_on = rows.filter(F.col("split") == "calibration_fit")
        apply_to = rows.filter(F.col("split") == "selection_validation")
        fitted = calibrate.fit_calibrator(fit_on, "score", "label", strategy)
        return fitted.apply(apply_to, "score", "calibrated").select(
            "event_id", "label", "score", F.round("calibrated", 6).alias("calibrated")
        )

    return run


def _metrics_sql(
    source: str,
    key: str | None,
    limit: str = "0.5",
    costs: bool = True,
    digits: int = 9,
) -> str:
    """Row-per-score metrics of ``source(key, label, score)``."""
    by = f"{key}, " if key else ""
    part = f"PARTITION BY {key}" if key else ""
    group = f"GROUP BY {key}" if key else ""
    cost = (
        f""", fn * 25.0::DOUBLE + fp * 1.0::DOUBLE AS expected_cost,
        round((fn * 25.0::DOUBLE + fp * 1.0::DOUBLE) / (p + n), {digits}) AS expected_cost_per_sample"""
        if costs
        else ""
    )
    return f"""
    g AS (SELECT {by}score, sum(label) AS pos, sum(1 - label) AS neg FROM {source}
          GROUP BY {by}score),
    c AS (SELECT *, sum(pos) OVER w AS tp_at, sum(neg) OVER w AS fp_at FROM g
          WINDOW w AS ({part} ORDER BY score DESC)),
    a AS (SELECT {by}CAST(sum(pos) AS BIGINT) AS p, CAST(sum(neg) AS BIGINT) AS n,
            sum(neg * (2 * (tp_at - pos) + pos))::DOUBLE AS pairs,
            sum(pos * (tp_at::DOUBLE / (tp_at + fp_at))) AS gain,
            sum(pos * (1 - score) * (1 - score) + neg * score * score) AS sq,
            sum(-pos * CASE WHEN pos > 0 THEN ln(greatest(score, 2.220446049250313e-16)) ELSE 0 END
                -neg * CASE WHEN neg > 0
                            THEN ln(greatest(1 - score, 2.220446049250313e-16)) ELSE 0 END) AS ll,
            CAST(coalesce(sum(neg) FILTER (score < {limit}), 0) AS BIGINT) AS tn,
            CAST(coalesce(sum(neg) FILTER (score >= {limit}), 0) AS BIGINT) AS fp,
            CAST(coalesce(sum(pos) FILTER (score < {limit}), 0) AS BIGINT) AS fn,
            CAST(coalesce(sum(pos) FILTER (score >= {limit}), 0) AS BIGINT) AS tp
          FROM c {group}),
    m AS (SELECT {by}
            round(pairs / (2.0::DOUBLE * p * n), {digits}) AS roc_auc, round(gain / p, {digits}) AS pr_auc,
            round(ll / (p + n), {digits}) AS log_loss, round(sq / (p + n), {digits}) AS brier_score,
            round(p::DOUBLE / (p + n), {digits}) AS base_rate, p + n AS n_samples, tn, fp, fn, tp,
            0.5::DOUBLE AS threshold,
            CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp::DOUBLE / (tp + fp), {digits}) END AS precision,
            CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp::DOUBLE / (tp + fn), {digits}) END AS recall,
            CASE WHEN 2 * tp + fp + fn = 0 THEN 0
                 ELSE round(2.0::DOUBLE * tp / (2 * tp + fp + fn), {digits}) END AS f1 {cost}
          FROM a)
    """


_CURVE = """
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score),
c AS (SELECT score, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
             sum(pos) OVER () AS p FROM g WINDOW w AS (ORDER BY score DESC))
"""


def _threshold_row(strategy: str, source: str) -> str:
    return f"""
    SELECT '{strategy}' AS strategy, round(score, 9) AS threshold,
           CAST((p - tp) * 25 + fp AS DOUBLE) AS expected_cost,
           25.0::DOUBLE AS false_negative_cost, 1.0::DOUBLE AS false_positive_cost
    FROM {source}
    """


_TWO_MODELS = """
two AS (SELECT CAST(event_type = 'error' AS INTEGER) AS label,
               value / (value + 50.0::DOUBLE) AS candidate,
               CAST(json_extract(props, '$.k') AS DOUBLE) / 100.0::DOUBLE AS champion FROM events),
lng AS (SELECT 'candidate' AS model, 0.4::DOUBLE AS lim, candidate AS score, label FROM two
        UNION ALL SELECT 'champion', 0.5::DOUBLE, champion, label FROM two)
"""
_COMPARED = [*compare.COMPARED, *compare.COUNTS]
_MODEL_ROWS = f"""
per AS (SELECT a.*, b.lim FROM m a JOIN (SELECT DISTINCT model, lim FROM lng) b USING (model)),
vals AS (
  {" UNION ALL ".join(f"SELECT model, '{c}' AS metric, {c}::DOUBLE AS v FROM per" for c in _COMPARED)}
  UNION ALL SELECT model, 'threshold', lim FROM per)
"""
_GATES = """
gv AS (SELECT max(pr_auc) FILTER (model = 'candidate') AS pr,
              max(recall) FILTER (model = 'candidate') AS rc,
              max(pr_auc) FILTER (model = 'candidate')
                - max(pr_auc) FILTER (model = 'champion') AS delta FROM m),
gates AS (
  SELECT 'min_pr_auc' AS gate, round(pr, 9) AS actual, 0.1::DOUBLE AS required,
         pr >= 0.1 AS passed FROM gv
  UNION ALL SELECT 'min_recall', round(rc, 9), 0.1::DOUBLE, rc >= 0.1 FROM gv
  UNION ALL SELECT 'max_champion_regression', round(delta, 9), -0.02::DOUBLE, delta >= -0.02
  FROM gv)
"""


def _two_model_metrics() -> str:
    """Each model at its own threshold; rounded only once, by the query around it."""
    own = "CASE model WHEN 'candidate' THEN 0.4 ELSE 0.5 END"
    return _metrics_sql("lng", "model", own, digits=16)


# The isotonic value of a point is the largest, over starts up to it, of the least mean to an end
# from it on.
CALIBRATE_ISOTONIC = f"""
WITH {SCORED}, {FIVE_WAY},
fit AS (
  SELECT score, sum(label) AS pos, count(*) AS n FROM split
  WHERE split = 'calibration_fit' GROUP BY score),
points AS (
  SELECT score, row_number() OVER up AS i, pos, n, sum(pos) OVER up AS p, sum(n) OVER up AS m
  FROM fit WINDOW up AS (ORDER BY score)),
means AS (
  SELECT a.i AS a, b.i AS b, (b.p - a.p + a.pos)::DOUBLE / (b.m - a.m + a.n)::DOUBLE AS mean
  FROM points a JOIN points b ON a.i <= b.i),
least AS (
  SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS mean
  FROM means),
knots AS (
  SELECT score AS knot, v FROM points JOIN (SELECT b AS i, max(mean) AS v FROM least GROUP BY b) USING (i))
SELECT event_id, label, score,
       round(CASE WHEN lo.knot IS NULL THEN hi.v WHEN hi.knot IS NULL OR hi.knot = lo.knot THEN lo.v
             ELSE lo.v + (hi.v - lo.v) * (score - lo.knot) / (hi.knot - lo.knot) END, 6) AS calibrated
FROM split
ASOF LEFT JOIN knots lo ON score >= lo.knot
ASOF LEFT JOIN knots hi ON score <= hi.knot
WHERE split = 'selection_validation'
"""

QUERIES = {
    "split_metrics": (
        split_metrics,
        f"""
        WITH {SCORED}, {THREE_WAY}, k AS (
          SELECT split, count(*) FILTER (score < 0.5 AND label = 0) AS tn,
                 count(*) FILTER (score >= 0.5 AND label = 0) AS fp,
                 count(*) FILTER (score < 0.5 AND label = 1) AS fn,
                 count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) AS n_samples
          FROM split GROUP BY split)
        SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp::DOUBLE / (tp + fp), 9) END AS precision,
               CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp::DOUBLE / (tp + fn), 9) END AS recall,
               CASE WHEN 2 * tp + fp + fn = 0 THEN 0
                    ELSE round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 9) END AS f1,
               fn * 25.0::DOUBLE + fp AS expected_cost,
               round((fn * 25.0::DOUBLE + fp) / n_samples, 9) AS expected_cost_per_sample
        FROM k
        """,
    ),
    "classification_metrics": (
        classification_metrics,
        f"WITH {SCORED}, {_metrics_sql('scored', None)} SELECT * FROM m",
    ),
    "metrics_by_split": (
        metrics_by_split,
        f"WITH {SCORED}, {FIVE_WAY}, {_metrics_sql('split', 'split')} SELECT * FROM m",
    ),
    "final_test_metrics": (
        final_test_metrics,
        f"""
        WITH {SCORED}, {FIVE_WAY}, fin AS (SELECT * FROM split WHERE split = 'final_test'),
        {_metrics_sql('fin', None)} SELECT * FROM m
        """,
    ),
    "volume_metrics": (
        volume_metrics,
        f"""
        WITH rows AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
                             l_discount * 10.0::DOUBLE AS score, l_linestatus FROM lineitem),
        {_metrics_sql('rows', 'l_linestatus', costs=False)} SELECT * FROM m
        """,
    ),
    "aligned_metrics": (
        aligned_metrics,
        f"""
        WITH al AS (SELECT quality AS label, n_chars / (n_chars + 1000.0::DOUBLE) AS score
                    FROM labels JOIN documents USING (doc_id)),
        {_metrics_sql('al', None)} SELECT * FROM m
        """,
    ),
    "alignment": (
        alignment,
        """
        SELECT (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
                 AS without_prediction,
               (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
                 AS without_label,
               (SELECT count(*) FROM (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1
                UNION SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)) AS repeated
        """,
    ),
    "pr_curve": (
        pr_curve,
        f"""
        WITH {SCORED}, {_CURVE}
        SELECT score, tp, fp, tp::DOUBLE / (tp + fp) AS precision FROM c
        """,
    ),
    "threshold_fixed": (
        _threshold("fixed"),
        f"""
        WITH {SCORED}, r AS (
          SELECT 0.5::DOUBLE AS score, sum(label) AS p, count(*) FILTER (score >= 0.5 AND label = 1)
            AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp FROM scored)
        {_threshold_row('fixed', 'r')}
        """,
    ),
    "threshold_best_f1": (
        _threshold("best_f1"),
        f"""
        WITH {SCORED}, {_CURVE}, b AS (
          SELECT * FROM c ORDER BY 2.0::DOUBLE * tp / (p + tp + fp) DESC, score LIMIT 1)
        {_threshold_row('best_f1', 'b')}
        """,
    ),
    "threshold_target_recall": (
        _threshold("target_recall", target_recall=0.8),
        f"""
        WITH {SCORED}, {_CURVE}, b AS (
          SELECT * FROM c WHERE tp::DOUBLE / p >= 0.8 ORDER BY score DESC LIMIT 1)
        {_threshold_row('target_recall', 'b')}
        """,
    ),
    "threshold_min_cost": (
        _threshold("cost_based"),
        f"""
        WITH {SCORED}, {_CURVE},
        b AS (SELECT * FROM c ORDER BY (p - tp) * 25 + fp, score LIMIT 1)
        {_threshold_row('cost_based', 'b')}
        """,
    ),
    "threshold_min_cost_grid": (
        _threshold("cost_based", candidates=200),
        f"""
        WITH {SCORED}, {_CURVE},
        d AS (SELECT score, tp, fp, p, row_number() OVER (ORDER BY score) - 1 AS i,
                     count(*) OVER () AS m FROM c),
        h AS (SELECT j, (m - 1) * CASE WHEN j = 199
                     THEN 1.0::DOUBLE ELSE j * (1.0::DOUBLE / 199) END AS h
              FROM range(200) t(j), (SELECT max(m) AS m FROM d)),
        k AS (SELECT lo.score AS a, hi.score AS b, h - floor(h) AS f,
                     lo.tp AS tp_a, lo.fp AS fp_a, hi.tp AS tp_b, hi.fp AS fp_b, lo.p
              FROM h JOIN d lo ON lo.i = CAST(floor(h) AS BIGINT)
                     JOIN d hi ON hi.i = CAST(ceil(h) AS BIGINT)),
        t AS (SELECT *, CASE WHEN f < 0.5 THEN a + (b - a) * f ELSE b - (b - a) * (1 - f) END AS score
              FROM k),
        r AS (SELECT score, p, CASE WHEN score <= a THEN tp_a ELSE tp_b END AS tp,
                     CASE WHEN score <= a THEN fp_a ELSE fp_b END AS fp FROM t),
        b AS (SELECT * FROM r ORDER BY (p - tp) * 25 + fp, score LIMIT 1)
        {_threshold_row('cost_based', 'b')}
        """,
    ),
    "finite_output": (
        finite_output,
        "SELECT event_id, CASE WHEN value >= 1 THEN value END AS large, "
        "CASE WHEN value >= 2 THEN -value END AS unknown FROM events",
    ),
    "decisions": (
        decisions,
        f"""
        WITH {SCORED}
        SELECT event_id, label, round(score, 9) AS fraud_probability,
               CAST(score >= 0.25 AS INTEGER) AS fraud_prediction, 0.25::DOUBLE AS threshold
        FROM scored
        """,
    ),
    "prediction_violations": (
        prediction_violations,
        f"""
        WITH {SCORED}, q AS (SELECT label, score * 1.25::DOUBLE AS p,
                                    CAST(score >= 0.5 AS INTEGER) AS d FROM scored)
        SELECT count(*) AS row_count, count(*) FILTER (p > 1) AS invalid_probabilities,
               count(*) FILTER (d <> CAST(p >= 0.5 AS INTEGER)) AS inconsistent_decisions,
               CAST(0 AS BIGINT) AS wrong_thresholds, count(*) FILTER (label = 1) AS positives,
               count(*) FILTER (label = 0) AS negatives FROM q
        """,
    ),
    "comparison_violations": (
        comparison_violations,
        f"""
        WITH {SCORED}, q AS (SELECT label, score * 1.25::DOUBLE AS p,
                                    CAST(score >= 0.5 AS INTEGER) AS d FROM scored),
        m AS (SELECT 'candidate' AS model, label, p, d FROM q
              UNION ALL SELECT 'champion', label, p / 1.25::DOUBLE, NULL FROM q)
        SELECT model, count(*) AS row_count,
               count(*) FILTER (NOT p BETWEEN 0 AND 1) AS invalid_probabilities,
               count(*) FILTER (d <> CAST(p >= 0.5 AS INTEGER)) AS inconsistent_decisions,
               CASE model WHEN 'candidate' THEN count(*) ELSE 0 END AS wrong_thresholds,
               CAST(0 AS BIGINT) AS unusable_labels, count(*) FILTER (label = 1) AS positives,
               count(*) FILTER (label = 0) AS negatives FROM m GROUP BY model
        """,
    ),
    "model_differences": (
        model_differences,
        f"""
        WITH {_TWO_MODELS}, {_two_model_metrics()}, {_MODEL_ROWS}
        SELECT metric, round(max(v) FILTER (model = 'candidate'), 9) AS candidate,
               round(max(v) FILTER (model = 'champion'), 9) AS champion,
               round(max(v) FILTER (model = 'candidate')
                     - max(v) FILTER (model = 'champion'), 9) AS difference
        FROM vals GROUP BY metric
        """,
    ),
    "promotion_gates": (
        promotion_gates,
        f"WITH {_TWO_MODELS}, {_two_model_metrics()}, {_GATES} SELECT * FROM gates",
    ),
    "promotion_decision": (
        promotion_decision,
        f"""
        WITH {_TWO_MODELS}, {_two_model_metrics()}, {_GATES}
        SELECT CASE WHEN bool_and(passed) THEN 'candidate_at_least_as_good'
                    ELSE 'candidate_worse' END AS decision,
               count(*) FILTER (NOT passed) AS failed_gates FROM gates
        """,
    ),
    "gates_eligible": (
        gates_eligible,
        f"""
        WITH {_TWO_MODELS}, {_two_model_metrics()}, {_GATES}
        SELECT bool_and(passed) AS eligible, count(*) AS check_count FROM gates
        """,
    ),
    "variant_table": (
        variant_table,
        f"""
        WITH {_TWO_MODELS}, vr AS (
          SELECT label, 'amount' AS variant, candidate AS score FROM two
          UNION ALL SELECT label, 'key', champion FROM two
          UNION ALL SELECT label, 'mean', (candidate + champion) / 2.0::DOUBLE FROM two),
        {_metrics_sql('vr', 'variant')} SELECT * FROM m
        """,
    ),
    "calibrate_sigmoid": (_calibrated("sigmoid"), None),
    "calibrate_isotonic": (_calibrated("isotonic"), CALIBRATE_ISOTONIC),
}
