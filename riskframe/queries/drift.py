"""Reference half against current half of the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import drift
from riskframe.operators.contract import Contract
from riskframe.plans.drift_report import run_drift
from riskframe.queries.base import rounded, table

MIDDLE = "2024-01-16"
CONTRACT = Contract(
    ("amount", "flat", "user"),
    ("key", "kind"),
    bins=10,
    top_k=10,
    probability="probability",
    decision="decision",
)


def sides(spark, folder):
    """Signups are missing in the reference, hence unknown later; amounts drift upwards."""
    events = table(spark, folder, "events")
    late = F.col("ts") >= F.lit(MIDDLE).cast(events.schema["ts"].dataType)
    kind = F.when(late | (F.col("event_type") != "signup"), F.col("event_type"))
    rows = events.select(
        late.alias("late"),
        F.when(F.col("event_type") != "view", F.col("value") * F.when(late, 1.2).otherwise(1.0))
        .alias("amount"),
        F.lit(5.0).alias("flat"),
        F.col("user_id").alias("user"),
        F.col("props").alias("key"),
        kind.alias("kind"),
        (F.col("value") / (F.col("value") + 50.0)).alias("probability"),
        F.when(F.col("event_type") == "click", F.lit(2))
        .otherwise((F.col("value") >= 50.0).cast("int"))
        .alias("decision"),
    )
    return rows.filter(~F.col("late")).drop("late"), rows.filter("late").drop("late")


def compared(spark, folder):
    reference, current = sides(spark, folder)
    state = drift.fit_reference(reference, CONTRACT)
    return state, drift.compare_current(state, current)


def numeric_profile(spark, folder):
    reference, current = sides(spark, folder)
    numeric = Contract(CONTRACT.numeric, ())
    profiles = [
        drift.profile_table(spark, drift.side_profile(df, numeric)[0])
        .drop("role")
        .withColumn("side", F.lit(name))
        for name, df in (("reference", reference), ("current", current))
    ]
    return rounded(profiles[0].unionByName(profiles[1]), 6)


def volume_profile(spark, folder):
    """The large table: profile of four columns in two scans."""
    lines = table(spark, folder, "lineitem")
    contract = Contract(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), ())
    rows, _ = drift.side_profile(lines, contract)
    return rounded(drift.profile_table(spark, rows).drop("role"), 6)


def bin_edges(spark, folder):
    reference, _ = sides(spark, folder)
    state = drift.fit_reference(reference, Contract(CONTRACT.numeric, ()))
    return rounded(
        state.bins.select(
            "feature", "strategy", "constant", F.posexplode_outer("edges").alias("place", "edge")
        ),
        6,
    )


def numeric_buckets(spark, folder):
    _, comparison = compared(spark, folder)
    return comparison.buckets.filter(F.col("kind") == "numeric").drop("kind", "position")


def category_buckets(spark, folder):
    _, comparison = compared(spark, folder)
    return comparison.buckets.filter(F.col("kind") == "categorical").drop("kind", "position")


def bucket_shares(spark, folder):
    _, comparison = compared(spark, folder)
    return rounded(drift.bucket_shares(comparison.buckets).drop("position"))


def total_variation(spark, folder):
    _, comparison = compared(spark, folder)
    return rounded(comparison.distances, 12)


def top_categories(spark, folder):
    documents = table(spark, folder, "documents")
    long = drift.categorical_long(documents, Contract((), ("lang", "source")))
    return drift.top_categories(drift.category_counts(long), 5)


def drift_checks(spark, folder):
    reference, current = sides(spark, folder)
    return rounded(run_drift(reference, current.withColumn("extra", F.lit(1)), CONTRACT).checks, 6)


def drift_rollup(spark, folder):
    reference, current = sides(spark, folder)
    return run_drift(reference, current.withColumn("extra", F.lit(1)), CONTRACT).summary


_SIDES = f"""
rows AS (
  SELECT ts >= TIMESTAMP '{MIDDLE}' AS late, event_type, value,
         CASE WHEN event_type <> 'view'
              THEN value * CASE WHEN ts >= TIMESTAMP '{MIDDLE}' THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END
              END AS amount,
         5.0::DOUBLE AS flat, user_id::DOUBLE AS "user", props AS key,
         CASE WHEN ts >= TIMESTAMP '{MIDDLE}' OR event_type <> 'signup' THEN event_type END AS kind,
         value / (value + 50.0::DOUBLE) AS probability,
         CASE WHEN event_type = 'click' THEN NULL ELSE (value >= 50)::INTEGER::DOUBLE END AS decision,
         event_type = 'click' AS bad_decision
  FROM events),
num AS (
  SELECT late, 'amount' AS feature, amount AS v FROM rows
  UNION ALL SELECT late, 'flat', flat FROM rows
  UNION ALL SELECT late, 'user', "user" FROM rows)
"""
_PROFILE = """
prof AS (
  SELECT late, feature, count(*) AS row_count, count(v) AS finite_count,
         count(*) - count(v) AS missing_count, CAST(0 AS BIGINT) AS invalid_count,
         avg(v) AS mean, stddev_pop(v) AS std, min(v) AS min, max(v) AS max,
         quantile_cont(v, 0.05) AS q05, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.95) AS q95
  FROM num GROUP BY late, feature)
"""
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in ("mean", "std", "min", "max", "q05", "q50", "q95"))
_PROBS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
_EDGES = f"""
edges AS (
  SELECT feature, CASE WHEN min(v) = max(v) THEN 'constant_reference' ELSE 'reference_quantiles' END
           AS strategy,
         CASE WHEN min(v) < max(v) THEN list_sort(list_distinct(quantile_cont(v, {_PROBS}))) END AS e,
         CASE WHEN min(v) = max(v) THEN min(v) END AS constant
  FROM num WHERE NOT late GROUP BY feature
  UNION ALL SELECT 'probability', 'fixed_probability_deciles', {_PROBS}::DOUBLE[], NULL)
"""
_NUMERIC = f"""
{_EDGES},
meas AS (SELECT late, feature, v FROM num
         UNION ALL SELECT late, 'probability', probability FROM rows),
placed AS (
  SELECT late, m.feature, CASE WHEN strategy = 'constant_reference'
           THEN CASE WHEN v < constant THEN 0 WHEN v > constant THEN 2 ELSE 1 END
           ELSE len(list_filter(e, lambda x: x <= v)) END AS i
  FROM meas m JOIN edges USING (feature) WHERE v IS NOT NULL),
every AS (
  SELECT feature, strategy, unnest(range(CASE WHEN strategy = 'constant_reference' THEN 3
                                              ELSE len(e) + 1 END)) AS i FROM edges),
nbuckets AS (
  SELECT feature, CASE WHEN strategy <> 'constant_reference' THEN 'BIN_' || lpad(i::VARCHAR, 2, '0')
           ELSE ['BELOW_CONSTANT', 'AT_CONSTANT', 'ABOVE_CONSTANT'][i + 1] END AS bucket,
         count(p.feature) FILTER (NOT late) AS reference_count,
         count(p.feature) FILTER (late) AS current_count
  FROM every LEFT JOIN placed p USING (feature, i) GROUP BY feature, strategy, i)
"""
_CATEGORY = """
cat AS (SELECT late, 'key' AS feature, 'string:' || key AS v FROM rows
        UNION ALL SELECT late, 'kind', 'string:' || kind FROM rows),
ranked AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, v) AS r
           FROM cat WHERE NOT late AND v IS NOT NULL GROUP BY feature, v),
routed AS (
  SELECT late, c.feature, CASE WHEN c.v IS NULL THEN 'MISSING' WHEN r IS NULL THEN 'UNKNOWN'
           WHEN r <= 10 THEN 'CATEGORY_' || sha256(c.v) ELSE 'OTHER' END AS bucket
  FROM cat c LEFT JOIN ranked k ON k.feature = c.feature AND k.v = c.v),
allc AS (SELECT feature, 'CATEGORY_' || sha256(v) AS bucket FROM ranked WHERE r <= 10
         UNION ALL SELECT f, b FROM (VALUES ('key'), ('kind')) f(f),
                                    (VALUES ('OTHER'), ('MISSING'), ('UNKNOWN')) b(b)),
cbuckets AS (
  SELECT feature, bucket, count(r.feature) FILTER (NOT late) AS reference_count,
         count(r.feature) FILTER (late) AS current_count
  FROM allc LEFT JOIN routed r USING (feature, bucket) GROUP BY feature, bucket)
"""
_TVD = """
bk AS (FROM nbuckets UNION ALL FROM cbuckets),
tot AS (SELECT *, sum(reference_count) OVER (PARTITION BY feature) AS nr,
               sum(current_count) OVER (PARTITION BY feature) AS nc FROM bk),
tvd AS (SELECT feature, sum(abs(reference_count * nc - current_count * nr))::DOUBLE
                        / (2 * max(nr) * max(nc))::DOUBLE AS total_variation
        FROM tot GROUP BY feature)
"""


def _verdict(observed: str, warn: float, breach: float) -> str:
    return (
        f"{warn}::DOUBLE AS warn, {breach}::DOUBLE AS breach, CASE WHEN {observed} IS NULL THEN "
        f"'NOT_EVALUATED' WHEN {observed} >= {breach} THEN 'BREACH' WHEN {observed} >= {warn} "
        f"THEN 'WARN' ELSE 'PASS' END AS status"
    )


def _row(check: str, feature: str, metric: str, observed: str, warn: float, breach: float) -> str:
    return (
        f"SELECT {check} AS check_id, {feature} AS feature, '{metric}' AS metric, "
        f"({observed})::DOUBLE AS observed, {_verdict(observed, warn, breach)}"
    )


def _passed(check: str, feature: str, metric: str, observed: str) -> str:
    return (
        f"SELECT {check} AS check_id, {feature} AS feature, '{metric}' AS metric, "
        f"({observed})::DOUBLE AS observed, NULL::DOUBLE AS warn, NULL::DOUBLE AS breach, "
        f"'PASS' AS status"
    )


_CHECKS = f"""
pair AS (SELECT r.feature, r.mean AS rm, r.std AS rs, c.mean AS cm,
                r.missing_count::DOUBLE / r.row_count AS rmiss,
                c.missing_count::DOUBLE / c.row_count AS cmiss
         FROM prof r JOIN prof c ON r.feature = c.feature AND NOT r.late AND c.late),
share AS (SELECT feature,
            abs(sum(current_count) FILTER (bucket = 'MISSING') / sum(current_count)
              - sum(reference_count) FILTER (bucket = 'MISSING') / sum(reference_count)) AS miss,
            sum(current_count) FILTER (bucket = 'UNKNOWN') / sum(current_count) AS unk
          FROM cbuckets GROUP BY feature),
pred AS (SELECT count(*) FILTER (late AND probability IS NOT NULL) AS np,
                abs(avg(probability) FILTER (late) - avg(probability) FILTER (NOT late)) AS mp,
                count(*) FILTER (late AND decision IS NOT NULL) AS nd,
                abs(avg(decision) FILTER (late) - avg(decision) FILTER (NOT late)) AS md,
                greatest(0, avg(bad_decision::INTEGER) FILTER (late)
                            - avg(bad_decision::INTEGER) FILTER (NOT late)) AS bd FROM rows),
ptv AS (SELECT total_variation AS t FROM tvd WHERE feature = 'probability'),
checks AS (
  {_passed("'feature.' || feature || '.column_presence'", "feature", "column_presence", "1.0")}
  FROM pair
  UNION ALL {_row("'feature.' || feature || '.missing_rate_shift'", "feature",
                  "absolute_missing_rate_shift", "abs(cmiss - rmiss)", 0.05, 0.1)} FROM pair
  UNION ALL {_row("'feature.' || feature || '.invalid_rate_increase'", "feature",
                  "invalid_rate_increase", "0.0", 0.01, 0.05)} FROM pair
  UNION ALL {_row("'feature.' || feature || '.distribution_shift'", "feature",
                  "total_variation_distance", "total_variation", 0.1, 0.2)}
  FROM tvd WHERE feature IN ('amount', 'flat', 'user')
  UNION ALL {_row("'feature.' || feature || '.standardized_mean_shift'", "feature",
                  "standardized_mean_shift", "CASE WHEN rs > 0 THEN abs(cm - rm) / rs END",
                  0.25, 0.5)} FROM pair
  UNION ALL {_passed("'feature.' || feature || '.column_presence'", "feature", "column_presence",
                     "1.0")} FROM share
  UNION ALL {_row("'feature.' || feature || '.missing_rate_shift'", "feature",
                  "absolute_missing_rate_shift", "miss", 0.05, 0.1)} FROM share
  UNION ALL {_row("'feature.' || feature || '.unknown_rate'", "feature", "unknown_category_rate",
                  "unk", 0.01, 0.05)} FROM share
  UNION ALL {_row("'feature.' || feature || '.distribution_shift'", "feature",
                  "total_variation_distance", "total_variation", 0.1, 0.2)}
  FROM tvd WHERE feature IN ('key', 'kind')
  UNION ALL {_passed("'prediction.probability.column_presence'", "'probability'",
                     "column_presence", "1.0")}
  UNION ALL {_passed("'prediction.probability.valid_data_availability'", "'probability'",
                     "valid_probability_count", "np")} FROM pred
  UNION ALL {_row("'prediction.probability.invalid_rate_increase'", "'probability'",
                  "invalid_probability_rate_increase", "0.0", 0.01, 0.05)}
  UNION ALL {_row("'prediction.probability.distribution_shift'", "'probability'",
                  "total_variation_distance", "t", 0.1, 0.2)} FROM ptv
  UNION ALL {_row("'prediction.probability.mean_shift'", "'probability'",
                  "absolute_mean_probability_shift", "mp", 0.05, 0.1)} FROM pred
  UNION ALL {_passed("'prediction.decision.column_presence'", "'decision'", "column_presence",
                     "1.0")}
  UNION ALL {_passed("'prediction.decision.valid_data_availability'", "'decision'",
                     "valid_decision_count", "nd")} FROM pred
  UNION ALL {_row("'prediction.decision.invalid_rate_increase'", "'decision'",
                  "invalid_decision_rate_increase", "bd", 0.01, 0.05)} FROM pred
  UNION ALL {_row("'prediction.decision.positive_rate_shift'", "'decision'",
                  "absolute_positive_decision_rate_shift", "md", 0.05, 0.1)} FROM pred
  UNION ALL SELECT 'schema.unexpected_current_columns', NULL, 'unexpected_current_column_count',
                   1.0::DOUBLE, NULL, NULL, 'WARN')
"""
_ALL = f"WITH {_SIDES}, {_PROFILE}, {_NUMERIC}, {_CATEGORY}, {_TVD}"

QUERIES = {
    "drift_numeric_profile": (
        numeric_profile,
        f"""
        WITH {_SIDES}, {_PROFILE}
        SELECT feature, row_count, finite_count, missing_count, invalid_count, {_ROUNDED},
               CASE WHEN late THEN 'current' ELSE 'reference' END AS side FROM prof
        """,
    ),
    "drift_volume_profile": (
        volume_profile,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, count(*) AS row_count, count({c}) AS finite_count,
            count(*) - count({c}) AS missing_count, CAST(0 AS BIGINT) AS invalid_count,
            round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, round(min({c}), 6) AS min,
            round(max({c}), 6) AS max, round(quantile_cont({c}, 0.05), 6) AS q05,
            round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.95), 6) AS q95
            FROM lineitem"""
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ),
    ),
    "drift_bins": (
        bin_edges,
        f"""
        WITH {_SIDES}, {_EDGES}
        SELECT feature, strategy, constant, CAST(place AS INTEGER) AS place, round(edge, 6) AS edge
        FROM (SELECT feature, strategy, constant, unnest(range(len(e))) AS place,
                     unnest(e) AS edge FROM edges WHERE e IS NOT NULL AND feature <> 'probability'
              UNION ALL SELECT feature, strategy, constant, NULL, NULL FROM edges WHERE e IS NULL)
        """,
    ),
    "drift_numeric_buckets": (numeric_buckets, f"WITH {_SIDES}, {_NUMERIC} SELECT * FROM nbuckets"),
    "drift_category_buckets": (
        category_buckets,
        f"WITH {_SIDES}, {_CATEGORY} SELECT * FROM cbuckets",
    ),
    "drift_bucket_shares": (
        bucket_shares,
        f"""
        {_ALL}
        SELECT feature, 'reference' AS side, bucket, reference_count AS row_count,
               round(reference_count::DOUBLE / nr, 9) AS share FROM tot
        UNION ALL SELECT feature, 'current', bucket, current_count,
                         round(current_count::DOUBLE / nc, 9) FROM tot
        """,
    ),
    "drift_total_variation": (
        total_variation,
        f"{_ALL} SELECT feature, round(total_variation, 12) AS total_variation FROM tvd",
    ),
    "drift_top_categories": (
        top_categories,
        """
        WITH c AS (SELECT 'lang' AS feature, 'string:' || lang AS value, count(*) AS row_count
                   FROM documents WHERE lang IS NOT NULL GROUP BY lang
                   UNION ALL SELECT 'source', 'string:' || source, count(*)
                   FROM documents WHERE source IS NOT NULL GROUP BY source),
        r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY row_count DESC, value)
                AS place FROM c)
        SELECT feature, value, row_count, CAST(place AS INTEGER) AS place FROM r WHERE place <= 5
        """,
    ),
    "drift_checks": (
        drift_checks,
        f"""
        {_ALL}, {_CHECKS}
        SELECT check_id, feature, metric, round(observed, 6) AS observed, warn, breach, status,
               CASE status WHEN 'BREACH' THEN 'ERROR' WHEN 'WARN' THEN 'WARNING' ELSE 'INFO' END
                 AS severity FROM checks
        """,
    ),
    "drift_rollup": (
        drift_rollup,
        f"""
        {_ALL}, {_CHECKS}
        SELECT count(*) FILTER (status = 'BREACH') AS n_breach,
               count(*) FILTER (status = 'NOT_EVALUATED') AS n_not_evaluated,
               count(*) FILTER (status = 'PASS') AS n_pass,
               count(*) FILTER (status = 'WARN') AS n_warn,
               CASE WHEN count(*) FILTER (status = 'BREACH') > 0 THEN 'BREACH'
                    WHEN count(*) FILTER (status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END
                 AS overall_status,
               CASE WHEN count(*) FILTER (status = 'BREACH') > 0 THEN 1 ELSE 0 END AS exit_code
        FROM checks
        """,
    ),
}
