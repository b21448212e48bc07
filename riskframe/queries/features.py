"""Feature roles, fitted state and prepared rows, fitted on the training split."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import features, split
from riskframe.queries.base import FIVE_WAY, rounded, table

ROLES = ("event_id", "label", "ts")


def transactions(spark, folder):
    """Events with a missing amount where the event carries none, and missing categories."""
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("amount"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
    )


def train_and_rest(spark, folder):
    rows = split.five_way_split(transactions(spark, folder), "ts", "event_id")
    return rows.filter(F.col("split") == "train").drop("split"), rows.drop("split")


def column_roles(spark, folder):
    train, _ = train_and_rest(spark, folder)
    return features.column_roles(train, ROLES, 100, features.FREQUENCY_HIGH_CARDINALITY)


def distinct_counts(spark, folder):
    return features.distinct_counts(transactions(spark, folder), ["kind", "user"])


def fitted_medians(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(
        features.fit_medians(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    )


def median_impute(spark, folder):
    train, rows = train_and_rest(spark, folder)
    schema = features.FeatureSchema(("amount", "k"), ("kind",))
    medians = {
        r.feature: r["median"]
        for r in features.fit_medians(features.align(train, schema), schema.numeric).collect()
    }
    aligned = features.align(rows, schema, ["event_id"])
    return rounded(features.impute(aligned, schema, medians))


def fitted_codes(spark, folder):
    train, _ = train_and_rest(spark, folder)
    return features.fit_codes(train, ["kind", "user"])


def fitted_frequencies(spark, folder):
    train, _ = train_and_rest(spark, folder)
    return rounded(features.fit_frequencies(train, ["kind", "user"]))


def align_columns(spark, folder):
    """Text amounts, an extra column and a fitted column the table lacks."""
    rows = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", F.lit("n/a"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("amount"),
        "event_type",
        "props",
    )
    schema = features.FeatureSchema(("amount", "absent"), ("event_type",))
    return features.align(rows, schema, ["event_id"])


def prepared_rows(spark, folder):
    """The whole fitted preparation, applied to every row."""
    train, rows = train_and_rest(spark, folder)
    schema = features.infer_schema(train, ROLES, 100, features.FREQUENCY_HIGH_CARDINALITY)
    model = features.FeaturePreparer(schema).fit(train)
    return rounded(model.prepare(rows, ["event_id"]))


_TX = """
scored AS (
  SELECT event_id, ts, CAST(event_type = 'error' AS INTEGER) AS label,
         CASE WHEN event_type <> 'signup' THEN value END AS amount,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type <> 'view' THEN event_type END AS kind,
         'u' || user_id AS "user"
  FROM events)
"""
_TRAIN = f"{_TX}, {FIVE_WAY}, train AS (SELECT * FROM split WHERE split = 'train')"
_CATEGORIES = """
cats AS (SELECT 'kind' AS feature, coalesce(kind, '__missing__') AS value FROM train
         UNION ALL SELECT 'user', coalesce("user", '__missing__') FROM train)
"""

QUERIES = {
    "column_roles": (
        column_roles,
        f"""
        WITH {_TRAIN}, d AS (SELECT count(DISTINCT kind) AS kind, count(DISTINCT "user") AS u FROM train)
        SELECT 'amount' AS column_name, 'numeric' AS role, CAST(NULL AS BIGINT) AS distinct_values
        UNION ALL SELECT 'k', 'numeric', NULL
        UNION ALL SELECT 'kind', CASE WHEN kind <= 100 THEN 'ordinal' ELSE 'frequency' END, kind FROM d
        UNION ALL SELECT 'user', CASE WHEN u <= 100 THEN 'ordinal' ELSE 'frequency' END, u FROM d
        """,
    ),
    "distinct_counts": (
        distinct_counts,
        f"""
        WITH {_TX}
        SELECT 'kind' AS feature, count(DISTINCT kind) AS distinct_values FROM scored
        UNION ALL SELECT 'user', count(DISTINCT "user") FROM scored
        """,
    ),
    "fitted_medians": (
        fitted_medians,
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(median({c}), 9) AS median FROM lineitem"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ),
    ),
    "median_impute": (
        median_impute,
        f"""
        WITH {_TRAIN}, md AS (SELECT median(amount) AS a, median(k) AS k FROM train)
        SELECT event_id, round(coalesce(s.amount, md.a), 9) AS amount,
               coalesce(s.k::DOUBLE, md.k) AS k, coalesce(kind, '__missing__') AS kind
        FROM scored s, md
        """,
    ),
    "fitted_codes": (
        fitted_codes,
        f"""
        WITH {_TRAIN}, {_CATEGORIES}
        SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1
                                    AS DOUBLE) AS code
        FROM (SELECT DISTINCT feature, value FROM cats)
        """,
    ),
    "fitted_frequencies": (
        fitted_frequencies,
        f"""
        WITH {_TRAIN}, {_CATEGORIES}
        SELECT feature, value,
               round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY feature), 9) AS frequency
        FROM cats GROUP BY feature, value
        """,
    ),
    "align_columns": (
        align_columns,
        """
        SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE user_id::DOUBLE END AS amount,
               CAST(NULL AS DOUBLE) AS absent, event_type FROM events
        """,
    ),
    "prepared_rows": (
        prepared_rows,
        f"""
        WITH {_TRAIN}, {_CATEGORIES},
        md AS (SELECT median(amount) AS a, median(k) AS k FROM train),
        codes AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1
                    AS code FROM (SELECT DISTINCT feature, value FROM cats)),
        freq AS (SELECT feature, value, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY feature)
                   AS f FROM cats GROUP BY feature, value),
        wide AS (SELECT count(DISTINCT "user") > 100 AS w FROM train)
        SELECT s.event_id, round(coalesce(s.amount, md.a), 9) AS amount,
               coalesce(s.k::DOUBLE, md.k) AS k, coalesce(c.code, -1)::DOUBLE AS kind,
               round(CASE WHEN w THEN coalesce(f.f, 0.0) ELSE coalesce(u.code, -1) END, 9) AS "user"
        FROM scored s CROSS JOIN md CROSS JOIN wide
        LEFT JOIN codes c ON c.feature = 'kind' AND c.value = coalesce(s.kind, '__missing__')
        LEFT JOIN codes u ON u.feature = 'user' AND u.value = coalesce(s."user", '__missing__')
        LEFT JOIN freq f ON f.feature = 'user' AND f.value = coalesce(s."user", '__missing__')
        """,
    ),
}
