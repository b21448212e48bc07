"""Joins, audits, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import audit, features, joins, sample, split
from riskframe.queries.base import (
    FIVE_WAY,
    SCORED,
    SEED,
    THREE_WAY,
    rounded,
    scored_events,
    table,
)


def labelled_documents(spark, folder):
    documents = table(spark, folder, "documents")
    return joins.attach_identity(documents, table(spark, folder, "labels"), "doc_id")


def left_join_identity(spark, folder):
    return labelled_documents(spark, folder)


def key_coverage(spark, folder):
    return rounded(
        joins.key_coverage(
            table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id"
        )
    )


def orphan_keys(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.orphan_keys(orders, lines, "o_orderkey")


def structural_checks(spark, folder):
    return audit.structural_checks(
        labelled_documents(spark, folder), "doc_id", "n_chars", "quality"
    )


def structural_checks_customer(spark, folder):
    return audit.structural_checks(table(spark, folder, "customer"), "c_nationkey", "c_acctbal")


def null_profile(spark, folder):
    return rounded(audit.null_profile(labelled_documents(spark, folder)))


def missing_summary(spark, folder):
    return rounded(audit.missing_summary(audit.null_profile(labelled_documents(spark, folder))))


def duplicate_keys(spark, folder):
    return audit.duplicate_keys(table(spark, folder, "orders"), "o_custkey")


def temporal_split(spark, folder):
    rows = split.temporal_split(scored_events(spark, folder), "ts", "event_id")
    return rows.select("event_id", "split")


def five_way_events(spark, folder):
    return split.five_way_split(scored_events(spark, folder), "ts", "event_id")


def five_way_split(spark, folder):
    return five_way_events(spark, folder).select("event_id", "split")


def two_way_split(spark, folder):
    rows = split.two_way_split(table(spark, folder, "orders"), "o_orderdate", "o_orderkey", 0.4)
    return rows.select("o_orderkey", "split")


def split_summary(spark, folder):
    return rounded(audit.split_summary(five_way_events(spark, folder), "split", "ts", "label"))


def reserved_summary(spark, folder):
    summary = audit.split_summary(five_way_events(spark, folder), "split", "ts", "label")
    return rounded(audit.reserve_columns(summary, "split", "final_test"))


def split_overlap(spark, folder):
    summary = audit.split_summary(five_way_events(spark, folder), "split", "ts", "label")
    return audit.time_overlaps(summary, "split")


def keys_in_two_splits(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "user_id")
    return joins.overlapping_keys(
        split.five_way_split(events, "ts", "event_id"), "user_id", "split"
    )


def systematic_sample(spark, folder):
    return sample.systematic_sample(
        table(spark, folder, "events"), "ts", "event_id", 1000
    ).select("event_id", "ts")


def sample_left_out(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    sampled = sample.systematic_sample(events, "ts", "event_id", 600)
    return sample.left_out(events, sampled, "event_id")


def first_rows(spark, folder):
    return features.first_rows(
        table(spark, folder, "events"), ["event_type", "value"], "ts", "event_id", 5
    )


def hash_sample(spark, folder):
    return sample.random_sample(table(spark, folder, "events"), "event_id", 750, SEED).select(
        "event_id", "event_type"
    )


def stratified_split(spark, folder):
    rows = split.stratified_split(
        scored_events(spark, folder),
        "event_id",
        "label",
        (0.70, 0.15, 0.15),
        ("train", "validation", "test"),
        SEED,
    )
    return rows.select("event_id", "split")


def five_way_random(spark, folder):
    rows = split.five_way_random(scored_events(spark, folder), "event_id", "label", seed=SEED)
    return rows.select("event_id", "split")


def stratified_halves(spark, folder):
    rows = split.stratified_halves(scored_events(spark, folder), "event_id", "label", 0.4, seed=SEED)
    return rows.select("event_id", "split")


_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS missing_count, "
    f"round((count(*) - count({c}))::DOUBLE / count(*), 9) AS missing_fraction FROM j"
    for c in _COLUMNS
)
_JOINED = """
j AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
      FROM documents d LEFT JOIN labels l USING (doc_id))
"""
_SUMMARY = """
SELECT split, count(*) AS row_count, min(ts) AS dt_min, max(ts) AS dt_max,
       CAST(sum(label) AS BIGINT) AS positives, round(avg(label), 9) AS positive_rate
FROM split GROUP BY split
"""
_HASHED = "CAST('0x' || substr(sha256('42:' || event_id), 1, 15) AS BIGINT)"

QUERIES = {
    "left_join_identity": (left_join_identity, f"WITH {_JOINED} SELECT * FROM j"),
    "key_coverage": (
        key_coverage,
        """
        WITH t AS (SELECT DISTINCT doc_id FROM documents), i AS (SELECT DISTINCT doc_id FROM labels)
        SELECT (SELECT count(*) FROM t) AS transaction_keys,
               (SELECT count(*) FROM i) AS identity_keys,
               (SELECT count(*) FROM i WHERE doc_id IN (FROM t)) AS matched_keys,
               (SELECT count(*) FROM i WHERE doc_id NOT IN (FROM t)) AS orphan_keys,
               round((SELECT count(*) FROM i)::DOUBLE / (SELECT count(*) FROM t), 9) AS coverage
        """,
    ),
    "orphan_keys": (
        orphan_keys,
        "SELECT DISTINCT o_orderkey FROM orders "
        "WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    ),
    "structural_checks": (
        structural_checks,
        f"""
        WITH {_JOINED}
        SELECT count(*) AS row_count, count(*) - count(DISTINCT doc_id) AS duplicate_ids,
               count(*) - count(doc_id) AS missing_ids,
               count(*) FILTER (n_chars < 0) AS negative_times,
               count(*) - count(n_chars) AS missing_times,
               count(*) FILTER (quality NOT IN (0, 1)) AS non_binary_labels,
               count(*) - count(quality) AS missing_labels
        FROM j
        """,
    ),
    "structural_checks_customer": (
        structural_checks_customer,
        """
        SELECT count(*) AS row_count, count(*) - count(DISTINCT c_nationkey) AS duplicate_ids,
               count(*) - count(c_nationkey) AS missing_ids,
               count(*) FILTER (c_acctbal < 0) AS negative_times,
               count(*) - count(c_acctbal) AS missing_times
        FROM customer
        """,
    ),
    "null_profile": (null_profile, f"WITH {_JOINED} {_PROFILE}"),
    "missing_summary": (
        missing_summary,
        f"""
        WITH {_JOINED}, p AS ({_PROFILE})
        SELECT max(missing_fraction) AS max_missing_fraction,
               count(*) FILTER (missing_fraction = 1.0) AS fully_missing_columns FROM p
        """,
    ),
    "duplicate_keys": (
        duplicate_keys,
        "SELECT o_custkey, count(*) AS row_count FROM orders GROUP BY o_custkey HAVING count(*) > 1",
    ),
    "temporal_split": (
        temporal_split,
        f"WITH {SCORED}, {THREE_WAY} SELECT event_id, split FROM split",
    ),
    "five_way_split": (
        five_way_split,
        f"WITH {SCORED}, {FIVE_WAY} SELECT event_id, split FROM split",
    ),
    "two_way_split": (
        two_way_split,
        """
        WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r,
                          count(*) OVER () AS n FROM orders)
        SELECT o_orderkey, CASE WHEN r <= greatest(1, least(n - 1,
                 CAST(round_even(n * 0.4::DOUBLE, 0) AS BIGINT)))
               THEN 'earlier' ELSE 'later' END AS split FROM r
        """,
    ),
    "split_summary": (split_summary, f"WITH {SCORED}, {FIVE_WAY} {_SUMMARY}"),
    "reserved_summary": (
        reserved_summary,
        f"""
        WITH {SCORED}, {FIVE_WAY}, s AS ({_SUMMARY})
        SELECT split, row_count,
               CASE WHEN split <> 'final_test' THEN dt_min END AS dt_min,
               CASE WHEN split <> 'final_test' THEN dt_max END AS dt_max,
               CASE WHEN split <> 'final_test' THEN positives END AS positives,
               CASE WHEN split <> 'final_test' THEN positive_rate END AS positive_rate,
               split = 'final_test' AS reserved FROM s
        """,
    ),
    "split_overlap": (
        split_overlap,
        f"""
        WITH {SCORED}, {FIVE_WAY}, s AS ({_SUMMARY})
        SELECT split, dt_min, dt_max,
               coalesce(dt_min < lag(dt_max) OVER (ORDER BY dt_min, dt_max), false) AS overlaps
        FROM s
        """,
    ),
    "keys_in_two_splits": (
        keys_in_two_splits,
        f"""
        WITH {SCORED}, {FIVE_WAY}
        SELECT user_id, min(split) AS first_split, max(split) AS last_split
        FROM split JOIN events USING (event_id) GROUP BY user_id HAVING min(split) <> max(split)
        """,
    ),
    "systematic_sample": (
        systematic_sample,
        """
        WITH r AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS r,
                          count(*) OVER () AS n FROM events),
        s AS (SELECT max(n) AS n FROM r),
        k AS (SELECT DISTINCT CASE WHEN i = 999 THEN n - 1
                ELSE CAST(floor(i::DOUBLE * ((n - 1)::DOUBLE / 999)) AS BIGINT) END AS r
              FROM range(1000) t(i), s)
        SELECT event_id, ts FROM r WHERE n <= 1000 OR r IN (SELECT r FROM k)
        """,
    ),
    "sample_left_out": (
        sample_left_out,
        """
        WITH r AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS r,
                          count(*) OVER () AS n FROM events),
        s AS (SELECT max(n) AS n FROM r),
        k AS (SELECT DISTINCT CASE WHEN i = 599 THEN n - 1
                ELSE CAST(floor(i::DOUBLE * ((n - 1)::DOUBLE / 599)) AS BIGINT) END AS r
              FROM range(600) t(i), s)
        SELECT event_id, ts FROM r WHERE r NOT IN (SELECT r FROM k)
        """,
    ),
    "first_rows": (
        first_rows,
        "SELECT event_type, value FROM events ORDER BY ts, event_id LIMIT 5",
    ),
    "hash_sample": (
        hash_sample,
        f"SELECT event_id, event_type FROM events ORDER BY {_HASHED}, event_id LIMIT 750",
    ),
    "stratified_split": (
        stratified_split,
        f"""
        WITH {SCORED}, r AS (
          SELECT event_id, row_number() OVER (PARTITION BY label ORDER BY {_HASHED}, event_id) AS r,
                 count(*) OVER (PARTITION BY label) AS n FROM scored)
        SELECT event_id,
               CASE WHEN r <= CAST(round_even(n * 0.7::DOUBLE, 0) AS BIGINT) THEN 'train'
                    WHEN r <= CAST(round_even(n * 0.7::DOUBLE, 0) AS BIGINT)
                            + CAST(round_even(n * 0.15::DOUBLE, 0) AS BIGINT) THEN 'validation'
                    ELSE 'test' END AS split FROM r
        """,
    ),
    "five_way_random": (
        five_way_random,
        f"""
        WITH {SCORED}, r AS (
          SELECT event_id, row_number() OVER (PARTITION BY label ORDER BY {_HASHED}, event_id) AS r,
                 count(*) OVER (PARTITION BY label) AS n FROM scored),
        a AS (SELECT *, CAST(round_even(n * 0.7::DOUBLE, 0) AS BIGINT) AS a,
                     CAST(round_even(n * 0.15::DOUBLE, 0) AS BIGINT) AS b FROM r),
        d AS (SELECT *, greatest(1, least(b - 1, CAST(round_even(b * 0.5::DOUBLE, 0) AS BIGINT))) AS d
              FROM a),
        c AS (SELECT *, greatest(1, least(d - 1, CAST(round_even(d * 0.5::DOUBLE, 0) AS BIGINT))) AS c
              FROM d)
        SELECT event_id,
               CASE WHEN r <= a THEN 'train' WHEN r <= a + c THEN 'calibration_fit'
                    WHEN r <= a + d THEN 'selection_validation'
                    WHEN r <= a + b THEN 'promotion_evaluation' ELSE 'final_test' END AS split
        FROM c
        """,
    ),
    "stratified_halves": (
        stratified_halves,
        f"""
        WITH {SCORED}, r AS (
          SELECT event_id, row_number() OVER (PARTITION BY label ORDER BY {_HASHED}, event_id) AS r,
                 count(*) OVER (PARTITION BY label) AS n FROM scored)
        SELECT event_id, CASE WHEN r <= greatest(1, least(n - 1,
                 CAST(round_even(n * 0.4::DOUBLE, 0) AS BIGINT)))
               THEN 'first' ELSE 'second' END AS split FROM r
        """,
    ),
}
