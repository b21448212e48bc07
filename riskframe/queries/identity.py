"""Fingerprints and table equality."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import fingerprint, joins, split
from riskframe.plans import audit_job
from riskframe.queries.base import FIVE_WAY, SCORED, rounded, scored_events, table


def fingerprint_unordered(spark, folder):
    return fingerprint.table_fingerprint(table(spark, folder, "documents"))


def document_parts(spark, folder):
    """Documents by length as if it were time: the whole rows in five parts."""
    return split.five_way_split(table(spark, folder, "documents"), "n_chars", "doc_id")


def fingerprint_by_split(spark, folder):
    return fingerprint.table_fingerprint(document_parts(spark, folder), groups=["split"])


def fingerprint_ordered(spark, folder):
    return fingerprint.ordered_fingerprint(table(spark, folder, "documents"), "n_chars", "doc_id")


def split_identity(spark, folder):
    rows = document_parts(spark, folder).withColumn("long", (F.col("n_chars") > 2000).cast("int"))
    return rounded(audit_job.split_identity(rows, "split", "n_chars", "long"))


def row_identity(spark, folder):
    return fingerprint.row_identity_fingerprint(
        table(spark, folder, "events"), "ts", "event_id", "event_id"
    )


def category_tokens(spark, folder):
    return fingerprint.category_tokens(table(spark, folder, "events"), "props")


def row_differences(spark, folder):
    """Which rows, all columns compared, does the whole table hold beyond its labelled part."""
    documents = table(spark, folder, "documents")
    labelled = documents.join(table(spark, folder, "labels").select("doc_id"), "doc_id")
    return joins.row_differences(documents, labelled.select(documents.columns))


def observed_identity(spark, folder):
    return fingerprint.observed_identity(
        scored_events(spark, folder).withColumnRenamed("label", "y"), "event_id", "ts", "y"
    )


def _whole(column: str, tag: str) -> str:
    return f"'{tag}:' || length({column}::VARCHAR) || ':' || {column}"


def _combine(source: str, header: str, group: str = "") -> str:
    sums = " || '|' || ".join(
        f"sum(CAST('0x' || substr(h, {start}, {length}) AS BIGINT))"
        for start, length in fingerprint.LIMBS
    )
    by = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return (
        f"SELECT {by}count(*) AS row_count, sha256('{header}' || '|' || count(*) || '|' || {sums}) "
        f"AS fingerprint FROM {source} {tail}"
    )


def _polynomials(rows: str, header: str) -> str:
    """Digest of ``rows`` (``h`` in the order ``place``): every lane folded from left to right."""
    lanes = " || '|' || ".join(
        f"list_reduce(list_prepend(0::HUGEINT, list(CAST('0x' || substr(h, {start}, {length}) "
        f"AS BIGINT)::HUGEINT ORDER BY place)), lambda a, r: (a * {base} + r) % {fingerprint.PRIME})"
        for (start, length), base in zip(fingerprint.LANES, fingerprint.BASES)
    )
    return (
        f"SELECT count(*) AS row_count, sha256('{header}' || '|' || count(*) || '|' || {lanes}) "
        f"AS fingerprint FROM ({rows})"
    )


_KINDS = {"doc_id": "integer", "text": "string", "lang": "string", "source": "string", "n_chars": "integer"}
_ROW = " || '|' || ".join(_whole(c, k) for c, k in _KINDS.items())
_SORTED = " || '|' || ".join(
    _whole(c, _KINDS[c].replace("integer", "number")) for c in sorted(_KINDS)
)
_SORTED_HEADER = '["doc_id","lang","n_chars","source","text"]'
_SORTED_LONG = " || '|' || ".join(
    _whole(c, "string" if _KINDS.get(c) == "string" else "number") for c in sorted([*_KINDS, "long"])
)
_PARTS = (
    "scored AS (SELECT *, n_chars AS ts, doc_id AS event_id, "
    "CAST(n_chars > 2000 AS INTEGER) AS long FROM documents), "
    + FIVE_WAY.replace("FROM events", "FROM documents")
)

QUERIES = {
    "fingerprint_unordered": (
        fingerprint_unordered,
        f"""
        WITH t AS (SELECT sha256({_SORTED}) AS h FROM documents)
        {_combine('t', _SORTED_HEADER)}
        """,
    ),
    "fingerprint_by_split": (
        fingerprint_by_split,
        f"""
        WITH {_PARTS}, t AS (SELECT split, sha256({_SORTED}) AS h FROM split)
        {_combine('t', _SORTED_HEADER, 'split')}
        """,
    ),
    "fingerprint_ordered": (
        fingerprint_ordered,
        _polynomials(
            f"SELECT sha256({_ROW}) AS h, row_number() OVER (ORDER BY n_chars, doc_id) AS place "
            "FROM documents",
            '["doc_id","text","lang","source","n_chars"]',
        ),
    ),
    "split_identity": (
        split_identity,
        f"""
        WITH {_PARTS},
        t AS (SELECT split, sha256({_SORTED_LONG}) AS h FROM split),
        p AS ({_combine('t', '["doc_id","lang","long","n_chars","source","text"]', 'split')}),
        s AS (SELECT split, count(*) AS row_count, min(n_chars) AS dt_min, max(n_chars) AS dt_max,
                     CAST(sum(long) AS BIGINT) AS positives, round(avg(long), 9) AS positive_rate
              FROM split GROUP BY split)
        SELECT s.*, p.fingerprint, '{fingerprint.ALGORITHM}' AS fingerprint_algorithm
        FROM s JOIN p USING (split)
        """,
    ),
    "row_identity": (
        row_identity,
        _polynomials(
            f"SELECT sha256({_whole('event_id', 'integer')}) AS h, "
            "row_number() OVER (ORDER BY ts, event_id) AS place FROM events",
            '["event_id"]',
        ),
    ),
    "category_tokens": (
        category_tokens,
        "SELECT 'CATEGORY_' || sha256('string:' || props) AS token, count(*) AS row_count "
        "FROM events WHERE props IS NOT NULL GROUP BY props",
    ),
    "row_differences": (
        row_differences,
        f"""
        WITH a AS (SELECT *, 1 AS s FROM documents
                   UNION ALL SELECT d.*, -1 FROM documents d JOIN labels USING (doc_id))
        SELECT sha256({_ROW}) AS row_digest, CAST(sum(s) AS BIGINT) AS surplus
        FROM a GROUP BY ALL HAVING sum(s) <> 0
        """,
    ),
    "observed_identity": (
        observed_identity,
        f"""
        WITH {SCORED}
        SELECT count(*) AS row_count, count(*) FILTER (label = 0) AS label_0,
               count(*) FILTER (label = 1) AS label_1, min(ts) AS dt_min, max(ts) AS dt_max,
               count(*) - count(DISTINCT event_id) AS repeated_ids FROM scored
        """,
    ),
}
