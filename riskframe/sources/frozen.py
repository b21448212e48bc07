"""Frozen evaluation tables: rows as Parquet beside a seal that pins what they are.

The seal has three parts: ``about`` says where the rows come from, ``shape`` lists columns and
types, ``content`` is measured by Spark on the written rows. Opening a table measures it again
and compares; two tables are the same evidence if their seals agree in all three.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.canonical import DIGEST_PATTERN
from riskframe.functions.values import quoted
from riskframe.operators.fingerprint import (
    ALGORITHM,
    observed_identity,
    ordered_fingerprint,
    row_identity_fingerprint,
    table_fingerprint,
)
from riskframe.sources.sinks import read_json_document, write_json_document

LAYOUT = 2
ROLE = "promotion"


class EvaluationTableError(RuntimeError):
    """The frozen table or its seal is absent, broken or not what it claims."""


def _digest(value: Any) -> bool:
    return isinstance(value, str) and re.match(DIGEST_PATTERN, value) is not None


def _count(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and value > 0


#: Dotted entry -> what it must satisfy. Every entry must be there.
RULES: dict[str, Callable[[Any], bool]] = {
    "about.layout": lambda v: v == LAYOUT,
    "about.role": lambda v: v == ROLE,
    "about.split": lambda v: isinstance(v, str) and v != "",
    "about.source": lambda v: isinstance(v, str) and v != "",
    "about.source_digests": lambda v: isinstance(v, Mapping) and bool(v) and all(v.values()),
    "about.keys": lambda v: isinstance(v, (list, tuple)) and len(v) == 3,
    "shape": lambda v: isinstance(v, (list, tuple)) and len(v) > 0,
    "content.digest_kind": lambda v: v == ALGORITHM,
    "content.rows": _count,
    "content.ordered_digest": _digest,
    "content.id_digest": _digest,
    "content.stored_digest": _digest,
    "content.classes": lambda v: isinstance(v, (list, tuple)) and len(v) == 2,
    "content.span": lambda v: isinstance(v, (list, tuple)) and len(v) == 2,
}


def _entry(seal: Mapping[str, Any], name: str) -> Any:
    found: Any = seal
    for part in name.split("."):
        found = found.get(part) if isinstance(found, Mapping) else None
    return found


def evidence_identity(seal: Mapping[str, Any]) -> dict[str, Any]:
    """The entries of a sound seal by dotted name; two runs on the same evidence agree in them."""
    found = {name: _entry(seal, name) for name in RULES}
    bad = [name for name, rule in RULES.items() if found[name] is None or not rule(found[name])]
    if bad:
        raise EvaluationTableError(f"seal entries missing or unusable: {bad}")
    return {n: list(v) if isinstance(v, tuple) else v for n, v in found.items()}


def measured_content(df: DataFrame, id_col: str, time_col: str, label_col: str) -> dict[str, Any]:
    """The ``content`` part of a seal; raises where the rows cannot serve as evidence."""
    absent = sorted({id_col, time_col, label_col} - set(df.columns))
    if absent:
        raise EvaluationTableError(f"no columns {absent} to seal by")
    seen = observed_identity(df, id_col, time_col, label_col).first()
    if seen.row_count == 0 or seen.repeated_ids:
        raise EvaluationTableError(f"{seen.row_count} rows, {seen.repeated_ids} repeated ids")
    if seen.label_0 + seen.label_1 < seen.row_count:
        raise EvaluationTableError(f"{label_col} holds more than 0 and 1")
    return {
        "digest_kind": ALGORITHM,
        "rows": seen.row_count,
        "classes": [seen.label_0, seen.label_1],
        "span": [str(seen.dt_min), str(seen.dt_max)],
        "ordered_digest": ordered_fingerprint(df, time_col, id_col).first().fingerprint,
        "id_digest": row_identity_fingerprint(df, time_col, id_col, id_col).first().fingerprint,
        "stored_digest": table_fingerprint(df).first().fingerprint,
    }


def write_evaluation(
    df: DataFrame,
    folder: str,
    id_col: str,
    time_col: str,
    label_col: str,
    data_source: str,
    split_strategy: str,
    source_fingerprint: Mapping[str, str],
    seed: int = 42,
) -> dict[str, Any]:
    """Write rows, measure what was written, write the seal."""
    spark, base = df.sparkSession, folder.rstrip("/")
    df.write.mode("errorifexists").parquet(f"{base}/rows")
    written = spark.read.parquet(f"{base}/rows")
    seal = {
        "about": {
            "layout": LAYOUT,
            "role": ROLE,
            "source": data_source,
            "source_digests": dict(source_fingerprint),
            "split": split_strategy,
            "seed": seed,
            "keys": [id_col, time_col, label_col],
        },
        "shape": [list(column) for column in written.dtypes],
        "content": measured_content(written, id_col, time_col, label_col),
    }
    evidence_identity(seal)
    write_json_document(spark, seal, f"{base}/seal")
    return seal


def load_evaluation(
    spark: SparkSession, folder: str, seal: Mapping[str, Any] | None = None
) -> DataFrame:
    """The rows, if they still measure what the seal says."""
    base = folder.rstrip("/")
    claimed = evidence_identity(read_json_document(spark, f"{base}/seal") if seal is None else seal)
    rows = spark.read.parquet(f"{base}/rows")
    found = {f"content.{k}": v for k, v in measured_content(rows, *claimed["about.keys"]).items()}
    found["shape"] = [list(column) for column in rows.dtypes]
    off = sorted(name for name, value in found.items() if claimed[name] != value)
    if off:
        raise EvaluationTableError(f"the rows do not match their seal in {off}")
    return rows


def require_same_sources(recorded: Mapping[str, str], observed: DataFrame) -> None:
    """Refuse where a source's digest changed or a source came or went.

    The comparison is a join in Spark; only the names that differ, ten at most, come back.
    """
    spark = observed.sparkSession
    then = spark.createDataFrame(list(recorded.items()), "file_name string, then string")
    differs = ~F.col("sha256").eqNullSafe(F.col("then"))
    off = observed.join(then, "file_name", "full").where(differs)
    names = [r[0] for r in off.select(quoted("file_name")).orderBy("file_name").limit(10).collect()]
    if names:
        raise EvaluationTableError(f"sources are not the recorded ones, first of all {names}")
