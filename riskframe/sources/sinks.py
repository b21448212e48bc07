"""Report and table sinks with strict JSON."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from riskframe.functions.canonical import canonical_json
from riskframe.functions.local import local_rows
from riskframe.operators.predict import finite_output


def write_json_rows(df: DataFrame, path: str) -> None:
    """Check or bucket tables as JSON lines; non-finite numbers become null, nulls stay visible."""
    finite_output(df).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_json_document(spark: SparkSession, document: dict[str, Any], path: str) -> None:
    """One nested report or manifest with sorted keys; NaN and Infinity are refused."""
    text = canonical_json(document)
    local_rows(spark, [(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def read_json_document(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first().value)
