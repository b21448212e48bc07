"""Dataset audit: four source tables, key coverage and the identity of every split."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.canonical import json_digest
from riskframe.operators.audit import (
    DataValidationError,
    missing_summary,
    null_profile,
    split_summary,
    time_overlaps,
    validate_transactions,
)
from riskframe.operators.fingerprint import ALGORITHM, ordered_fingerprint, table_fingerprint
from riskframe.operators.joins import attach_identity, key_coverage
from riskframe.operators.split import five_way_split


def audit_table(
    df: DataFrame, id_col: str, time_col: str | None = None, label_col: str | None = None
) -> dict[str, Any]:
    """Strict audit of one table: it raises on missing or repeated ids and invalid times."""
    if time_col is not None:
        validate_transactions(df, id_col, time_col, None, label_col, strict=True)
    else:
        found = df.agg(
            F.count("*").alias("n"),
            F.count_distinct(id_col).alias("ids"),
            F.count_if(F.col(id_col).isNull()).alias("missing"),
        ).first()
        if not found.n or found.missing or found.ids != found.n:
            raise DataValidationError(f"{id_col} is missing or repeated, or the table is empty")
    profile = null_profile(df)
    result: dict[str, Any] = {
        "columns": list(df.columns),
        "missing_counts": {r.column_name: r.missing_count for r in profile.collect()},
        **missing_summary(profile).first().asDict(),
    }
    bounds = [F.count("*").alias("rows")]
    if time_col is not None:
        bounds += [F.min(time_col).alias("low"), F.max(time_col).alias("high")]
    if label_col is not None:
        bounds += [F.count_if(F.col(label_col) == 1).alias("positive")]
    row = df.agg(*bounds).first()
    result["rows"] = row.rows
    if time_col is not None:
        result["time"] = {"min": str(row.low), "max": str(row.high)}
    if label_col is not None:
        result["target"] = {"positive": row.positive, "negative": row.rows - row.positive}
    return result


def split_identity(df: DataFrame, split: str, time_col: str, label_col: str) -> DataFrame:
    """Summary and order-free fingerprint of every split, all splits in one pass each."""
    summary = split_summary(df, split, time_col, label_col)
    prints = table_fingerprint(df, groups=[split]).select(split, "fingerprint")
    return summary.join(prints, split).withColumn("fingerprint_algorithm", F.lit(ALGORITHM))


Pair = tuple[DataFrame, DataFrame]


def audit_dataset(
    labelled: Pair,
    unlabelled: Pair,
    id_col: str,
    time_col: str,
    label_col: str,
    source_fingerprint: dict[str, str],
) -> dict[str, Any]:
    """Audit of both partitions - transactions and identity each - and of the five splits.

    Every split of the labelled partition gets two digests: one of its rows as a set and one of
    its rows in time order.
    """
    tables: dict[str, Any] = {}
    coverage: dict[str, Any] = {}
    for part, (transactions, identity), label in (
        ("labelled", labelled, label_col),
        ("unlabelled", unlabelled, None),
    ):
        found = key_coverage(transactions, identity, id_col).first()
        if found.orphan_keys:
            raise DataValidationError(f"{part}: {found.orphan_keys} identity keys have no transaction")
        coverage[part] = found.asDict()
        tables[f"{part} transactions"] = audit_table(transactions, id_col, time_col, label)
        tables[f"{part} identity"] = audit_table(identity, id_col)
    rows = five_way_split(attach_identity(*labelled, id_col), time_col, id_col)
    splits = split_identity(rows, "split", time_col, label_col)
    if not time_overlaps(splits, "split").filter("overlaps").isEmpty():
        raise DataValidationError("temporal splits overlap")
    collected = {}
    for row in splits.collect():
        entry = row.asDict()
        name = entry.pop("split")
        entry["dt_min"], entry["dt_max"] = str(row.dt_min), str(row.dt_max)
        own = rows.filter(F.col("split") == name).drop("split")
        entry["ordered_fingerprint"] = ordered_fingerprint(own, time_col, id_col).first().fingerprint
        collected[name] = entry
    return {
        "tables": tables,
        "coverage": coverage,
        "splits": collected,
        "source_fingerprint": json_digest(source_fingerprint),
        "splits_fingerprint": json_digest(collected),
    }
