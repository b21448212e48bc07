"""Registered queries: name -> (callable(spark, folder), SQL for the same result or None)."""

from __future__ import annotations


def catalog() -> dict:
    from riskframe.queries import drift, features, identity, records, scores, tables

    merged: dict = {}
    for module in (tables, scores, features, drift, identity, records):
        repeated = set(merged) & set(module.QUERIES)
        if repeated:
            raise ValueError(f"queries registered twice: {sorted(repeated)}")
        merged.update(module.QUERIES)
    return merged
