"""Key joins between a transaction table and its optional identity side, and set checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.canonical import digest, row_text
from riskframe.functions.local import local_rows
from riskframe.functions.values import quoted


def attach_identity(transactions: DataFrame, identity: DataFrame, key: str) -> DataFrame:
    """Left equi join; every transaction stays, AQE picks the join and splits skewed keys."""
    return transactions.join(identity, key, "left")


def orphan_keys(identity: DataFrame, transactions: DataFrame, key: str) -> DataFrame:
    """Distinct identity keys without a transaction."""
    # Repeated keys collapse before the shuffle, so a hot key is one row of the join.
    wanted = identity.select(quoted(key)).distinct()
    return wanted.join(transactions.select(quoted(key)).distinct(), key, "left_anti")


def key_coverage(transactions: DataFrame, identity: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys per side, matched, orphaned, and identity keys per transaction key."""
    sides = (
        transactions.select(quoted(key), F.lit(1).alias("t"), F.lit(0).alias("i"))
        .unionByName(identity.select(quoted(key), F.lit(0).alias("t"), F.lit(1).alias("i")))
        .filter(quoted(key).isNotNull())
        .groupBy(key)
        .agg(F.max("t").alias("t"), F.max("i").alias("i"))
    )
    identity_keys, transaction_keys = F.sum("i"), F.sum("t")
    return sides.agg(
        F.coalesce(transaction_keys, F.lit(0)).alias("transaction_keys"),
        F.coalesce(identity_keys, F.lit(0)).alias("identity_keys"),
        F.coalesce(F.sum(F.col("i") * F.col("t")), F.lit(0)).alias("matched_keys"),
        F.coalesce(F.sum(F.col("i") * (1 - F.col("t"))), F.lit(0)).alias("orphan_keys"),
        F.try_divide(identity_keys, transaction_keys).cast("double").alias("coverage"),
    )


def _row_digests(df: DataFrame, columns: list[str], sign: int) -> DataFrame:
    text: Column = digest(row_text(df.schema, columns))
    return df.select(text.alias("row_digest"), F.lit(sign).alias("sign"))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows held more often by one side: ``row_digest, surplus`` (positive: left has more).

    Both sides meet in one pre-aggregated shuffle of digests rather than of whole rows.
    """
    columns = left.columns
    return (
        _row_digests(left, columns, 1)
        .unionByName(_row_digests(right, columns, -1))
        .groupBy("row_digest")
        .agg(F.sum("sign").alias("surplus"))
        .filter(F.col("surplus") != 0)
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Same columns, types and multiset of rows; row order is not part of a DataFrame."""
    shape = [(f.name, f.dataType) for f in left.schema.fields]
    if shape != [(f.name, f.dataType) for f in right.schema.fields]:
        return False
    return row_differences(left, right).isEmpty()


def overlapping_keys(df: DataFrame, key: str, split: str) -> DataFrame:
    """Keys that occur in more than one split; empty when the partitions are disjoint."""
    return (
        df.groupBy(key)
        .agg(F.min(split).alias("first_split"), F.max(split).alias("last_split"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def column_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns found on one side only: ``column_name, only_in``."""
    rows = [(c, "left") for c in left.columns if c not in set(right.columns)]
    rows += [(c, "right") for c in right.columns if c not in set(left.columns)]
    return local_rows(
        left.sparkSession, sorted(rows), "column_name string, only_in string"
    )
