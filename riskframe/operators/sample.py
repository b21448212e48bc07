"""Exact-size deterministic samples that do not depend on the table's layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.values import quoted
from riskframe.operators.order import before, cut_keys, order_bounds, rank_rows
from riskframe.operators.split import seeded_order


def on_grid(rank: Column, total: int, size: int) -> Column:
    """True for ranks floor(i * (total-1) / (size-1)), i = 0..size-1, the last being total-1.

    Closed form: only the few grid indexes that can land on the rank are tried.
    """
    if size == 1:
        return rank == 0
    step = (total - 1) / (size - 1)
    guess = F.floor(rank / F.lit(step))
    hit = rank == total - 1
    for shift in (-1, 0, 1, 2):
        index = guess + shift
        inside = (index >= 0) & (index < size - 1)
        hit = hit | (inside & (F.floor(index.cast("double") * F.lit(step)) == rank))
    return hit


def systematic_sample(df: DataFrame, time_col: str, id_col: str, size: int | None) -> DataFrame:
    """Rows evenly spaced over the time order; ``None`` or a large size keeps every row.

    Ids are unique, which validation checks.
    """
    if size is None:
        return df
    if size <= 0:
        raise ValueError(f"sample size must be positive, got {size}")
    total = df.count()
    if size >= total:
        return df
    ranked = rank_rows(df.select(quoted(time_col), quoted(id_col)), time_col, id_col, "_rank")
    kept = ranked.filter(on_grid(F.col("_rank"), total, size)).select(quoted(id_col))
    # Only the key columns are shuffled for ranking. The join side is left to AQE.
    return df.join(kept, id_col, "left_semi")


def random_sample(df: DataFrame, id_col: str, size: int | None, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows, uniform over ids: those below one cut of the seeded order."""
    if size is None:
        return df
    hashed = df.withColumn("_order", seeded_order(id_col, seed))
    bounds = order_bounds(hashed, "_order")[None]
    if size >= bounds.rows:
        return df
    if size <= 0:
        raise ValueError(f"sample size must be positive, got {size}")
    cut = cut_keys(hashed, "_order", id_col, [size], bounds)[size]
    return hashed.filter(before(hashed, "_order", id_col, cut)).drop("_order")


def sample_table(
    df: DataFrame,
    strategy: str,
    time_col: str,
    id_col: str,
    size: int | None,
    seed: int = 42,
) -> DataFrame:
    if strategy == "time_ordered":
        return systematic_sample(df, time_col, id_col, size)
    if strategy == "random":
        return random_sample(df, id_col, size, seed)
    raise ValueError(f"unknown sampling strategy {strategy!r}; use 'time_ordered' or 'random'")


def left_out(df: DataFrame, sampled: DataFrame, id_col: str) -> DataFrame:
    """The rows a sample did not take."""
    return df.join(sampled.select(quoted(id_col)), id_col, "left_anti")
