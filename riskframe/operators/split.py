"""Leakage-safe partitions as one ``split`` column.

Temporal splits compare each row with literal cut keys, so no row moves. Stratified random
splits do the same per class on a seeded hash of the id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalars import round_half_even
from riskframe.functions.values import quoted
from riskframe.operators.order import (
    CutKey,
    before,
    cut_keys,
    group_cut_keys,
    order_bounds,
)

TEMPORAL, RANDOM = "temporal", "random"
#: A documented limit, refused beyond and never cut: classes of a stratified split.
MOST_CLASSES = 1000
FIVE_WAY = (
    "train",
    "calibration_fit",
    "selection_validation",
    "promotion_evaluation",
    "final_test",
)


def seeded_order(id_col: str, seed: int) -> Column:
    """A 60-bit position drawn from the id and seed, independent of layout."""
    text = F.concat(F.lit(f"{seed}:"), quoted(id_col).cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def cut_sizes(n: int, ratios: Sequence[float]) -> list[int]:
    """Row counts per part: every part but the last rounds half to even, the last takes the rest."""
    sizes = [round_half_even(n * r) for r in ratios[:-1]]
    return [*sizes, max(0, n - sum(sizes))]


def halves(n: int, first_share: float) -> int:
    """Rows in the earlier of two parts, at least one row on each side."""
    if not 0.0 < first_share < 1.0:
        raise ValueError("share must be strictly between 0 and 1")
    if n < 2:
        raise ValueError("a pool of fewer than two rows cannot be split")
    return max(1, min(n - 1, round_half_even(n * first_share)))


def part_ends(parts: Sequence[tuple[str, int]]) -> list[tuple[str, int]]:
    """Each part but the last with the rank at which the next one starts."""
    ends, position = [], 0
    for name, size in parts[:-1]:
        position += size
        ends.append((name, position))
    return ends


def inner_ranks(parts: Sequence[tuple[str, int]]) -> list[int]:
    total = sum(size for _, size in parts)
    return sorted({end for _, end in part_ends(parts) if 0 < end < total})


def part_label(
    df: DataFrame, order: str, tie: str, parts: Sequence[tuple[str, int]], cuts: dict[int, CutKey]
) -> Column:
    """Name of the part a row falls in, by comparison with the literal cut keys."""
    total = sum(size for _, size in parts)
    label = F.lit(parts[-1][0])
    for name, end in reversed(part_ends(parts)):
        if end >= total:
            label = F.lit(name)
        elif end > 0:
            label = F.when(before(df, order, tie, cuts[end]), F.lit(name)).otherwise(label)
    return label


def split_by_sizes(
    df: DataFrame,
    order: str,
    tie: str,
    parts_of: Callable[[int], Sequence[tuple[str, int]]],
    split: str = "split",
) -> DataFrame:
    """Label rows in ``(order, tie)`` order; ``parts_of`` turns the row count into sized parts."""
    bounds = order_bounds(df, order)[None]
    parts = parts_of(bounds.rows)
    cuts = cut_keys(df, order, tie, inner_ranks(parts), bounds)
    return df.withColumn(split, part_label(df, order, tie, parts, cuts))


def temporal_split(
    df: DataFrame,
    time_col: str,
    id_col: str,
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    names: Sequence[str] = ("train", "validation", "test"),
    split: str = "split",
) -> DataFrame:
    return split_by_sizes(
        df, time_col, id_col, lambda n: list(zip(names, cut_sizes(n, ratios))), split
    )


def five_way_sizes(
    n: int,
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    promotion_share: float = 0.5,
    calibration_share: float = 0.5,
) -> list[tuple[str, int]]:
    train, pool, final = cut_sizes(n, ratios)
    development = halves(pool, 1.0 - promotion_share)
    calibration = halves(development, calibration_share)
    sizes = (train, calibration, development - calibration, pool - development, final)
    return list(zip(FIVE_WAY, sizes))


def five_way_split(
    df: DataFrame,
    time_col: str,
    id_col: str,
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    promotion_share: float = 0.5,
    calibration_share: float = 0.5,
    split: str = "split",
) -> DataFrame:
    """All five partitions from one set of cut keys instead of three nested sorts."""
    return split_by_sizes(
        df,
        time_col,
        id_col,
        lambda n: five_way_sizes(n, ratios, promotion_share, calibration_share),
        split,
    )


def two_way_split(
    df: DataFrame,
    time_col: str,
    id_col: str,
    first_share: float = 0.5,
    names: Sequence[str] = ("earlier", "later"),
    split: str = "split",
) -> DataFrame:

    def parts(n: int) -> list[tuple[str, int]]:
        first = halves(n, first_share)
        return list(zip(names, (first, n - first)))

    return split_by_sizes(df, time_col, id_col, parts, split)


def require_few_classes(df: DataFrame, label_col: str) -> None:
    """The driver keeps one entry per class, so many classes are refused before they get there."""
    found = df.agg(F.approx_count_distinct(quoted(label_col))).first()[0]
    if found > 2 * MOST_CLASSES:
        raise ValueError(f"{label_col} has about {found} classes; stratify by at most {MOST_CLASSES}")


def stratified_by_sizes(
    df: DataFrame,
    id_col: str,
    label_col: str,
    parts_of: Callable[[int], Sequence[tuple[str, int]]],
    seed: int = 42,
    split: str = "split",
) -> DataFrame:
    """Seeded random parts, sized class by class so that every part keeps the class shares.

    Unstratified when there is one class only, or a class too small to be cut by ``parts_of``.
    """
    hashed = df.withColumn("_order", seeded_order(id_col, seed))
    require_few_classes(df, label_col)
    bounds = order_bounds(hashed, "_order", label_col)
    try:
        parts = {c: parts_of(b.rows) for c, b in bounds.items()}
    except ValueError:
        parts = {}
    if len(parts) < 2 or min(b.rows for b in bounds.values()) < 2:
        return split_by_sizes(hashed, "_order", id_col, parts_of, split).drop("_order")
    ranks = {c: inner_ranks(p) for c, p in parts.items()}
    cuts = group_cut_keys(hashed, "_order", id_col, ranks, bounds, label_col)
    label = F.lit(None).cast("string")
    for value, sized in parts.items():
        own = part_label(hashed, "_order", id_col, sized, cuts[value])
        label = F.when(quoted(label_col).eqNullSafe(F.lit(value)), own).otherwise(label)
    return hashed.withColumn(split, label).drop("_order")


def stratified_split(
    df: DataFrame,
    id_col: str,
    label_col: str,
    ratios: Sequence[float],
    names: Sequence[str],
    seed: int = 42,
    split: str = "split",
) -> DataFrame:
    """Parts by ratio, see :func:`stratified_by_sizes`."""

    def parts(n: int) -> list[tuple[str, int]]:
        return list(zip(names, cut_sizes(n, ratios)))

    return stratified_by_sizes(df, id_col, label_col, parts, seed, split)


def five_way_random(
    df: DataFrame,
    id_col: str,
    label_col: str,
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    promotion_share: float = 0.5,
    calibration_share: float = 0.5,
    seed: int = 42,
    split: str = "split",
) -> DataFrame:
    """The five parts of a random partition: the pool's two cuts are stratified as well."""

    def parts(n: int) -> list[tuple[str, int]]:
        return five_way_sizes(n, ratios, promotion_share, calibration_share)

    return stratified_by_sizes(df, id_col, label_col, parts, seed, split)


def stratified_halves(
    df: DataFrame,
    id_col: str,
    label_col: str,
    first_share: float = 0.5,
    names: Sequence[str] = ("first", "second"),
    seed: int = 42,
    split: str = "split",
) -> DataFrame:
    """A random two-way cut of a pool, at least one row of every class on each side."""

    def parts(n: int) -> list[tuple[str, int]]:
        first = halves(n, first_share)
        return list(zip(names, (first, n - first)))

    return stratified_by_sizes(df, id_col, label_col, parts, seed, split)


def split_table(
    df: DataFrame,
    strategy: str,
    time_col: str,
    id_col: str,
    label_col: str,
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    names: Sequence[str] = ("train", "validation", "test"),
    seed: int = 42,
) -> DataFrame:
    if strategy == "temporal":
        return temporal_split(df, time_col, id_col, ratios, names)
    if strategy == "random":
        return stratified_split(df, id_col, label_col, ratios, names, seed)
    raise ValueError(f"unknown split strategy {strategy!r}; use 'temporal' or 'random'")

