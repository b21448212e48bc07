"""Exact ranks, cut keys and running totals without a single-partition window.

Three tools, all exact and all recomputable after a lost executor because every bucket
is a function of the row's own values, never of where the row happens to sit:

* :func:`cut_keys` finds the key at given ranks by repeated histograms. Nothing is
  shuffled but the histograms, so splitting a table is one narrow scan per pass.
* :func:`rank_rows` gives every row its rank: value buckets, bucket offsets, and
  ``row_number`` inside each bucket.
* :func:`running_totals` cumulates counts per distinct value the same way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.local import local_rows
from riskframe.functions.values import nan_to_null, quoted
from riskframe.session import parallelism

HISTOGRAM_BINS = 4096
# A span of so few rows is counted value by value: as many lines as a histogram has bins.
DIRECT_ROWS = HISTOGRAM_BINS
EXACT_IN_DOUBLE = 2**53
EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class OrderKey:
    """A sortable column: ``raw`` for comparisons Spark can push down, ``number`` for bins."""

    raw: Column
    number: Column
    is_double: bool
    data_type: T.DataType

    def literal(self, value: Any) -> Column:
        if isinstance(self.data_type, T.TimestampType):
            return F.timestamp_micros(F.lit(int(value)))
        if isinstance(self.data_type, T.TimestampNTZType):
            moment = EPOCH + timedelta(microseconds=int(value))
            return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")
        if isinstance(self.data_type, T.DateType):
            return F.date_from_unix_date(F.lit(int(value)))
        return F.lit(value)


def order_key(df: DataFrame, name: str) -> OrderKey:
    data_type = df.schema[name].dataType
    column = quoted(name)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        clean = nan_to_null(column, data_type).cast("double")
        return OrderKey(clean, clean, True, T.DoubleType())
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return OrderKey(column, column.cast("long"), False, data_type)
    if isinstance(data_type, T.TimestampType):
        return OrderKey(column, F.unix_micros(column), False, data_type)
    if isinstance(data_type, T.TimestampNTZType):
        return OrderKey(column, _zoneless_micros(column), False, data_type)
    if isinstance(data_type, T.DateType):
        return OrderKey(column, F.unix_date(column).cast("long"), False, data_type)
    raise TypeError(f"cannot order rows by a column of type {data_type.simpleString()}")


def _zoneless_micros(column: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    days = F.unix_date(column.cast("date")).cast("long")
    minutes = (days * 24 + F.hour(column)) * 60 + F.minute(column)
    seconds = F.extract(F.lit("SECOND"), column) * F.lit(1_000_000)
    return minutes * F.lit(60_000_000) + seconds.cast("long")


@dataclass
class _Span:
    group: Any
    low: Any
    high: Any
    start: int
    rows: int
    ranks: list[int]


@dataclass(frozen=True)
class _Found:
    value: Any
    start: int
    rows: int


def _bin_of(key: OrderKey, span: _Span) -> Column:
    if key.is_double and not (math.isfinite(span.low) and math.isfinite(span.high)):
        # Infinities first get bins of their own; what is between is cut from the next pass on.
        return F.when(key.number == -math.inf, -1).when(key.number == math.inf, 1).otherwise(0)
    if key.is_double:
        width = span.high / 2 - span.low / 2
        share = (key.number / 2 - F.lit(span.low / 2)) / F.lit(width)
        return F.least(F.floor(share * HISTOGRAM_BINS), F.lit(HISTOGRAM_BINS - 1)).cast("long")
    shift = 0
    while (span.high >> shift) - (span.low >> shift) >= HISTOGRAM_BINS:
        shift += 1
    return F.shiftright(key.number, shift)


def _too_narrow(key: OrderKey, span: _Span) -> bool:
    """Too few doubles between the ends to cut into bins: each is counted by itself."""
    return key.is_double and span.high - span.low < 2 * HISTOGRAM_BINS * math.ulp(
        max(abs(span.low), abs(span.high))
    )


def _select(
    df: DataFrame, key: OrderKey, spans: list[_Span], members: dict[Any, Column]
) -> dict[tuple, _Found]:
    """Value, first rank and count of the value group at each (group, 0-based rank).

    Every pass serves all groups and ranks at once.
    """
    found: dict[tuple, _Found] = {}
    while spans:
        open_spans = []
        for span in spans:
            if span.low == span.high:
                for rank in span.ranks:
                    found[span.group, rank] = _Found(span.low, span.start, span.rows)
            else:
                open_spans.append(span)
        if not open_spans:
            break
        which = F.lit(None).cast("int")
        slot = F.lit(None).cast("long")
        exact = F.lit(None).cast("double" if key.is_double else "long")
        any_span = F.lit(False)
        for number, span in enumerate(open_spans):
            inside = members[span.group] & key.raw.between(
                key.literal(span.low), key.literal(span.high)
            )
            any_span = any_span | inside
            which = F.when(inside, F.lit(number)).otherwise(which)
            if span.rows <= DIRECT_ROWS or _too_narrow(key, span):
                exact = F.when(inside, key.number).otherwise(exact)
            else:
                slot = F.when(inside, _bin_of(key, span)).otherwise(slot)
        bins = (
            df.filter(any_span)
            .select(
                which.alias("span"), slot.alias("slot"), exact.alias("exact"), key.number.alias("k")
            )
            .groupBy("span", "slot", "exact")
            .agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("rows"))
            .collect()
        )
        spans = []
        for number, span in enumerate(open_spans):
            start = span.start
            waiting = list(span.ranks)
            for row in sorted((b for b in bins if b.span == number), key=lambda b: b.low):
                held = [r for r in waiting if start <= r < start + row.rows]
                if held:
                    asked = open_spans[number]
                    if (row.low, row.high) == (asked.low, asked.high) != (row.low, row.low):
                        raise RuntimeError(f"a pass over {asked} told nothing apart")
                    spans.append(_Span(span.group, row.low, row.high, start, row.rows, held))
                    waiting = [r for r in waiting if r not in held]
                start += row.rows
            if waiting:
                raise ValueError(f"no row at ranks {waiting}: ordering column holds NULL ties")
    return found


@dataclass(frozen=True)
class CutKey:
    """The (order, tie) key of one row; ``value`` None means the row has no order value."""

    value: Any
    tie: Any


@dataclass(frozen=True)
class OrderBounds:
    """Rows of a group, rows with an order value, and the lowest and highest value."""

    rows: int
    known: int
    low: Any
    high: Any


def order_bounds(df: DataFrame, order: str, group: str | None = None) -> dict[Any, OrderBounds]:
    """Bounds per value of ``group`` (a column with few values), or of the whole table as None."""
    key = order_key(df, order)
    found = df.groupBy(*([quoted(group).alias("g")] if group else [])).agg(
        F.count("*").alias("rows"),
        F.count(key.number).alias("known"),
        F.min(key.number).alias("low"),
        F.max(key.number).alias("high"),
    )
    return {
        (r.g if group else None): OrderBounds(r.rows, r.known, r.low, r.high)
        for r in found.collect()
    }


def cut_keys(
    df: DataFrame,
    order: str,
    tie: str,
    ranks: Sequence[int],
    bounds: OrderBounds | None = None,
) -> dict[int, CutKey]:
    """Key of the row at each 0-based rank when sorted by ``(order, tie)``, NULL order last."""
    if not ranks:
        return {}
    limits = {None: bounds or order_bounds(df, order)[None]}
    return group_cut_keys(df, order, tie, {None: list(ranks)}, limits, None)[None]


def group_cut_keys(
    df: DataFrame,
    order: str,
    tie: str,
    ranks: dict[Any, list[int]],
    bounds: dict[Any, OrderBounds],
    group: str | None,
) -> dict[Any, dict[int, CutKey]]:
    """:func:`cut_keys` inside every group, with shared passes.

    A pass collects at most ``HISTOGRAM_BINS`` bins per distinct target. A tie group is
    opened, by histograms over ``tie``, only where a rank falls inside it.
    """
    key, tie_key = order_key(df, order), order_key(df, tie)
    members = {
        g: F.lit(True) if group is None else quoted(group).eqNullSafe(F.lit(g)) for g in ranks
    }
    spans, groups = [], {}
    for g, wanted in ranks.items():
        limit = bounds[g]
        if wanted and (min(wanted) < 0 or max(wanted) >= limit.rows):
            raise ValueError(f"ranks {wanted} outside 0..{limit.rows - 1}")
        known = sorted({r for r in wanted if r < limit.known})
        if known:
            spans.append(_Span(g, limit.low, limit.high, 0, limit.known, known))
        for rank in wanted:
            if rank >= limit.known:
                groups[g, rank] = _Found(None, limit.known, limit.rows - limit.known)
    groups.update(_select(df, key, spans, members))
    out: dict[Any, dict[int, CutKey]] = {g: {} for g in ranks}
    inside: dict[tuple, list[int]] = {}
    for (g, rank), found in groups.items():
        if rank == found.start:
            out[g][rank] = CutKey(found.value, None)
        else:
            inside.setdefault((g, found.value), []).append(rank)
    # Every tie group is a group of its own here, so all of them are opened by the same passes.
    owners = {
        (g, value): members[g]
        & (key.raw.isNull() if value is None else key.raw == key.literal(value))
        for g, value in inside
    }
    for (g, value), rank, found in _tie_keys(df, tie, tie_key, owners, inside, groups):
        out[g][rank] = CutKey(value, found)
    return out


def _tie_keys(
    df: DataFrame,
    tie: str,
    tie_key: OrderKey,
    owners: dict[tuple, Column],
    inside: dict[tuple, list[int]],
    groups: dict[tuple, _Found],
) -> list[tuple[tuple, int, Any]]:
    """Tie-breaker at the waiting ranks of every tie group: one bounds job, then shared passes."""
    if not owners:
        return []
    slots = list(owners)
    which = F.lit(None).cast("int")
    for number, owner in enumerate(slots):
        which = F.when(owners[owner], F.lit(number)).otherwise(which)
    found = {
        r.slot: r
        for r in df.select(which.alias("slot"), tie_key.number.alias("k"))
        .where("slot IS NOT NULL")
        .groupBy("slot")
        .agg(
            F.count("*").alias("rows"),
            F.count("k").alias("known"),
            F.min("k").alias("low"),
            F.max("k").alias("high"),
        )
        .collect()
    }
    spans = []
    for number, owner in enumerate(slots):
        seen = found.get(number)
        if seen is None or seen.known < seen.rows:
            raise ValueError(f"tie-breaking column {tie!r} is NULL in a tie group")
        start = groups[owner[0], inside[owner][0]].start
        local = [rank - start for rank in inside[owner]]
        spans.append(_Span(owner, seen.low, seen.high, 0, seen.rows, local))
    placed = _select(df, tie_key, spans, owners)
    return [
        (owner, rank, placed[owner, rank - groups[owner[0], rank].start].value)
        for owner in slots
        for rank in inside[owner]
    ]


def before(df: DataFrame, order: str, tie: str, cut: CutKey) -> Column:
    """True for rows sorted strictly before ``cut``; never NULL."""
    key, tie_key = order_key(df, order), order_key(df, tie)
    if cut.value is None:
        condition = key.raw.isNotNull()
        if cut.tie is not None:
            condition = condition | (tie_key.raw < tie_key.literal(cut.tie))
    else:
        value = key.literal(cut.value)
        condition = key.raw < value
        if cut.tie is not None:
            condition = condition | (
                (key.raw == value) & (tie_key.raw < tie_key.literal(cut.tie))
            )
    return F.coalesce(condition, F.lit(False))


def bucket_count(df: DataFrame) -> int:
    return max(16, 4 * parallelism(df.sparkSession))


def bucketise(
    df: DataFrame, number: str, splits: Sequence[float], name: str, keep_missing: bool = False
) -> DataFrame:
    """Add the bucket of a double column as an int; buckets rise with the value.

    With ``keep_missing`` a missing value gets one more bucket, after all others.
    """
    bounds = [-math.inf, *splits, math.inf]
    if len(bounds) < 3:
        bounds = [-math.inf, 0.0, math.inf]
    placed = Bucketizer(
        splits=bounds,
        inputCol=number,
        outputCol=name,
        handleInvalid="keep" if keep_missing else "error",
    ).transform(df)
    return placed.withColumn(
        name, F.coalesce(F.col(name).cast("int"), F.lit(len(bounds) - 1))
    )


def quantile_splits(
    df: DataFrame, number: Column, buckets: int, *extra: Column
) -> tuple[list[float], dict[float, int], Row]:
    """Distinct approximate quantiles, how often each came up, and the ``extra`` aggregates.

    Only balance depends on the approximation; results built on the buckets are exact.
    """
    probabilities = [i / buckets for i in range(1, buckets)]
    sketch = F.percentile_approx(number, F.lit(probabilities), F.lit(10 * buckets))
    row = df.agg(sketch.alias("q"), *extra).first()
    repeats: dict[float, int] = {}
    for value in row.q or []:
        if math.isfinite(value):
            repeats[value] = repeats.get(value, 0) + 1
    return sorted(repeats), repeats, row


def rank_rows(
    df: DataFrame,
    order: str,
    tie: str,
    name: str = "rank",
    buckets: int | None = None,
    last: str | None = None,
) -> DataFrame:
    """Add the 0-based rank by ``(order, tie)``, NULL order last.

    ``last`` names a column that orders rows which agree in both.

    An order value heavy enough to fill several buckets gets a bucket of its own, split
    further by ``tie``, so one hot value is not one task.
    """
    count = buckets or bucket_count(df)
    key, tie_key = order_key(df, order), order_key(df, tie)
    keyed = df.select(
        "*",
        key.number.cast("double").alias("_key"),
        tie_key.number.cast("double").alias("_tie"),
    )
    splits, repeats, _ = quantile_splits(keyed, F.col("_key"), count)
    alone = {v for v, times in repeats.items() if times > 1 and abs(v) < EXACT_IN_DOUBLE}
    bounds = sorted(set(splits) | {math.nextafter(v, math.inf) for v in alone})
    placed = bucketise(keyed, "_key", bounds, "_bucket", keep_missing=True)
    counts = _bucket_sizes(placed, "_bucket").collect()
    sizes = {r._bucket: r.n for r in counts}
    total = sum(sizes.values())
    # Bucket i + 1 starts at bounds[i]; the extra last bucket holds missing order values.
    missing_bucket = len(bounds) + 1 if bounds else 2
    splittable = {bounds.index(v) + 1 for v in alone} | {missing_bucket}
    shares = {
        b: math.ceil(n * count / total)
        for b, n in sizes.items()
        if b in splittable and n * count > 2 * total
    }
    if shares:
        placed = _split_ties(placed, shares)
        found = [(r._bucket, r._part, r.n) for r in _bucket_sizes(placed, "_bucket", "_part").collect()]
    else:
        placed = placed.withColumn("_part", F.lit(0))
        found = [(r._bucket, 0, r.n) for r in counts]
    offsets, running = [], 0
    for bucket, part, rows in sorted(found):
        offsets.append((bucket, part, running))
        running += rows
    offset_rows = local_rows(
        df.sparkSession, offsets, "_bucket int, _part int, _offset bigint"
    )
    inside = Window.partitionBy("_bucket", "_part").orderBy(
        key.raw.asc_nulls_last(), tie_key.raw.asc(), *([quoted(last)] if last else [])
    )
    # At most a few thousand offsets by construction, hence the broadcast.
    return (
        placed.join(F.broadcast(offset_rows), ["_bucket", "_part"])
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - F.lit(1))
        .select(*[quoted(c) for c in df.columns], F.col(name).cast("long").alias(name))
    )


def _bucket_sizes(placed: DataFrame, *by: str) -> DataFrame:
    return placed.groupBy(*by).agg(F.count("*").alias("n"))


def _split_ties(placed: DataFrame, shares: dict[int, int]) -> DataFrame:
    """Split heavy buckets by quantiles of the tie-breaker found inside each."""
    most = max(shares.values())
    probabilities = [i / most for i in range(1, most)]
    rows = (
        placed.filter(F.col("_bucket").isin(list(shares)))
        .groupBy("_bucket")
        .agg(F.percentile_approx("_tie", F.lit(probabilities), F.lit(10 * most)).alias("q"))
        .collect()
    )
    parts = []
    for row in rows:
        step = max(1, len(row.q) // shares[row._bucket])
        parts.append((row._bucket, sorted(set(row.q[::step]))))
    bounds = local_rows(placed.sparkSession, parts, "_bucket int, _bounds array<double>")
    part = F.size(F.filter("_bounds", lambda bound: bound <= F.col("_tie")))
    return (
        placed.join(F.broadcast(bounds), "_bucket", "left")
        .withColumn("_part", F.when(F.col("_bounds").isNotNull(), part).otherwise(0))
        .drop("_bounds")
    )


def running_totals(
    counts: DataFrame,
    number: str,
    measures: Sequence[str],
    groups: Sequence[str],
    splits: Sequence[float],
) -> DataFrame:
    """Add ``<measure>_above``: the total over strictly greater ``number`` in the group.

    ``counts`` holds one row per (group, value). Values are cut into buckets, bucket totals
    are cumulated (a bounded number of rows per group) and a window runs inside a bucket.
    """
    placed = bucketise(counts, number, splits, "_bucket")
    totals = placed.groupBy(*groups, "_bucket").agg(
        *[F.sum(m).alias(f"_{m}") for m in measures]
    )
    higher = (
        Window.partitionBy(*groups)
        .orderBy(F.col("_bucket").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *[quoted(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_bucket").alias("_at"),
        *[
            F.coalesce(F.sum(f"_{m}").over(higher), F.lit(0)).alias(f"_{m}_offset")
            for m in measures
        ],
    )
    within = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy(F.col(number).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = F.col("_bucket") == F.col("_at")
    for i, group in enumerate(groups):
        same = same & quoted(group).eqNullSafe(F.col(f"_g{i}"))
    # One row per group and bucket; groups can be many, so the join side is left to AQE.
    return placed.join(offsets, same).select(
        *[quoted(c) for c in counts.columns],
        *[
            (F.col(f"_{m}_offset") + F.sum(m).over(within) - F.col(m)).alias(f"{m}_above")
            for m in measures
        ],
    )
