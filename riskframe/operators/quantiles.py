"""Exact quantiles per group with linear interpolation, by shared histograms.

Wanted ranks are narrowed down pass by pass: every pass cuts the values around each rank into
bins, for all groups and ranks in one job, and keeps the bins that hold a rank. Nothing is
ordered but bins, so a group of any size costs the same number of scans, and a value shared by
most rows ends in a bin of its own. The plan is the same at every size.

Wide tables (``wide_quantiles``) are binned inside the row batch: a task reads all columns as arrays,
keeps the bins of every span, and sends each bin it has met once. No row is multiplied by the
number of columns, whatever their number.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.local import local_rows
from riskframe.functions.values import quoted

BINS = 4096
#: Columns per wide aggregate of counts and extremes.
CHUNK = 100

#: Rows with a value, lowest and highest value of a group.
Bounds = tuple[int, float, float]


@dataclass(frozen=True)
class _Span:
    """Values between two ends; ``start`` rows of the group lie below, ``ranks`` are inside."""

    group: int
    low: float
    high: float
    start: int
    rows: int
    ranks: tuple[int, ...]

    @property
    def by_value(self) -> bool:
        """As few rows, or as few doubles, as there are bins: each value is a bin."""
        if self.rows <= BINS:
            return True
        largest = max(abs(self.low), abs(self.high))
        return math.isfinite(largest) and self.high - self.low < 2 * BINS * math.ulp(largest)


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    bounds: Mapping[tuple, Bounds] | None = None,
) -> DataFrame:
    """One row per group: ``quantiles array<double>``, NULL where the group has no value.

    ``groups`` must name few groups (features, sides); rows per group are unbounded. ``bounds``
    are those of all groups where the caller knows them already. NaN counts as missing.
    """
    value_or_null = F.when(~F.isnan(F.col(value)), F.col(value)).cast("double")
    known = df.select(*groups, value_or_null.alias("v"))
    if bounds is None:
        seen = known.groupBy(*groups).agg(
            F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        bounds = {tuple(r[g] for g in groups): (r.n, r.low, r.high) for r in seen.collect()}
    keys = list(bounds)
    values = known.where("v IS NOT NULL")
    found = _values_at(
        [bounds[key] for key in keys],
        probabilities,
        lambda spans: _narrowed(_long_bins(values, groups, keys, spans), spans),
    )
    out = []
    for number, key in enumerate(keys):
        n = bounds[key][0]
        values = [_interpolate(found, number, n, p) for p in probabilities] if n else None
        out.append((*key, values))
    schema = T.StructType(
        [df.schema[g] for g in groups]
        + [T.StructField("quantiles", T.ArrayType(T.DoubleType()))]
    )
    return local_rows(df.sparkSession, out, schema)


def feature_quantiles(
    long_of: Callable[[Sequence[str]], DataFrame],
    features: Sequence[str],
    probabilities: Sequence[float],
    bounds: Mapping[str, Bounds] | None = None,
) -> dict[str, list[float] | None]:
    """Exact quantiles of many features; ``long_of`` gives ``feature, value`` rows of some."""
    if not features:
        return {}
    known = None if bounds is None else {(f,): bounds[f] for f in features}
    rows = exact_quantiles(long_of(features), ["feature"], "value", probabilities, known)
    return {r.feature: r.quantiles for r in rows.collect()}


def _wanted(n: int, probabilities: Sequence[float]) -> tuple[int, ...]:
    places = [(n - 1) * p for p in probabilities]
    return tuple(sorted({r for x in places for r in (math.floor(x), math.ceil(x))}))


def _interpolate(found: dict[tuple[int, int], float], group: int, n: int, p: float) -> float:
    position = (n - 1) * p
    low, high = math.floor(position), math.ceil(position)
    below, above = found[group, low], found[group, high]
    if below == above:
        return below
    return (high - position) * below + (position - low) * above


def wide_quantiles(
    df: DataFrame,
    features: Sequence[str],
    probabilities: Sequence[float],
    bounds: Mapping[str, Bounds] | None = None,
) -> dict[str, list[float] | None]:
    """Exact quantiles of double columns of a wide table; NULL and NaN count as missing."""
    if not features:
        return {}
    known = df.select(*[F.nanvl(quoted(f), F.lit(None)).alias(f"c{i}") for i, f in enumerate(features)])
    if bounds is None:
        bounds = {}
        for start in range(0, len(features), CHUNK):
            part = range(start, min(len(features), start + CHUNK))
            measures = [m(f"c{i}") for i in part for m in (F.count, F.min, F.max)]
            row = known.agg(*[m.alias(f"m{j}") for j, m in enumerate(measures)]).first()
            bounds.update({features[i]: tuple(row[3 * j : 3 * j + 3]) for j, i in enumerate(part)})
    sides = [bounds.get(f, (0, None, None)) for f in features]
    found = _values_at(sides, probabilities, lambda spans: _narrowed(_wide_bins(known, spans), spans))
    return {
        f: [_interpolate(found, i, sides[i][0], p) for p in probabilities] if sides[i][0] else None
        for i, f in enumerate(features)
    }


def _values_at(
    bounds: Sequence[Bounds],
    probabilities: Sequence[float],
    narrow: Callable[[list[_Span]], list[_Span]],
) -> dict[tuple[int, int], float]:
    """Value of every (group number, rank) that the probabilities fall on or between."""
    spans = []
    for number, (n, low, high) in enumerate(bounds):
        if n:
            spans.append(_Span(number, low, high, 0, n, _wanted(n, probabilities)))
    found: dict[tuple[int, int], float] = {}
    while spans:
        found.update({(s.group, r): s.low for s in spans if s.low == s.high for r in s.ranks})
        spans = [s for s in spans if s.low != s.high]
        if spans:
            spans = narrow(spans)
    return found


def _long_bins(
    known: DataFrame, groups: Sequence[str], keys: Sequence[tuple], spans: Sequence[_Span]
) -> DataFrame:
    """``span, least, most, n`` of every bin that holds rows, from one row per value."""
    rows = [(*keys[s.group], s.low, s.high, s.by_value, i) for i, s in enumerate(spans)]
    fields = [T.StructField(f"g{i}", known.schema[g].dataType) for i, g in enumerate(groups)]
    fields += T.StructType.fromDDL("low double, high double, by_value boolean, span int").fields
    # A few rows per group and probability, hence the broadcast.
    table = F.broadcast(local_rows(known.sparkSession, rows, T.StructType(fields)))
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    own = v.between(low, high)
    for i, group in enumerate(groups):
        own = own & F.col(group).eqNullSafe(F.col(f"g{i}"))
    endless = (low == -math.inf) | (high == math.inf)
    share = (v / 2 - low / 2) / (high / 2 - low / 2)
    place = (
        F.when(v == -math.inf, -1)
        .when(v == math.inf, BINS)
        .when(F.col("by_value") | endless, 0)
        .otherwise(F.least(F.floor(share * BINS), F.lit(BINS - 1)))
    )
    return (
        known.join(table, own)
        .select("span", "v", place.alias("place"), F.when(F.col("by_value"), v).alias("value"))
        .groupBy("span", "place", "value")
        .agg(F.min("v").alias("least"), F.max("v").alias("most"), F.count("*").alias("n"))
    )


class _Held:
    """Bins of one span in one task: their key (place or value), rows, least and most value."""

    def __init__(self, span: _Span):
        self.span = span
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        span = self.span
        v = values[(values >= span.low) & (values <= span.high)]
        if not len(v):
            return
        if span.by_value:
            key = v
        else:
            with np.errstate(invalid="ignore"):
                share = (v / 2 - span.low / 2) / (span.high / 2 - span.low / 2)
                key = np.minimum(np.floor(share * BINS), BINS - 1.0)
            if math.isinf(span.low) or math.isinf(span.high):
                key = np.where(v == -math.inf, -1.0, np.where(v == math.inf, float(BINS), 0.0))
        self.parts.append(self._merged(key, np.ones(len(v), np.int64), v, v))
        self.size += len(self.parts[-1][0])
        if self.size > 4 * BINS:
            self.close()

    @staticmethod
    def _merged(key, n, least, most) -> tuple[np.ndarray, ...]:
        order = np.argsort(key, kind="stable")
        key = key[order]
        runs = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return (
            key[runs], np.add.reduceat(n[order], runs),
            np.minimum.reduceat(least[order], runs), np.maximum.reduceat(most[order], runs),
        )

    def close(self) -> tuple[np.ndarray, ...] | None:
        if self.parts:
            self.parts = [self._merged(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.size = len(self.parts[0][0])
        return self.parts[0] if self.parts else None


WIDE_BINS = pa.schema(
    [("span", pa.int32()), ("key", pa.float64()), ("n", pa.int64()), ("least", pa.float64()),
     ("most", pa.float64())]
)


def _wide_bins(known: DataFrame, spans: Sequence[_Span]) -> DataFrame:
    """``span, least, most, n`` of every bin, from columns ``c<group>`` read as arrays."""
    columns = sorted({s.group for s in spans})

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_Held(s) for s in spans]
        for batch in stream:
            arrays = {
                c: batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
                for i, c in enumerate(columns)
            }
            for h in held:
                h.add(arrays[h.span.group])
        for i, h in enumerate(held):
            found = h.close()
            if found is not None:
                key, n, least, most = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), i, np.int32)), pa.array(key), pa.array(n),
                     pa.array(least), pa.array(most)],
                    schema=WIDE_BINS,
                )

    bins = known.select(*[F.col(f"c{c}").cast("double") for c in columns]).mapInArrow(
        count, "span int, key double, n bigint, least double, most double"
    )
    return bins.groupBy("span", "key").agg(
        F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n")
    )


def _narrowed(bins: DataFrame, spans: Sequence[_Span]) -> list[_Span]:
    """The bins that hold a wanted rank."""
    rows = [(s.start, list(s.ranks), i) for i, s in enumerate(spans)]
    wanted = local_rows(bins.sparkSession, rows, "start bigint, ranks array<bigint>, span int")
    # At most as many rows per span as there are bins.
    upto = Window.partitionBy("span").orderBy("least").rowsBetween(Window.unboundedPreceding, 0)
    ends = bins.withColumn("inner_end", F.sum("n").over(upto))
    end = F.col("start") + F.col("inner_end")
    holding = (
        ends.join(F.broadcast(wanted), "span")
        .withColumn("held", F.filter("ranks", lambda r: (r < end) & (r >= end - F.col("n"))))
        .where(F.size("held") > 0)
        .select("span", "least", "most", (end - F.col("n")).alias("start"), "n", "held")
    )
    return [
        _Span(spans[r.span].group, r.least, r.most, r.start, r.n, tuple(r.held))
        for r in holding.collect()
    ]
