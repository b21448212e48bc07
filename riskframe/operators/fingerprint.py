"""Dataset identity by digests that add up.

Each row is hashed to 256 bits; the hash is cut into limbs that are summed as exact
decimals, so partial aggregation, partitioning and row order cannot change the result
while a changed, added or repeated row does.

Where order counts, rows are the coefficients of polynomials over a prime field. A run of rows is
digested from left to right, and two neighbouring runs join by ``left * base^rows + right``: an
associative operation that does not commute. Ranges of the order are thus digested in parallel
and joined in turn, without a rank for any row.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.canonical import category_key, category_token, digest, row_text
from riskframe.functions.values import quoted
from riskframe.operators.audit import duplicate_count

ALGORITHM = "sha256-limb-sum-polynomial-v2"
LIMBS = ((1, 15), (16, 15), (31, 15), (46, 15), (61, 4))
#: Ordered digests: four polynomials modulo a Mersenne prime, over 60 bits of the row hash each.
PRIME = (1 << 61) - 1
LANES = LIMBS[:4]
BASES = tuple(
    int(hashlib.sha256(f"ordered base {i}".encode()).hexdigest()[:15], 16)
    for i in range(len(LANES))
)


def _combine(hashed: DataFrame, header: str, groups: Sequence[str] = ()) -> DataFrame:
    """Sum the limbs exactly, then hash the sums together with header and row count.

    Each limb is summed as two halves of at most 30 bits in long arithmetic, apart for groups
    of input partitions, which holds for 8e9 rows per group whatever rows repeat; decimals add
    the groups. How rows are spread over partitions cannot show in the total.
    """
    half = F.lit((1 << 30) - 1)
    limbs = [
        F.conv(F.substring("row_hash", start, length), 16, 10).cast("long")
        for start, length in LIMBS
    ]
    spread = hashed.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(4096)))
    by_part = spread.groupBy(*groups, "_part").agg(
        F.count("*").alias("n"),
        *[F.sum(F.shiftright(limb, 30)).alias(f"high{i}") for i, limb in enumerate(limbs)],
        *[F.sum(limb.bitwiseAND(half)).alias(f"low{i}") for i, limb in enumerate(limbs)],
    )
    weight = F.lit(1 << 30).cast("decimal(10,0)")
    totals = [
        F.coalesce(
            F.sum((F.col(f"high{i}") * weight + F.col(f"low{i}")).cast("decimal(28,0)")),
            F.lit(0).cast("decimal(38,0)"),
        ).alias(f"limb{i}")
        for i in range(len(LIMBS))
    ]
    sums = by_part.groupBy(*groups).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), *totals
    )
    text = F.concat_ws(
        "|",
        F.lit(header),
        F.col("row_count").cast("string"),
        *[F.col(f"limb{i}").cast("string") for i in range(len(LIMBS))],
    )
    return sums.select(*groups, "row_count", digest(text).alias("fingerprint"))


def header_text(columns: Sequence[str]) -> str:
    return json.dumps(list(columns), separators=(",", ":"))


def table_fingerprint(
    df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = ()
) -> DataFrame:
    """Order-insensitive, multiplicity-sensitive: ``row_count, fingerprint``.

    Columns are taken by sorted name and 1 equals 1.0.
    """
    names = sorted(columns if columns is not None else set(df.columns) - set(groups))
    text = row_text(df.schema, names, unify_numbers=True)
    hashed = df.select(*groups, digest(text).alias("row_hash"))
    return _combine(hashed, header_text(names), groups)


_LANE_NAMES = [f"lane{i}" for i in range(len(LANES))]
_RUNS = "part int, n long, " + ", ".join(f"{name} long" for name in _LANE_NAMES)


def _runs(part: int, n: int, lanes: Sequence[int]) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int32()), pa.array([n], pa.int64())]
    columns += [pa.array([lane], pa.int64()) for lane in lanes]
    return pa.RecordBatch.from_arrays(columns, names=["part", "n", *_LANE_NAMES])


def _digest_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for all rows of a task, which come in order."""
    n, lanes = 0, [0] * len(LANES)
    for batch in batches:
        n += batch.num_rows
        for i, base in enumerate(BASES):
            value = lanes[i]
            for row in batch.column(i).to_pylist():
                value = (value * base + row) % PRIME
            lanes[i] = value
    if n:
        yield _runs(TaskContext.get().partitionId(), n, lanes)


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for all runs, joined in the order of their ranges."""
    found = sorted((tuple(r.values()) for b in batches for r in b.to_pylist()), key=lambda r: r[0])
    n, lanes = 0, [0] * len(LANES)
    for _, more, *right in found:
        lanes = [
            (left * pow(base, more, PRIME) + own) % PRIME
            for left, base, own in zip(lanes, BASES, right)
        ]
        n += more
    yield _runs(0, n, lanes)


def ordered_fingerprint(
    df: DataFrame, order: str, tie: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Order-sensitive over ``(order, tie)``, missing last; column order and number types matter too.

    Rows that agree in both keys are ordered by their digest, so layout never shows. The only
    shuffle is by ranges of keys and digest, so neither a hot key nor a hot pair of keys is one
    task; it carries two keys and a digest however wide the table is. The last step reads one row
    per range. Exchanging two neighbouring rows that differ always shows, since the base is not 1.
    """
    names = list(columns if columns is not None else df.columns)
    narrow = df.select(
        quoted(order).alias("_order"),
        quoted(tie).alias("_tie_key"),
        digest(row_text(df.schema, names)).alias("_row"),
    )
    keys = [F.asc_nulls_last(c) for c in ("_order", "_tie_key", "_row")]
    lanes = [
        F.conv(F.substring("_row", start, length), 16, 10).cast("long").alias(name)
        for (start, length), name in zip(LANES, _LANE_NAMES)
    ]
    runs = (
        narrow.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*lanes)
        .mapInArrow(_digest_run, _RUNS)
    )
    whole = runs.repartition(1).mapInArrow(_join_runs, _RUNS)
    parts = [F.col(c).cast("string") for c in ("n", *_LANE_NAMES)]
    text = F.concat_ws("|", F.lit(header_text(names)), *parts)
    return whole.select(F.col("n").alias("row_count"), digest(text).alias("fingerprint"))


def row_identity_fingerprint(df: DataFrame, order: str, tie: str, id_col: str) -> DataFrame:
    """Ordered fingerprint of the ids alone."""
    return ordered_fingerprint(df, order, tie, [id_col])


def category_tokens(df: DataFrame, column: str, key: Column | None = None) -> DataFrame:
    """Distinct categories as opaque tokens with counts: ``token, row_count``."""
    typed = key if key is not None else category_key(quoted(column), df.schema[column].dataType)
    counted = df.groupBy(typed.alias("k")).agg(F.count("*").alias("row_count"))
    return counted.filter(F.col("k").isNotNull()).select(
        category_token(F.col("k")).alias("token"), "row_count"
    )


def observed_identity(
    df: DataFrame, id_col: str, time_col: str, label_col: str
) -> DataFrame:
    """Row count, class counts, time bounds, id uniqueness and column list in one aggregate."""
    label = quoted(label_col).try_cast("double") if isinstance(
        df.schema[label_col].dataType, T.StringType
    ) else quoted(label_col).cast("double")
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(label == 0).alias("label_0"),
        F.count_if(label == 1).alias("label_1"),
        F.min(time_col).alias("dt_min"),
        F.max(time_col).alias("dt_max"),
        duplicate_count(df, id_col).alias("repeated_ids"),
    )
