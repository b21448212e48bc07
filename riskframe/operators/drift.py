"""Reference-versus-current comparison; numbers are counted wide, categories unpivoted.

Each side is scanned a fixed number of times whatever the number of features: once for the
profile, once for numeric buckets, once for categories. What travels between the steps -
profiles, edges, top categories - has one row per feature or bucket and so is bounded by
the contract, never by the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.canonical import category_key, category_token, token_text
from riskframe.functions.local import freeze, local_rows
from riskframe.functions.scalars import even_probabilities
from riskframe.functions.values import (
    is_measured,
    measured,
    quoted,
    valid_decision,
    valid_probability,
)
from riskframe.operators.contract import Contract, ContractError
from riskframe.operators.quantiles import wide_quantiles
from riskframe.session import durable

OTHER, MISSING, UNKNOWN = "OTHER", "MISSING", "UNKNOWN"
# Inner edges of the ten probability buckets.
PROBABILITY_EDGES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
SUMMARY_PROBABILITIES = [0.05, 0.5, 0.95]

CONSTANT, QUANTILES, DECILES = (
    "constant_reference",
    "reference_quantiles",
    "fixed_probability_deciles",
)
UNAVAILABLE, NO_BUCKETS = "unavailable_all_nonfinite", "none"
BUCKETED = (CONSTANT, QUANTILES, DECILES)

NUMERIC, PROBABILITY, DECISION = "numeric", "probability", "decision"
CATEGORICAL = "categorical"

PROFILE = (
    "feature string, role string, row_count bigint, finite_count bigint, missing_count bigint, "
    "invalid_count bigint, mean double, std double, min double, max double, "
    "q05 double, q50 double, q95 double"
)
BIN_SPEC = "feature string, role string, strategy string, edges array<double>, constant double"
BUCKETS = (
    "feature string, kind string, bucket string, position int, reference_count bigint"
)
PROFILE_COLUMNS = [part.split()[0] for part in PROFILE.split(", ")]


def check_columns(df: DataFrame, name: str) -> None:
    if any(not c for c in df.columns):
        raise ContractError(f"{name} has an unnamed column")
    if len(set(df.columns)) != len(df.columns):
        raise ContractError(f"{name} has duplicate column names")


def _number(df: DataFrame, column: str) -> Column:
    """Measured value of a column; a column the table lacks is missing everywhere."""
    if column not in df.columns:
        return F.lit(None).cast("double")
    return measured(quoted(column), df.schema[column].dataType)


def _only(valid: Column, number: Column) -> Column:
    """Values outside the valid range become invalid, missing stays missing."""
    return F.when(number.isNull() | valid, number).otherwise(F.lit(float("nan")))


def numeric_roles(contract: Contract) -> list[tuple[str, str]]:
    roles = [(name, NUMERIC) for name in contract.numeric]
    if contract.probability is not None:
        roles.append((contract.probability, PROBABILITY))
    if contract.decision is not None:
        roles.append((contract.decision, DECISION))
    return roles


def _unpivot(df: DataFrame, columns: Sequence[tuple[str, Column]]) -> DataFrame:
    """``feature, value`` rows, one per input row and column."""
    wide = df.select(*[column.alias(name) for name, column in columns])
    return wide.unpivot([], [quoted(name) for name, _ in columns], "feature", "value")


def numeric_columns(
    df: DataFrame, contract: Contract, features: Sequence[str] | None = None
) -> list[tuple[str, Column]]:
    """Numeric features, probability and decision with their measured values."""
    columns = []
    for name, role in numeric_roles(contract):
        if features is not None and name not in features:
            continue
        number = _number(df, name)
        if role == PROBABILITY:
            number = _only(valid_probability(number), number)
        elif role == DECISION:
            number = _only(valid_decision(number), number)
        columns.append((name, number))
    return columns


def categorical_long(df: DataFrame, contract: Contract) -> DataFrame:
    """``feature, value``: typed category keys, NULL when missing."""
    columns = []
    for name in contract.categorical:
        if name in df.columns:
            key = category_key(quoted(name), df.schema[name].dataType)
        else:
            key = F.lit(None).cast("string")
        columns.append((name, key))
    return _unpivot(df, columns)


#: Columns per wide aggregate; a table of any width is profiled in chunks of so many.
PROFILE_CHUNK = 40


def numeric_profile(df: DataFrame, contract: Contract) -> DataFrame:
    """Counts and moments per feature from wide aggregates: no row is multiplied by columns.

    Means and deviations are sums of doubles, so their last digits can depend on the layout;
    counts, extremes and everything compared by counts do not.
    """
    columns = numeric_columns(df, contract)
    parts = []
    for start in range(0, len(columns), PROFILE_CHUNK):
        chunk = columns[start : start + PROFILE_CHUNK]
        wide = df.select(*[column.alias(f"v{i}") for i, (_, column) in enumerate(chunk)])
        measures, shaped = [F.count("*").alias("rows")], []
        for i, (name, _) in enumerate(chunk):
            value = F.col(f"v{i}")
            finite = F.when(is_measured(value), value)
            own = {
                "finite_count": F.count(finite),
                "missing_count": F.count_if(value.isNull()),
                "invalid_count": F.count_if(F.isnan(value)),
                "mean": F.avg(finite),
                "std": F.stddev_pop(finite),
                "min": F.min(finite),
                "max": F.max(finite),
            }
            measures += [c.alias(f"{m}{i}") for m, c in own.items()]
            shaped.append(
                F.struct(
                    F.lit(name).alias("feature"),
                    F.col("rows").alias("row_count"),
                    *[F.col(f"{m}{i}").alias(m) for m in own],
                )
            )
        found = wide.agg(*measures).where("rows > 0")
        parts.append(found.select(F.explode(F.array(*shaped)).alias("p")).select("p.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def numeric_buckets(df: DataFrame, contract: Contract, spec: DataFrame) -> DataFrame:
    """``feature, position, row_count`` of the buckets that hold a finite value.

    A bucket's position is the number of edges at or below the value; around a constant it is 0
    below, 1 at and 2 above it. Tasks count all columns in the row batch and send one row per
    bucket; the spec has one row per feature.
    """
    columns = numeric_columns(df, contract)
    places = {name: i for i, (name, _) in enumerate(columns)}
    rules = [
        (r.feature, places[r.feature], [r.constant] if r.strategy == CONSTANT else r.edges)
        for r in spec.filter(F.col("strategy").isin(*BUCKETED)).collect()
        if r.feature in places
    ]
    constants = {r.feature for r in spec.filter(F.col("strategy") == CONSTANT).collect()}

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(len(edges) + 2, np.int64) for _, _, edges in rules]
        for batch in stream:
            for total, (feature, i, edges) in zip(totals, rules):
                values = batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
                values = values[~np.isnan(values)]
                found = np.searchsorted(edges, values, side="right")
                if feature in constants:
                    found = found + (values > edges[0])
                total += np.bincount(found, minlength=len(total))
        rows = [
            (feature, position, n)
            for total, (feature, _, _) in zip(totals, rules)
            for position, n in enumerate(total.tolist())
            if n
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(COUNTED)], schema=COUNTED
        )

    wide = df.select(*[column.cast("double").alias(f"c{i}") for i, (_, column) in enumerate(columns)])
    counted = wide.mapInArrow(count, "feature string, position int, row_count bigint")
    return counted.groupBy("feature", "position").agg(F.sum("row_count").alias("row_count"))


COUNTED = pa.schema([("feature", pa.string()), ("position", pa.int32()), ("row_count", pa.int64())])


def bucket_names(strategy: str, edges: Sequence[float] | None) -> list[str]:
    """Every bucket of a feature in order, empty ones included."""
    if strategy == CONSTANT:
        return ["BELOW_CONSTANT", "AT_CONSTANT", "ABOVE_CONSTANT"]
    if strategy in BUCKETED:
        return [f"BIN_{i:02d}" for i in range(len(edges or ()) + 1)]
    return []


def category_counts(long: DataFrame) -> DataFrame:
    """``feature, value, row_count``; a hot category collapses before the shuffle."""
    return long.groupBy("feature", "value").agg(F.count("*").alias("row_count"))


def top_categories(counts: DataFrame, top_k: int) -> DataFrame:
    """Most frequent ``top_k`` known keys per feature, ties by key.

    The rank filter lets Spark keep only ``top_k`` rows per feature and task before the shuffle.
    """
    order = Window.partitionBy("feature").orderBy(F.desc("row_count"), F.asc("value"))
    return (
        counts.filter(F.col("value").isNotNull())
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= top_k)
    )


def category_buckets(counts: DataFrame, known: DataFrame, top: DataFrame) -> DataFrame:
    """Route counted categories to token, OTHER, MISSING or UNKNOWN and add them up.

    ``known`` holds the reference keys (``feature, value``), ``top`` the few tokens.
    Both sides of the key join are unique per (feature, key), so it cannot skew.
    """
    routed = (
        counts.join(
            F.broadcast(top.select("feature", "value", F.col("place"))),
            ["feature", "value"],
            "left",
        )
        .join(
            known.select("feature", "value", F.lit(True).alias("is_known")),
            ["feature", "value"],
            "left",
        )
        .select(
            "feature",
            F.when(F.col("value").isNull(), F.lit(MISSING))
            .when(F.col("place").isNotNull(), category_token(F.col("value")))
            .when(F.col("is_known"), F.lit(OTHER))
            .otherwise(F.lit(UNKNOWN))
            .alias("bucket"),
            "row_count",
        )
        .groupBy("feature", "bucket")
        .agg(F.sum("row_count").alias("row_count"))
    )
    return routed


def total_variation(buckets: DataFrame) -> DataFrame:
    """Half the summed share differences per feature, from integer counts.

    ``buckets`` has ``reference_count`` and ``current_count``. Numerator and denominator are
    exact; one division rounds once, so verdicts at a threshold never depend on the layout.
    An empty current side has all shares 0, which gives one half.
    """
    wide = "decimal(19,0)"
    per_feature = Window.partitionBy("feature")
    sized = buckets.select(
        "feature",
        F.col("reference_count").cast(wide).alias("a"),
        F.col("current_count").cast(wide).alias("b"),
        F.sum("reference_count").over(per_feature).cast(wide).alias("nr"),
        F.sum("current_count").over(per_feature).cast(wide).alias("nc"),
    )
    gap = F.abs(F.col("a") * F.col("nc") - F.col("b") * F.col("nr"))
    summed = sized.groupBy("feature").agg(
        F.sum(gap).cast("double").alias("gap"), F.max("nr").alias("nr"), F.max("nc").alias("nc")
    )
    both = (2 * F.col("nr") * F.col("nc")).cast("double")
    one_empty = F.when((F.col("nr") == 0) & (F.col("nc") == 0), 0.0).otherwise(0.5)
    return summed.select(
        "feature",
        F.when((F.col("nr") > 0) & (F.col("nc") > 0), F.col("gap") / both)
        .otherwise(one_empty)
        .alias("total_variation"),
    )


@dataclass(frozen=True)
class ReferenceState:
    """Everything a current table is compared with; computed once, then frozen.

    Only ``categories`` (reference keys) can be large. The other tables are local, with a
    bounded number of rows per feature.
    """

    contract: Contract
    profile: DataFrame
    bins: DataFrame
    buckets: DataFrame
    top: DataFrame
    categories: DataFrame

    def save(self, path: str) -> None:
        base = path.rstrip("/")
        for name in STATE_TABLES:
            getattr(self, name).write.mode("errorifexists").parquet(f"{base}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, contract: Contract) -> ReferenceState:
        base = path.rstrip("/")
        tables = {name: spark.read.parquet(f"{base}/{name}") for name in STATE_TABLES}
        small = {n: freeze(t) for n, t in tables.items() if n != "categories"}
        return cls(contract, categories=tables["categories"], **small)


STATE_TABLES = ("profile", "bins", "buckets", "top", "categories")


def side_profile(
    df: DataFrame, contract: Contract, extra: Sequence[float] = (), summary: bool = True
) -> tuple[list[dict], dict[str, list[float]]]:
    """Profile rows of one side, and the ``extra`` quantiles of its numeric features.

    One scan for counts, moments and bounds; quantiles add a few passes, the same number for any
    number of features. Both results have one row per feature.
    """
    roles = dict(numeric_roles(contract))
    if not roles:
        return [], {}
    rows = {r.feature: r.asDict() for r in numeric_profile(df, contract).collect()}
    probabilities = [*(SUMMARY_PROBABILITIES if summary else ()), *extra]
    quantiles: dict[str, list[float]] = {}
    if contract.numeric and probabilities and rows:
        columns = numeric_columns(df, contract, contract.numeric)
        found = wide_quantiles(
            df.select(*[column.alias(name) for name, column in columns]),
            contract.numeric,
            probabilities,
            {n: (r["finite_count"], r["min"], r["max"]) for n, r in rows.items()},
        )
        quantiles = {name: values or [] for name, values in found.items()}
    first = len(SUMMARY_PROBABILITIES) if summary else 0
    for name, row in rows.items():
        row["role"] = roles[name]
        head = quantiles.get(name, [])[:first] or [None, None, None]
        row.update(zip(("q05", "q50", "q95"), head))
    return list(rows.values()), {n: q[first:] for n, q in quantiles.items()}


def profile_table(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    return local_rows(spark, [[r[c] for c in PROFILE_COLUMNS] for r in rows], PROFILE)


def bucket_rule(row: dict, edges: Sequence[float]) -> tuple[str, list[float] | None, float | None]:
    """Strategy, edges and constant of one feature, decided by the reference alone."""
    if row["role"] == PROBABILITY:
        return DECILES, PROBABILITY_EDGES, None
    if row["role"] == DECISION:
        return NO_BUCKETS, None, None
    if not row["finite_count"]:
        return UNAVAILABLE, None, None
    if row["min"] == row["max"]:
        return CONSTANT, None, row["min"]
    return QUANTILES, sorted(set(edges)), None


def fit_reference(reference: DataFrame, contract: Contract) -> ReferenceState:
    """Profile, edges, bucket counts and category ranks of the reference table."""
    spark = reference.sparkSession
    check_columns(reference, "reference")
    absent = sorted(set(contract.columns) - set(reference.columns))
    if absent:
        raise ContractError(f"reference lacks columns: {', '.join(absent)}")
    profile, edges = side_profile(reference, contract, even_probabilities(contract.bins))
    if numeric_roles(contract) and not profile:
        raise ContractError("reference needs at least one row")
    for row in profile:
        if row["role"] != NUMERIC and not row["finite_count"]:
            raise ContractError(
                f"reference {row['role']} column {row['feature']!r} has no valid value"
            )
    rules = {r["feature"]: bucket_rule(r, edges.get(r["feature"], ())) for r in profile}
    bins = local_rows(
        spark, [(r["feature"], r["role"], *rules[r["feature"]]) for r in profile], BIN_SPEC
    )
    counted: dict[tuple, int] = {}
    if profile:
        found = numeric_buckets(reference, contract, bins).collect()
        counted = {(r.feature, r.position): r.row_count for r in found}
    buckets = [
        (feature, NUMERIC, bucket, i, counted.get((feature, i), 0))
        for feature, rule in rules.items()
        for i, bucket in enumerate(bucket_names(rule[0], rule[1]))
    ]
    categories = local_rows(spark, [], "feature string, value string, row_count bigint")
    top_rows: list = []
    if contract.categorical:
        categories = durable(category_counts(categorical_long(reference, contract)))
        top_rows = top_categories(categories, contract.top_k).collect()
        totals = {
            r.feature: r
            for r in categories.groupBy("feature")
            .agg(
                F.sum("row_count").alias("n"),
                F.sum(F.when(F.col("value").isNull(), F.col("row_count")).otherwise(0)).alias(
                    "missing"
                ),
            )
            .collect()
        }
        if not totals:
            raise ContractError("reference needs at least one row")
        for feature in contract.categorical:
            named = sorted((r for r in top_rows if r.feature == feature), key=lambda r: r.place)
            missing = totals[feature].missing
            other = totals[feature].n - missing - sum(r.row_count for r in named)
            listed = [(token_text(r.value), r.row_count) for r in named]
            listed += [(OTHER, other), (MISSING, missing), (UNKNOWN, 0)]
            buckets += [(feature, CATEGORICAL, b, i, n) for i, (b, n) in enumerate(listed)]
    return ReferenceState(
        contract,
        profile_table(spark, profile),
        bins,
        local_rows(spark, buckets, BUCKETS),
        local_rows(spark, top_rows, "feature string, value string, row_count bigint, place int"),
        categories,
    )


@dataclass(frozen=True)
class Comparison:
    """Small local tables of one comparison, all bounded by the contract."""

    contract: Contract
    present: dict[str, bool]
    profile: DataFrame
    buckets: DataFrame

    @property
    def distances(self) -> DataFrame:
        return total_variation(self.buckets)


def compare_current(
    state: ReferenceState, current: DataFrame, summary: bool = False
) -> Comparison:
    """Scan the current table against a frozen reference.

    Three scans at most: profile, numeric buckets, categories. ``summary`` adds the current
    quantiles, which no check needs, by a fourth.
    """
    contract, spark = state.contract, current.sparkSession
    check_columns(current, "current")
    present = {name: name in current.columns for name in contract.columns}
    profile, _ = side_profile(current, contract, summary=summary)
    if numeric_roles(contract) and not profile:
        raise ContractError("current needs at least one row")
    counted: dict[tuple, int] = {}
    if profile:
        found = numeric_buckets(current, contract, state.bins).collect()
        counted = {(r.feature, NUMERIC, r.position): r.row_count for r in found}
    if contract.categorical:
        counts = category_counts(categorical_long(current, contract))
        routed = category_buckets(counts, state.categories, state.top).collect()
        if not routed:
            raise ContractError("current needs at least one row")
        counted.update({(r.feature, CATEGORICAL, r.bucket): r.row_count for r in routed})
    rows = []
    for r in state.buckets.collect():
        place = r.position if r.kind == NUMERIC else r.bucket
        rows.append((*r, counted.get((r.feature, r.kind, place), 0)))
    return Comparison(
        contract,
        present,
        profile_table(spark, profile),
        local_rows(spark, rows, BUCKETS + ", current_count bigint"),
    )


def bucket_shares(buckets: DataFrame) -> DataFrame:
    """Long form: ``feature, side, bucket, position, row_count, share``."""
    side = F.explode(
        F.array(
            F.struct(F.lit("reference").alias("side"), F.col("reference_count").alias("n")),
            F.struct(F.lit("current").alias("side"), F.col("current_count").alias("n")),
        )
    )
    long = buckets.select("feature", "bucket", "position", side.alias("s")).select(
        "feature", "s.side", "bucket", "position", F.col("s.n").alias("row_count")
    )
    total = F.sum("row_count").over(Window.partitionBy("feature", "side"))
    return long.withColumn(
        "share", F.coalesce(F.try_divide(F.col("row_count").cast("double"), total), F.lit(0.0))
    )
