"""Train-fitted feature preparation: roles, alignment, imputation and category encoding.

Fitted state is data, not closures: medians and codes are small tables bounded by the
schema, frequencies are a table of any size.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.local import freeze, local_rows
from riskframe.functions.values import is_missing, is_numeric, quoted, to_number
from riskframe.operators.encode import dictionary, encode
from riskframe.operators.quantiles import wide_quantiles
from riskframe.session import durable, parallelism

MISSING_CATEGORY = "__missing__"
UNKNOWN_CODE = -1
DROP_HIGH_CARDINALITY = "ordinal_drop_high_cardinality"
FREQUENCY_HIGH_CARDINALITY = "frequency_high_cardinality"
STRATEGIES = (DROP_HIGH_CARDINALITY, FREQUENCY_HIGH_CARDINALITY)


@dataclass(frozen=True)
class FeatureSchema:
    """Column roles, decided once from the training split."""

    numeric: tuple[str, ...]
    ordinal: tuple[str, ...]
    frequency: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()

    @property
    def categorical(self) -> tuple[str, ...]:
        return self.ordinal + self.frequency

    @property
    def columns(self) -> tuple[str, ...]:
        return self.numeric + self.categorical


def category_text(column: Column, data_type: T.DataType) -> Column:
    """Category value as text, NULL when missing."""
    text = column if isinstance(data_type, T.StringType) else column.cast("string")
    return F.when(~is_missing(column, data_type), text)


def categories_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value``: one row per input row and categorical column."""
    types = df.schema
    if len(columns) == 1:
        # A single column needs no unpivot.
        name = columns[0]
        return df.select(
            F.lit(name).alias("feature"),
            category_text(quoted(name), types[name].dataType).alias("value"),
        )
    wide = df.select(*[category_text(quoted(c), types[c].dataType).alias(c) for c in columns])
    return wide.unpivot([], [quoted(c) for c in columns], "feature", "value")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, distinct_values`` without missing; values collapse before the shuffle."""
    values = categories_long(df, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))
    return values.groupBy("feature").agg(F.count("value").alias("distinct_values"))


def candidate_columns(
    df: DataFrame, exclude: Sequence[str]
) -> tuple[list[str], list[str]]:
    """Numeric and other columns, without the excluded ones."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    numeric = [f.name for f in fields if is_numeric(f.dataType)]
    return numeric, [f.name for f in fields if not is_numeric(f.dataType)]


def column_roles(
    df: DataFrame,
    exclude: Sequence[str] = ("TransactionID", "isFraud"),
    max_distinct: int = 200,
    strategy: str = DROP_HIGH_CARDINALITY,
) -> DataFrame:
    """``column_name, role, distinct_values``; roles numeric, ordinal, frequency, dropped."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown categorical strategy {strategy!r}; use one of {STRATEGIES}")
    numeric, others = candidate_columns(df, exclude)
    schema = "column_name string, role string, distinct_values bigint"
    roles = local_rows(df.sparkSession, [(c, "numeric", None) for c in numeric], schema)
    if not others:
        return roles
    wide = "frequency" if strategy == FREQUENCY_HIGH_CARDINALITY else "dropped"
    names = local_rows(df.sparkSession, [(c,) for c in others], "feature string")
    counted = names.join(distinct_counts(df, others), "feature", "left")
    known = F.coalesce("distinct_values", F.lit(0))
    role = F.when(known <= max_distinct, F.lit("ordinal")).otherwise(F.lit(wide))
    return roles.unionByName(
        counted.select(
            F.col("feature").alias("column_name"), role.alias("role"), known.alias("distinct_values")
        )
    )


def infer_schema(
    df: DataFrame,
    exclude: Sequence[str] = ("TransactionID", "isFraud"),
    max_distinct: int = 200,
    strategy: str = DROP_HIGH_CARDINALITY,
) -> FeatureSchema:
    """Roles as a driver-side schema, columns kept in table order."""
    found = {r.column_name: r.role for r in column_roles(df, exclude, max_distinct, strategy).collect()}

    def having(role: str) -> tuple[str, ...]:
        return tuple(c for c in df.columns if found.get(c) == role)

    return FeatureSchema(having("numeric"), having("ordinal"), having("frequency"), having("dropped"))


def align(df: DataFrame, schema: FeatureSchema, keep: Sequence[str] = ()) -> DataFrame:
    """Project any table onto the fitted columns: absent ones NULL, extra ones gone, types coerced."""
    out = [quoted(c) for c in keep]
    for name in schema.numeric:
        if name in df.columns:
            number = to_number(quoted(name), df.schema[name].dataType)
        else:
            number = F.lit(None).cast("double")
        out.append(number.alias(name))
    for name in schema.categorical:
        if name in df.columns:
            text = category_text(quoted(name), df.schema[name].dataType)
        else:
            text = F.lit(None).cast("string")
        out.append(text.alias(name))
    return df.select(*out)


def fit_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, median``: exact medians of aligned numeric columns, 0.0 where all is missing."""

    numbers = df.select(*[to_number(quoted(c), df.schema[c].dataType).alias(c) for c in columns])
    found = wide_quantiles(numbers, list(columns), [0.5])
    medians = [(c, found[c][0] if found.get(c) else 0.0) for c in columns]
    return local_rows(df.sparkSession, medians, "feature string, median double")


def fit_codes(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``feature, value, code``: 0..k-1 in value order, missing counted as its own value.

    Values are dealt into ranges of (feature, value) by splitters from a sample of whole values, so
    one feature with very many values, alike as they may begin, is not one task. A range starts
    where the counts of the ranges before it end.
    """
    if not columns:
        return local_rows(df.sparkSession, [], "feature string, value string, code double")
    values = (
        categories_long(df, columns)
        .select("feature", F.coalesce("value", F.lit(MISSING_CATEGORY)).alias("value"))
        .distinct()
    )
    # Cut here: the splitters are sampled anew whenever the exchange is.
    ranged = durable(
        values.repartitionByRange(ranges or parallelism(df.sparkSession), "feature", "value").withColumn(
            "range", F.spark_partition_id()
        )
    )
    earlier = (
        Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        ranged.groupBy("feature", "range")
        .agg(F.count("*").alias("n"))
        .select("feature", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("feature", "range").orderBy("value")
    return (
        ranged.withColumn("place", F.row_number().over(inside) - 1)
        .join(starts, ["feature", "range"])
        .select("feature", "value", (F.col("start") + F.col("place")).cast("double").alias("code"))
    )


def fit_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, frequency``: share of all rows, missing counted as its own value."""
    if not columns:
        return local_rows(df.sparkSession, [], "feature string, value string, frequency double")
    counted = (
        categories_long(df, columns)
        .select("feature", F.coalesce("value", F.lit(MISSING_CATEGORY)).alias("value"))
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )
    # One row per feature, hence the broadcast.
    totals = counted.groupBy("feature").agg(F.sum("n").alias("total"))
    return counted.join(F.broadcast(totals), "feature").select(
        "feature", "value", (F.col("n") / F.col("total")).alias("frequency")
    )


def impute(df: DataFrame, schema: FeatureSchema, medians: dict[str, float]) -> DataFrame:
    """Fill missing numbers by their fitted median and missing categories by the token."""
    filled = {c: F.coalesce(quoted(c), F.lit(medians[c])) for c in schema.numeric}
    filled.update({c: F.coalesce(quoted(c), F.lit(MISSING_CATEGORY)) for c in schema.categorical})
    return df.select(*[filled.get(c, quoted(c)).alias(c) for c in df.columns])


def encode_ordinal(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by codes, unknown ones by -1."""
    return encode(df, dictionary(codes, "code"), columns, UNKNOWN_CODE)


def encode_frequency(
    df: DataFrame, frequencies: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Replace categories by fitted frequencies, unseen ones by 0.0."""
    return encode(df, dictionary(frequencies, "frequency"), columns, 0.0)


class FeaturePreparer(Estimator):
    """Fits medians, codes and frequencies on the training rows only."""

    def __init__(self, schema: FeatureSchema) -> None:
        super().__init__()
        self.schema = schema

    def _fit(self, dataset: DataFrame) -> FeaturePreparerModel:
        aligned = align(dataset, self.schema)
        return FeaturePreparerModel(
            self.schema,
            fit_medians(aligned, self.schema.numeric),
            freeze(fit_codes(aligned, self.schema.ordinal)),
            durable(fit_frequencies(aligned, self.schema.frequency)),
        )


class FeaturePreparerModel(Model):
    """align -> impute -> encode, the same for training, batch and streaming rows."""

    def __init__(
        self, schema: FeatureSchema, medians: DataFrame, codes: DataFrame, frequencies: DataFrame
    ) -> None:
        super().__init__()
        self.schema = schema
        self.medians = medians
        self.codes = codes
        self.frequencies = frequencies
        self._median_values = {r.feature: r.median for r in medians.collect()}
        self._codes = dictionary(codes, "code")
        self._frequencies = dictionary(frequencies, "frequency")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.prepare(dataset)

    def prepare(self, dataset: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Prepared feature columns, after the ``keep`` columns passed through as they are."""
        overlap = set(keep) & set(self.schema.columns)
        if overlap:
            raise ValueError(f"columns both kept and prepared: {sorted(overlap)}")
        out = impute(align(dataset, self.schema, keep), self.schema, self._median_values)
        out = encode(out, self._codes, self.schema.ordinal, UNKNOWN_CODE)
        return encode(out, self._frequencies, self.schema.frequency, 0.0)

    def write_to(self, path: str) -> None:
        """State as parquet tables plus the schema as JSON text."""
        base = path.rstrip("/")
        self.medians.write.mode("errorifexists").parquet(f"{base}/medians")
        self.codes.write.mode("errorifexists").parquet(f"{base}/codes")
        self.frequencies.write.mode("errorifexists").parquet(f"{base}/frequencies")
        text = json.dumps(asdict(self.schema), sort_keys=True)
        spark = self.medians.sparkSession
        local_rows(spark, [(text,)], "value string").coalesce(1).write.text(f"{base}/schema")

    @classmethod
    def read_from(cls, spark: SparkSession, path: str) -> FeaturePreparerModel:
        base = path.rstrip("/")
        fields = json.loads(spark.read.text(f"{base}/schema").first().value)
        return cls(
            FeatureSchema(**{k: tuple(v) for k, v in fields.items()}),
            freeze(spark.read.parquet(f"{base}/medians")),
            freeze(spark.read.parquet(f"{base}/codes")),
            spark.read.parquet(f"{base}/frequencies"),
        )


def first_rows(
    df: DataFrame, columns: Sequence[str], time_col: str, id_col: str, count: int = 5
) -> DataFrame:
    """Example rows of the model columns: the earliest ``count``, by a top-k without a full sort."""
    ordered = df.orderBy(quoted(time_col).asc_nulls_last(), quoted(id_col)).limit(count)
    return ordered.select(*[quoted(c) for c in columns])
