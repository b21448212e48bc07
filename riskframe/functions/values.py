"""Missing, invalid and finite values, kept apart the same way for every source.

NaN and NULL are one value, *missing*. Infinity and unparsable text are *invalid*.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text accepted as a number when a numeric column arrives as strings. Java's
# 'd'/'f' suffixes, which a plain cast would accept, are excluded.
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_TEXT = r"^\s*[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\s*$"

# Texts that a delimited file may use for "missing".
MISSING_TEXT = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

FLOATING = (T.FloatType, T.DoubleType)
NUMERIC = (T.NumericType, T.BooleanType)


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(data_type: T.DataType) -> bool:
    """Numeric role test; booleans count as numeric."""
    return isinstance(data_type, NUMERIC)


def nan_to_null(column: Column, data_type: T.DataType) -> Column:
    return F.when(~F.isnan(column), column) if isinstance(data_type, FLOATING) else column


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column."""
    return df.select(
        *[nan_to_null(quoted(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def text_missing_to_null(
    df: DataFrame, columns: Iterable[str] | None = None, texts: Sequence[str] = MISSING_TEXT
) -> DataFrame:
    """Map the usual missing-value texts of delimited files to NULL."""
    chosen = None if columns is None else set(columns)
    out = []
    for field in df.schema.fields:
        column = quoted(field.name)
        if isinstance(field.dataType, T.StringType) and (chosen is None or field.name in chosen):
            column = F.when(~column.isin(*texts), column)
        out.append(column.alias(field.name))
    return df.select(*out)


def is_missing(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, FLOATING):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def is_finite(number: Column) -> Column:
    """True for a double that is neither NULL, NaN nor infinite; never NULL."""
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def finite_or_null(number: Column) -> Column:
    return F.when(is_finite(number), number)


def to_number(column: Column, data_type: T.DataType) -> Column:
    """Coerce to double; what cannot be read as a number becomes NULL, NaN becomes NULL."""
    if isinstance(data_type, FLOATING):
        return nan_to_null(column, data_type).cast("double")
    if is_numeric(data_type):
        return column.cast("double")
    if isinstance(data_type, T.StringType):
        readable = column.rlike(NUMBER_TEXT) | column.rlike(INFINITY_TEXT)
        return F.when(readable, F.trim(column).try_cast("double"))
    if isinstance(data_type, T.NullType):
        return F.lit(None).cast("double")
    raise TypeError(f"no numeric reading for a column of type {data_type.simpleString()}")


def measured(column: Column, data_type: T.DataType) -> Column:
    """One double that carries all three states: finite value, NULL missing, NaN invalid."""
    if isinstance(data_type, FLOATING + (T.StringType,)):
        number = to_number(column, data_type)
        return F.when(is_missing(column, data_type), F.lit(None).cast("double")).otherwise(
            F.when(is_finite(number), number).otherwise(F.lit(float("nan")))
        )
    return to_number(column, data_type)


def is_measured(column: Column) -> Column:
    """Finite state of a column built by :func:`measured`; never NULL."""
    return column.isNotNull() & ~F.isnan(column)


def valid_probability(number: Column) -> Column:
    return is_finite(number) & number.between(0.0, 1.0)


def valid_decision(number: Column) -> Column:
    return F.coalesce(number.isin(0.0, 1.0), F.lit(False))
