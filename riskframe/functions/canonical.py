"""Canonical typed text of cells and rows, and digests over it.

Every cell text is ``tag:length:value``, so neither a delimiter inside a value nor a
NULL can make two different rows read the same.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.values import is_missing, quoted

DIGEST_PATTERN = "^[0-9a-f]{64}$"
CATEGORY_PREFIX = "CATEGORY_"

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)


class UnsupportedTypeError(TypeError):
    """The column type has no canonical text; fingerprints refuse to guess."""


def number_text(column: Column, data_type: T.DataType) -> Column:
    """One text for equal numbers of any type: whole ones without a fraction."""
    if isinstance(data_type, INTEGRAL):
        return column.cast("string")
    value = column.cast("double")
    small = F.abs(value) < F.lit(float(2**53))
    whole = F.when(small, F.floor(value) == value).otherwise(F.lit(False))
    return F.when(whole, F.floor(value).cast("string")).otherwise(value.cast("string"))


def _tagged(tag: str, text: Column) -> Column:
    return F.concat(F.lit(tag + ":"), F.length(text).cast("string"), F.lit(":"), text)


def cell_text(column: Column, data_type: T.DataType, unify_numbers: bool = False) -> Column:
    """Typed text of one cell.

    ``unify_numbers`` writes integers, decimals and floats as the same number text, so 1
    and 1.0 agree; otherwise each keeps its own tag.
    """
    if isinstance(data_type, T.NullType):
        return F.lit("missing")
    if isinstance(data_type, T.BooleanType):
        text = _tagged("boolean", column.cast("string"))
    elif isinstance(data_type, INTEGRAL + FLOATING + (T.DecimalType,)):
        if unify_numbers:
            text = _tagged("number", number_text(column, data_type))
        else:
            tag = (
                "integer"
                if isinstance(data_type, INTEGRAL)
                else "float" if isinstance(data_type, FLOATING) else "decimal"
            )
            text = _tagged(tag, column.cast("string"))
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = _tagged("datetime", F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    elif isinstance(data_type, T.DateType):
        text = _tagged("date", column.cast("string"))
    elif isinstance(data_type, T.StringType):
        text = _tagged("string", column)
    elif isinstance(data_type, T.BinaryType):
        text = _tagged("bytes", F.lower(F.hex(column)))
    else:
        raise UnsupportedTypeError(
            f"no canonical text for a column of type {data_type.simpleString()}"
        )
    return F.when(is_missing(column, data_type), F.lit("missing")).otherwise(text)


def row_text(
    schema: T.StructType, columns: Sequence[str], unify_numbers: bool = False
) -> Column:
    """Canonical text of a row over ``columns`` in the given order."""
    return F.concat_ws(
        "|", *[cell_text(quoted(c), schema[c].dataType, unify_numbers) for c in columns]
    )


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def category_key(column: Column, data_type: T.DataType) -> Column:
    """Typed key of a category value, NULL when missing.

    One cell alone needs no length mark, and without it keys sort like their values.
    """
    if isinstance(data_type, T.StringType):
        key = F.concat(F.lit("string:"), column)
    elif isinstance(data_type, T.BooleanType):
        key = F.concat(F.lit("boolean:"), column.cast("string"))
    elif isinstance(data_type, INTEGRAL + FLOATING + (T.DecimalType,)):
        key = F.concat(F.lit("number:"), number_text(column, data_type))
    else:
        key = cell_text(column, data_type)
    return F.when(~is_missing(column, data_type), key)


def category_token(key: Column) -> Column:
    return F.concat(F.lit(CATEGORY_PREFIX), digest(key))


def token_text(key: str) -> str:
    """Driver-side form of :func:`category_token`."""
    return CATEGORY_PREFIX + hashlib.sha256(key.encode()).hexdigest()


def is_digest(column: Column) -> Column:
    return F.coalesce(column.rlike(DIGEST_PATTERN), F.lit(False))


def canonical_json(value: Any) -> str:
    """Sorted-key JSON without blanks; refuses NaN and Infinity."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False)


def json_digest(value: Any) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def struct_json(*columns: Column) -> Column:
    """JSON text of a struct with NULL fields written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
