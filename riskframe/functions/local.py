"""Small driver-side tables as local relations.

Spark knows the size of a local relation, so it broadcasts it and folds projections over it;
a table parallelised from Python rows has no known size and would be shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_rows(
    spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType
) -> DataFrame:
    """Table of rows whose number is bounded by configuration, not by data."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = struct.fieldNames()
    table = pa.Table.from_pylist(
        [dict(zip(names, row)) for row in rows], schema=to_arrow_schema(struct)
    )
    return spark.createDataFrame(table, schema=struct)


def freeze(df: DataFrame) -> DataFrame:
    """Evaluate a table bounded by configuration and keep it as a local relation."""
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)
