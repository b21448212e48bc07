"""What the corpus operators share: word rules, row packing and durable cuts of lineage.

Every operator first packs its input into one ``row`` column, so a caller's columns can have
any name without meeting the operator's own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these six characters; everything else, other Unicode spaces
# included, belongs to words.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def packed(df: DataFrame) -> DataFrame:
    """One struct column ``row`` with all columns of the input."""
    return df.select(F.struct("*").alias("row"))


def unpacked(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def content(column: str = "text") -> Column:
    """The text of a packed row; a missing text is an empty one."""
    return F.coalesce(F.col(f"row.`{column}`"), F.lit(""))


def row_tie(columns: Iterable[str]) -> Column:
    """Hash over the given columns of a packed row; orders rows that agree in everything else."""
    names = list(columns)
    if not names:
        return F.lit(0).cast("long")
    return F.xxhash64(F.to_json(F.struct(*[F.col(f"row.`{c}`").alias(c) for c in names])))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session whose driver is its single executor may do without the setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="riskframe-shared-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, kind: str) -> str:
    return os.path.join(shared_folder(spark), f"{kind}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Evaluate once into the shared folder, so lost executors cost no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
