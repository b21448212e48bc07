"""Readers: delimited files with missing-value texts, table pairs, files as digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.values import (
    NUMBER_TEXT,
    is_numeric,
    normalise_missing,
    quoted,
    text_missing_to_null,
    to_number,
)
from riskframe.operators.audit import require_unique, validate_transactions
from riskframe.operators.joins import attach_identity
from riskframe.operators.sample import sample_table

BLOCK_BYTES = 64 << 20
PIECE_BYTES = 1 << 20
FAN = 1024
MOST_TASKS = 100_000
INTEGER_TEXT = r"^\s*[+-]?\d{1,18}\s*$"


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; usual missing texts become NULL.

    Give ``schema`` for large inputs: without one, types are inferred in one extra pass.
    """
    try:
        raw = (
            spark.read.option("header", True)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .csv(path)
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"table not found: {path}") from error
        raise
    clean = text_missing_to_null(raw)
    return typed(clean, schema if schema is not None else inferred_schema(clean))


def inferred_schema(text: DataFrame) -> T.StructType:
    """Type of each text column: bigint, double, boolean or string, from one aggregate."""
    columns = text.columns
    row = text.agg(
        *[
            F.struct(
                F.count(quoted(c)).alias("known"),
                F.coalesce(F.bool_and(quoted(c).rlike(INTEGER_TEXT)), F.lit(False)).alias("whole"),
                F.coalesce(F.bool_and(quoted(c).rlike(NUMBER_TEXT)), F.lit(False)).alias("number"),
                F.coalesce(
                    F.bool_and(F.lower(quoted(c)).isin("true", "false")), F.lit(False)
                ).alias("flag"),
                F.count_if(quoted(c).isNull()).alias("missing"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    fields = []
    for i, column in enumerate(columns):
        seen = row[f"c{i}"]
        if not seen.known or (seen.number and not seen.whole):
            data_type: T.DataType = T.DoubleType()
        elif seen.whole:
            data_type = T.LongType()
        elif seen.flag:
            data_type = T.BooleanType()
        else:
            data_type = T.StringType()
        fields.append(T.StructField(column, data_type))
    return T.StructType(fields)


def typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to ``schema``; unreadable numbers become NULL."""
    out = []
    for field in schema.fields:
        column = quoted(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = to_number(column, T.StringType()).cast(field.dataType)
        elif is_numeric(field.dataType):
            column = F.trim(column).try_cast(field.dataType)
        elif not isinstance(field.dataType, T.StringType):
            column = column.try_cast(field.dataType)
        out.append(column.alias(field.name))
    return text.select(*out)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, or CSV when the path says so."""
    if path.endswith((".csv", ".csv.gz")):
        return read_delimited(spark, path, schema)
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return normalise_missing(reader.parquet(path))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"table not found: {path}") from error
        raise


def load_pair(
    spark: SparkSession,
    folder: str,
    part: str = "train",
    labelled: bool = True,
    sample_rows: int | None = None,
    sampling: str = "time_ordered",
    seed: int = 42,
    id_col: str = "TransactionID",
    time_col: str = "TransactionDT",
    amount_col: str = "TransactionAmt",
    label_col: str = "isFraud",
    suffix: str = ".csv",
    transaction_schema: T.StructType | None = None,
    identity_schema: T.StructType | None = None,
) -> DataFrame:
    """Transactions left-joined with identity, validated. ``sample_rows`` None means all rows."""
    base = folder.rstrip("/")
    transactions = read_table(spark, f"{base}/{part}_transaction{suffix}", transaction_schema)
    identity = read_table(spark, f"{base}/{part}_identity{suffix}", identity_schema)
    if sample_rows is not None:
        transactions = sample_table(transactions, sampling, time_col, id_col, sample_rows, seed)
    # Checked before the join: a left join with unique keys adds and repeats no row.
    validate_transactions(
        transactions, id_col, time_col, amount_col, label_col if labelled else None
    )
    require_unique(identity, id_col)
    return attach_identity(transactions, identity, id_col)


def load_labelled(spark: SparkSession, folder: str, **options) -> DataFrame:
    return load_pair(spark, folder, part="train", labelled=True, **options)


def load_unlabelled(spark: SparkSession, folder: str, **options) -> DataFrame:
    return load_pair(spark, folder, part="test", labelled=False, **options)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One JSON record per line as text: ``record_id, record``.

    The id is a digest of file and content, so it survives a re-read; equal lines of one
    file share it and stay separate rows.
    """
    text = F.concat_ws("|", F.col("_metadata.file_path"), F.col("value"))
    return spark.read.text(path).select(
        F.sha2(text, 256).alias("record_id"), F.col("value").alias("record")
    )


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, length, sha256`` of whole file contents, one task per file.

    Spark's binaryFile source holds one file in memory at a time, up to 2 GB; ``file_tree_digests``
    has no such limit.
    """
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            "length",
            F.sha2("content", 256).alias("sha256"),
        )
    )


def file_tree_digests(
    spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, fan: int = FAN
) -> DataFrame:
    """``file_name, length, sha256`` of files of any size, read in blocks by as many tasks.

    The digest is the root of a tree: leaves digest blocks, a node digests up to ``fan`` digests
    below it, one digest alone is passed up, and the root is digested with the file's length.
    It depends on content and ``block_bytes``, not on tasks. A task holds a piece of a block, never
    a file. Executors open files by the same address through Arrow's file systems (local, HDFS,
    S3, GCS). Empty files are not listed by Spark's source and take no part. A file that has shrunk since it was listed, or cannot be opened, stops the job.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    last = F.greatest(F.ceil(F.col("length") / block_bytes) - 1, F.lit(0))
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    seen = files.agg(F.coalesce(F.sum(last + 1), F.lit(0)), F.coalesce(F.max(last + 1), F.lit(0)))
    count, longest = seen.first()
    # A number given here is not merged: rows are small, but each stands for a whole block.
    spread = blocks.repartition(max(1, min(int(count), MOST_TASKS)))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [
                _block_digest(r["path"], r["block"] * block_bytes, min(block_bytes, r["length"] - r["block"] * block_bytes))
                for r in batch.to_pylist()
            ]
            yield batch.append_column("sha256", pa.array(digests, pa.string()))

    level = spread.mapInArrow(leaves, "path string, length long, block long, sha256 string")
    below = F.transform(
        F.sort_array(F.collect_list(F.struct("block", "sha256"))), lambda x: x["sha256"]
    )
    while longest > 1:
        longest = -(-longest // fan)
        nodes = level.groupBy(
            "path", "length", F.floor(F.col("block") / fan).alias("block")
        ).agg(below.alias("parts"))
        whole = F.sha2(F.concat(F.lit("node:"), F.concat_ws(",", "parts")), 256)
        level = nodes.select(
            "path", "length", "block",
            F.when(F.size("parts") == 1, F.col("parts")[0]).otherwise(whole).alias("sha256"),
        )
    return level.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.sha2(F.concat_ws(":", F.lit("file"), F.col("length").cast("string"), "sha256"), 256).alias("sha256"),
    )


def _block_digest(path: str, start: int, length: int) -> str:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        system, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        system, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    found, left = hashlib.sha256(b"leaf:"), length
    with system.open_input_file(name) as source:
        source.seek(start)
        while left:
            piece = source.read(min(left, PIECE_BYTES))
            if not piece:
                raise OSError(f"{path} ends {left} bytes before {start + length}")
            found.update(piece)
            left -= len(piece)
    return found.hexdigest()


def recorded_sources(spark: SparkSession, path: str) -> dict[str, str]:
    """What a training run notes about its source files: name -> tree digest."""
    found = file_tree_digests(spark, path).select("file_name", "sha256").collect()
    names = dict(tuple(r) for r in found)
    if len(names) < len(found):
        raise ValueError(f"{len(found)} source files below {path} share {len(names)} names")
    return names


def file_stamps(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, stamp`` from name, size and modification time; contents are not read."""
    name = F.element_at(F.split("path", "/"), -1)
    text = F.concat_ws(
        ":", name, F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")
    )
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(name.alias("file_name"), F.substring(F.sha2(text, 256), 1, 16).alias("stamp"))
    )


def count_rows(df: DataFrame) -> int:
    """Records, not lines: a quoted line break does not count."""
    return df.count()


def narrow_types(df: DataFrame, floats: bool = False) -> DataFrame:
    """Cast integers to the narrowest type that holds them; doubles only when asked."""
    whole = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.LongType, T.IntegerType))
    ]
    sizes = [(T.ByteType(), 2**7), (T.ShortType(), 2**15), (T.IntegerType(), 2**31)]
    target: dict[str, T.DataType] = {}
    if whole:
        bounds = df.agg(
            *[F.min(quoted(c)).alias(f"low{i}") for i, c in enumerate(whole)],
            *[F.max(quoted(c)).alias(f"high{i}") for i, c in enumerate(whole)],
        ).first()
        for i, column in enumerate(whole):
            low, high = bounds[f"low{i}"], bounds[f"high{i}"]
            if low is None:
                continue
            for data_type, limit in sizes:
                if -limit <= low and high < limit:
                    target[column] = data_type
                    break
    if floats:
        for field in df.schema.fields:
            if isinstance(field.dataType, T.DoubleType):
                target[field.name] = T.FloatType()
    return df.select(
        *[
            quoted(c).cast(target[c]).alias(c) if c in target else quoted(c)
            for c in df.columns
        ]
    )
