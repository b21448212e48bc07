"""Chunks of texts that exchange packed fingerprints through buckets.

Some operators must know, for every n-gram of every text, whether it occurs elsewhere. A shuffled
row per n-gram would outweigh the texts many times, so texts are dealt into chunks. A chunk sends
one row per bucket with the fingerprints that fall there, each distinct one once: however
frequent an n-gram is, a bucket hears of it at most once per chunk. The bucket answers each
chunk, and the chunk finds the occurrences in its own texts again.

Chunks are checkpointed in the partitioning of their number; later groupings by chunk read them
where they are and shuffle the answers alone. Texts are kept compressed until their turn.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskframe.llm.common import cut

#: Chunks for every shuffle partition, and buckets for every one. Letters are chunks times
#: buckets, so both are few: a letter should hold many fingerprints.
CHUNKS = 2
BUCKETS = 1
#: What a bucket tells a chunk.
ANSWERS = "chunk long, kind int, bucket long, payload binary"
#: What a chunk tells a bucket.
LETTERS = "bucket long, chunk long, payload binary"
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def chunk_count(spark: SparkSession) -> int:
    return CHUNKS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(spark: SparkSession) -> int:
    return BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut_by(df: DataFrame, column: str) -> DataFrame:
    """Checkpoint in the partitioning of a column, which an adaptive plan would forget."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    setting = "spark.sql.adaptive.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return cut(df.repartition(parts, column))
    finally:
        spark.conf.set(setting, before)


def powers(base: np.uint64, count: int) -> np.ndarray:
    found = np.full(count, base, np.uint64)
    found[:1] = 1
    return np.multiply.accumulate(found)


class Prefixes:
    """Prefix polynomial of a sequence of word hashes, modulo 2^64."""

    def __init__(self, hashes: np.ndarray):
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.add.accumulate(hashes * powers(BASE, len(hashes)), out=self.sums[1:])
        self.back = powers(INVERSE, len(hashes))

    def windows(self, size: int) -> np.ndarray:
        """Fingerprint of every window of ``size`` words, mixed so that all bits depend on all."""
        total = len(self.sums) - size
        if total < 1:
            return np.zeros(0, np.uint64)
        found = (self.sums[size:] - self.sums[:total]) * self.back[:total]
        return mixed(found + np.uint64(size))

    def at(self, size: int, starts: np.ndarray) -> np.ndarray:
        """The same for some starts only."""
        found = (self.sums[starts + size] - self.sums[starts]) * self.back[starts]
        return mixed(found + np.uint64(size))


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def bucket_of(prints: np.ndarray, buckets: int) -> np.ndarray:
    return ((prints >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def halves(prints: np.ndarray, buckets: int) -> np.ndarray:
    """What of a fingerprint its bucket sees, the bucket's number above 32 bits."""
    low = prints & np.uint64(0xFFFFFFFF)
    return (bucket_of(prints, buckets).astype(np.uint64) << np.uint64(32)) | low


def parts_of(sorted_halves: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of one bucket in sorted halves."""
    numbers = (sorted_halves >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(numbers, prepend=-1, append=-1))
    for start, stop in zip(edges[:-1], edges[1:]):
        yield int(numbers[start]), slice(int(start), int(stop))


def answered(rows: pa.Table, kind: int) -> np.ndarray:
    """All halves that buckets named to a chunk under ``kind``, sorted."""
    found = []
    for k, bucket, payload in zip(*(rows.column(c).to_pylist() for c in ("kind", "bucket", "payload"))):
        if k == kind:
            low = np.frombuffer(payload, "<u4").astype(np.uint64)
            found.append((np.uint64(bucket) << np.uint64(32)) | low)
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def among(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    place = np.searchsorted(sorted_values, values)
    return sorted_values[np.minimum(place, len(sorted_values) - 1)] == values


def table(columns: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


LETTER_ARROW = pa.schema(
    [("bucket", pa.int64()), ("chunk", pa.int64()), ("payload", pa.binary())]
)
ANSWER_ARROW = pa.schema(
    [("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("payload", pa.binary())]
)


def letters(chunk: int, found: Iterable[tuple[int, bytes]]) -> pa.Table:
    rows = list(found)
    return table(
        {
            "bucket": [bucket for bucket, _ in rows],
            "chunk": [chunk] * len(rows),
            "payload": [payload for _, payload in rows],
        },
        LETTER_ARROW,
    )


def answers(bucket: int, kind: int, found: Iterable[tuple[int, bytes]]) -> pa.Table:
    rows = list(found)
    return table(
        {
            "chunk": [chunk for chunk, _ in rows],
            "kind": [kind] * len(rows),
            "bucket": [bucket] * len(rows),
            "payload": [payload for _, payload in rows],
        },
        ANSWER_ARROW,
    )


def squeezed(text: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(text)


def spread(body: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(body)
