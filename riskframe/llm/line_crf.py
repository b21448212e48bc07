"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's features are shares of character classes, word
statistics and repetition, and the same features of the line before and after it; the chain adds
weights for each pair of neighbouring labels. Forward-backward gives every line's probability of
being good, and a document's score is the mean of these weighted by line length.

Fitting: labels exist per document, so all lines of a labelled document carry its label. The fit
uses at most ``FitLimits.documents`` labelled documents, those with the smallest hash of their
id among the documents that may be learned from, and of these the ones with at most
``FitLimits.lines`` lines. Line features are computed by the executors; only they come to the
driver. Scoring covers every line of every text.

Defined cases: a missing text is an empty one; an empty text is one empty line and gets a score;
a missing id is never learned from and is not held out; several labels of one id count as the
largest; without any label to learn from every score is 0.5; further columns are carried by
``scored`` and never read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import content, packed

THRESHOLD = 0.7
BATCH_ROWS = 128
_CLASSES = {
    1: bytes(range(65, 91)),
    2: bytes(range(48, 58)),
    3: b"#*$%&<>~^_=@\\",
    4: b"|",
    5: b"!?",
    6: b".,;:'\"()-/",
    7: b" \t\r\x0b\x0c",
    8: bytes(range(128, 256)),
}
_TABLE = np.zeros(256, np.uint8)
for _number, _members in _CLASSES.items():
    _TABLE[list(_members)] = _number
_KINDS = 9
FEATURES = _KINDS + 7


@dataclass(frozen=True)
class FitLimits:
    documents: int = 4000
    lines: int = 400


@dataclass(frozen=True)
class Field:
    """Weights of the field: per feature for the label good, and per pair of labels."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray


def line_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features per line, lines per document, bytes per line."""
    data = "\n".join(texts).encode("utf-8", "replace")
    lines = data.split(b"\n")
    per_document = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    own = np.frombuffer(data, np.uint8)
    own = own[own != 10]
    place = np.repeat(np.arange(len(lines)), sizes)
    counts = np.bincount(place * _KINDS + _TABLE[own], minlength=len(lines) * _KINDS)
    found = np.zeros((len(lines), FEATURES))
    found[:, :_KINDS] = counts.reshape(-1, _KINDS) / np.maximum(sizes, 1)[:, None]
    words = np.zeros((len(lines), 3))
    again = np.zeros(len(lines))
    at = 0
    for count in per_document:
        seen = set()
        for i in range(at, at + count):
            each = lines[i].split()
            if each:
                words[i] = len(each), len(set(each)), sum(map(eq, each, each[1:]))
                if lines[i] in seen:
                    again[i] = 1
                seen.add(lines[i])
        at += count
    n = np.maximum(words[:, 0], 1)
    found[:, _KINDS] = np.log1p(sizes) / 5
    found[:, _KINDS + 1] = 1 - words[:, 1] / n
    found[:, _KINDS + 2] = words[:, 2] / n
    found[:, _KINDS + 3] = again
    found[:, _KINDS + 4] = np.minimum(sizes / n, 40) / 10
    found[:, _KINDS + 5] = words[:, 0] < 4
    found[:, _KINDS + 6] = words[:, 0] == 0
    return found, per_document, sizes


def with_neighbours(own: np.ndarray, per_document: np.ndarray) -> np.ndarray:
    """A line's features with those of the lines before and after it, zeros at the ends."""
    ends = np.cumsum(per_document)
    first = np.zeros(len(own), bool)
    last = np.zeros(len(own), bool)
    first[ends - per_document] = True
    last[ends - 1] = True
    before = np.roll(own, 1, axis=0)
    after = np.roll(own, -1, axis=0)
    before[first] = 0
    after[last] = 0
    return np.hstack([own, before, after, first[:, None], last[:, None], np.ones((len(own), 1))])


def _chains(per_document: np.ndarray):
    """Documents by falling length, and for every step the rows of lines still running."""
    order = np.argsort(-per_document, kind="stable")
    starts = (np.cumsum(per_document) - per_document)[order]
    lengths = per_document[order]
    running = np.searchsorted(-lengths, -np.arange(1, lengths.max(initial=0) + 1), side="right")
    return starts, lengths, running


def _normal(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1)
    return top + np.log(np.exp(x - top[..., None]).sum(axis=-1))


def forward_backward(
    good: np.ndarray, pairs: np.ndarray, per_document: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line P(good); summed pair probabilities per document; log normaliser per document.

    ``good`` is a line's score for label 1; label 0 scores 0. Documents run side by side, one
    step along the chain at a time.
    """
    starts, lengths, running = _chains(per_document)
    score = np.stack([np.zeros_like(good), good], axis=1)
    ahead = np.zeros((len(good), 2))
    back = np.zeros((len(good), 2))
    if len(running):
        ahead[starts] = score[starts]
    for step, count in enumerate(running[1:], 1):
        at = starts[:count] + step
        ahead[at] = score[at] + _normal(ahead[at - 1][:, None, :] + pairs.T[None])
    for step in range(len(running) - 1, 0, -1):
        at = starts[: running[step]] + step
        back[at - 1] = _normal((score[at] + back[at])[:, None, :] + pairs[None])
    total = np.empty(len(per_document))
    order = np.argsort(-per_document, kind="stable")
    total[order] = _normal(ahead[starts + lengths - 1])
    line_total = np.repeat(total, per_document)
    marginal = np.exp((ahead + back)[:, 1] - line_total)
    inner = np.ones(len(good), bool)
    inner[np.cumsum(per_document) - per_document] = False
    at = np.flatnonzero(inner)
    joint = np.exp(
        ahead[at - 1][:, :, None]
        + pairs[None]
        + (score[at] + back[at])[:, None, :]
        - line_total[at][:, None, None]
    )
    moved = np.zeros((len(per_document), 2, 2))
    np.add.at(moved, np.repeat(np.arange(len(per_document)), per_document)[at], joint)
    return np.clip(marginal, 0, 1), moved, total


def fit_field(
    own: np.ndarray,
    per_document: np.ndarray,
    labels: np.ndarray,
    rounds: int = 150,
    rate: float = 0.1,
    penalty: float = 1e-3,
) -> Field:
    """Penalised mean log-likelihood per line of a document, by Adam over all documents."""
    mean, scale = own.mean(axis=0), own.std(axis=0) + 1e-3
    x = with_neighbours((own - mean) / scale, per_document)
    y = np.repeat(labels, per_document).astype(float)
    share = np.repeat(1 / per_document, per_document) / len(per_document)
    steps = np.maximum(per_document - 1, 0)
    kept = np.zeros((len(labels), 2, 2))
    kept[np.arange(len(labels)), labels, labels] = steps
    weights, pairs = np.zeros(x.shape[1]), np.zeros((2, 2))
    flat = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for turn in range(1, rounds + 1):
        weights, pairs = flat[:-4], flat[-4:].reshape(2, 2)
        marginal, moved, _ = forward_backward(x @ weights, pairs, per_document)
        slope = np.concatenate(
            [
                x.T @ ((y - marginal) * share),
                np.einsum("dij,d->ij", kept - moved, 1 / per_document / len(labels)).ravel(),
            ]
        )
        # Labels are constant in a document, so pair weights would grow without end.
        slope -= np.concatenate([penalty * weights, 20 * penalty * pairs.ravel()])
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        flat = flat + rate * (first / (1 - 0.9**turn)) / (
            np.sqrt(second / (1 - 0.99**turn)) + 1e-8
        )
    return Field(mean, scale, flat[:-4], flat[-4:].reshape(2, 2))


def document_scores(field: Field | None, texts: Sequence[str]) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good."""
    if field is None:
        return np.full(len(texts), 0.5)
    own, per_document, sizes = line_features(texts)
    x = with_neighbours((own - field.mean) / field.scale, per_document)
    marginal, _, _ = forward_backward(x @ field.weights, field.pairs, per_document)
    weight = sizes + 1.0
    starts = np.cumsum(per_document) - per_document
    return np.add.reduceat(marginal * weight, starts) / np.add.reduceat(weight, starts)


def remainder(key: Column, modulus: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % modulus


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    held_out: tuple[int, int] = (4, 2),
    limits: FitLimits = FitLimits(),
) -> Field | None:
    """Fit on labelled documents whose crc32(id) has another remainder than the held-out one."""
    modulus, left_out = held_out
    usable = (
        labels.where(F.col(label).isNotNull() & (remainder(F.col(key), modulus) != left_out))
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(limits.documents)
    )
    rows = packed(docs).select(F.col(f"row.`{key}`").alias("id"), content(text).alias("content"))
    chosen = rows.where(F.length("content") > 0).join(F.broadcast(usable), "id")
    # One row of every id, so that the limit on ids bounds what the driver receives.
    chosen = (
        chosen.where(F.size(F.split("content", "\n")) <= limits.lines)
        .groupBy("id")
        .agg(
            F.max("label").alias("label"),
            F.min(F.struct(F.xxhash64("content").alias("hash"), "content")).alias("least"),
        )
        .select("label", F.col("least.content").alias("content"))
    )

    def features(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = batch.column("content").to_pylist()
            for text_, label_ in zip(texts, batch.column("label").to_pylist()):
                own, per_document, _ = line_features([text_])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(label_ > 0)], pa.int32()),
                        pa.array(per_document),
                        pa.array([own.astype(np.float32).tobytes()], pa.binary()),
                    ],
                    names=["label", "lines", "features"],
                )

    found = chosen.mapInArrow(features, "label int, lines long, features binary").toPandas()
    if found["label"].nunique() < 2:
        return None
    # Rows arrive in no order; the sums of the fit should not depend on it.
    found = found.sort_values(["lines", "features"], kind="stable")
    own = np.frombuffer(b"".join(found["features"]), np.float32).reshape(-1, FEATURES)
    return fit_field(
        own.astype(float), found["lines"].to_numpy(), found["label"].to_numpy().astype(int)
    )


def scored(
    docs: DataFrame, field: Field | None, text: str = "text", columns: Sequence[str] | None = None
) -> DataFrame:
    """``row`` with the given columns (all by default) and ``score``."""
    names = list(docs.columns if columns is None else columns)
    rows = packed(docs).select(
        F.struct(*[F.col(f"row.`{c}`").alias(c) for c in names]).alias("row"),
        content(text).alias("content"),
    )

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                scores = document_scores(field, part.column("content").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(scores, pa.float64())], names=["row", "score"]
                )

    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(batches, schema)


def judge(
    docs: DataFrame, field: Field | None, key: str = "doc_id", held_out: tuple[int, int] = (4, 2)
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    modulus, left_out = held_out
    found = scored(docs, field, columns=[key]).select(F.col(f"row.`{key}`").alias("id"), "score")
    return found.select(
        F.col("id").alias("doc_id"),
        F.coalesce(remainder(F.col("id"), modulus) == left_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, field: Field | None) -> DataFrame:
    """The rows that the classifier accepts, with their own columns."""
    return (
        scored(docs, field)
        .where(F.col("score") >= THRESHOLD)
        .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    )
