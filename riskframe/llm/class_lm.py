"""Class-based bigram language model (Brown) and the perplexity it gives to texts.

P(text) is the product over tokens of P(class | history) * P(token | class). Every word of the
training vocabulary gets its class by exchange clustering, in two steps:

1. The ``seeds`` most frequent words are moved, one at a time, to the class that raises the likelihood
   of the corpus' class bigrams most, until none gains by moving. Rounds run in parallel against
   the same class counts as long as that helps, then one word at a time. The classes of the seeds,
   and a shape for any other word, are the histories.
2. All other words are exchanged by how often they follow each history. Those counts are a Spark
   table with a row per word, so the step grows with the vocabulary and no task or driver holds
   it. Words enter the class that suits them best against the seeds; then half of them, by a hash
   of the word, move at a time, each against the same counts, so that a class is a function of the
   table and not of its layout. A pass that does not raise the likelihood is dropped and ends it.

Classes and counts are joined on the word when texts are scored, so no word is dropped and nothing
that grows with the corpus is broadcast; words of the head - those above the count that at most
``head`` words reach - travel with the tasks instead.

Tokens: words with A-Z in lower case, then one end. Counts have one added: the unigram base over
all words and one unseen word, a class over its own words and one unseen word. A word that training
has not seen may come from any class as its unseen word, so its probability is a sum over classes.

Defined cases: a missing text is empty and has the end as its only token; a missing id is not
held out, so its text is learned from; rows that agree in id and text are scored once and
returned as often as they occur; without training documents every count is 0; further columns
play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.class_exchange import exchange_vocabulary, history_counts, written, x_log_x as _x_log_x
from riskframe.llm.common import content, cut, packed
from riskframe.llm.line_crf import remainder

END = b"\n"  # no word holds a line feed
SHAPES = 6
CLASSES = 32
SEEDS = 1000
HEAD = 150_000
PASSES = 2
SMOOTHING = 0.1
BLOCKS = 8
FLUSH = 200_000
BATCH_CHARS = 2_000_000
_MARKS = b".,;:!?"
_DIGIT = re.compile(rb"[0-9]").search


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()


def shape(word: bytes) -> int:
    """What a word that is no seed is as a history, below ``SHAPES``."""
    if _DIGIT(word):
        return 0
    if word[-1] in _MARKS:
        return 1
    return 2 + (len(word) > 4) + (len(word) > 7) + (len(word) > 10)


@dataclass(frozen=True)
class Head:
    """Frequent words by falling count; the end comes first, then ``clustered`` words."""

    index: dict[bytes, int]
    counts: np.ndarray
    clustered: int

    def units(self) -> np.ndarray:
        """Unit of every head word: its own if clustered, else that of its shape."""
        own = np.arange(len(self.counts))
        rest = [self.clustered + shape(w) for w in list(self.index)[self.clustered :]]
        own[self.clustered :] = rest
        return own


@dataclass(frozen=True)
class ClassModel:
    """``histories`` by unit, ``head_class`` by place; rows of the tables are histories."""

    head: Head
    histories: np.ndarray
    head_class: np.ndarray
    log_pairs: np.ndarray
    log_totals: np.ndarray
    log_unseen: np.ndarray
    tokens: int
    words: int


def _texts(docs: DataFrame, text: str, key: str) -> DataFrame:
    return packed(docs).select(
        F.col(f"row.`{key}`").alias("id"), content(text).alias("content")
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, shape, n`` over all texts, the end included (with shape -1)."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = list(seen)
            shapes = [-1 if w == END else shape(w) for w in words]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([w.decode() for w in words], pa.string()),
                    pa.array(shapes, pa.int32()),
                    pa.array(list(seen.values()), pa.int64()),
                ],
                names=["word", "shape", "n"],
            )
            seen.clear()
            return batch

        for batch in stream:
            column = batch.column("content")
            for i in range(batch.num_rows):
                seen.update(tokens(column[i].as_py()))
                seen[END] += 1
                if len(seen) >= FLUSH:
                    yield flush()
        if seen:
            yield flush()

    return (
        texts.select("content")
        .mapInArrow(batches, "word string, shape int, n long")
        .groupBy("word", "shape")
        .agg(F.sum("n").alias("n"))
    )


def frequent(counts: DataFrame, clustered: int, most: int) -> Head:
    """At most ``most`` words and the end: all whose count reaches the lowest level that fits."""
    # Sixteen levels per doubling; the number of levels does not depend on the data.
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, lowest = 0, None
    for row in levels:
        total += row["count"]
        if total > most:
            break
        lowest = row["level"]
    found = [] if lowest is None else counts.where(level >= lowest).select("word", "n").collect()
    by_count = sorted(((r["word"].encode(), r["n"]) for r in found), key=lambda x: (-x[1], x[0]))
    ends = counts.where(F.col("shape") == -1).select("n").first()
    words = [(END, ends["n"] if ends else 0)] + [x for x in by_count if x[0] != END]
    return Head(
        {w: i for i, (w, _) in enumerate(words)},
        np.array([n for _, n in words], np.int64),
        min(clustered, len(words)),
    )


class _Places(dict):
    """Places of head words; any other word is found at -1 - its shape."""

    def __missing__(self, word: bytes) -> int:
        return -1 - shape(word)


class _Reader:
    """Maps texts to units; head words by table, others by shape."""

    def __init__(self, head: Head) -> None:
        self.find = _Places(head.index).__getitem__
        # Units by place; shapes are read from the end.
        self.units = np.concatenate([head.units(), head.clustered + np.arange(SHAPES)[::-1]])

    def units_of(self, text: str) -> np.ndarray:
        words = tokens(text)
        words.append(END)
        return self.units[np.fromiter(map(self.find, words), np.int64, len(words))]

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Head places (below 0 for others), units, and the words that are not in the head."""
        words = tokens(text)
        words.append(END)
        places = np.fromiter(map(self.find, words), np.int64, len(words))
        others = [words[i] for i in np.flatnonzero(places < 0).tolist()]
        return places, self.units[places], others


def unit_bigrams(texts: DataFrame, head: Head) -> DataFrame:
    """``left, right, n``: neighbouring units over all texts, each text between two ends."""
    width = head.clustered + SHAPES

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(head)
        dense = np.zeros(width * width, np.int64)
        open_, chars = [], 0

        def settle() -> None:
            np.add.at(dense, np.concatenate(open_), 1)

        for batch in stream:
            column = batch.column("content")
            for i in range(batch.num_rows):
                text = column[i].as_py()
                units = reader.units_of(text)
                open_.append(np.concatenate([[0], units[:-1]]) * width + units)
                chars += len(text)
                if chars >= BATCH_CHARS:
                    settle()
                    open_, chars = [], 0
        if open_:
            settle()
        seen = np.flatnonzero(dense)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(dense[seen], pa.int64())], names=["pair", "n"]
        )

    return (
        texts.select("content")
        .mapInArrow(batches, "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .select(
            F.floor(F.col("pair") / width).cast("int").alias("left"),
            (F.col("pair") % width).cast("int").alias("right"),
            "n",
        )
    )


def likelihood(pairs: np.ndarray) -> float:
    """Class-bigram part of the corpus log-likelihood."""
    return float(
        _x_log_x(pairs).sum() - _x_log_x(pairs.sum(axis=0)).sum() - _x_log_x(pairs.sum(axis=1)).sum()
    )


def best_class(
    pairs: np.ndarray, classes: int, own: int, after: np.ndarray, before: np.ndarray, itself: float
) -> tuple[int, np.ndarray]:
    """The class that suits a word best, and the class bigrams once it is there.

    ``after`` and ``before`` count the word's neighbours by class, itself left out.
    """
    pairs = pairs.copy()
    pairs[own] -= after
    pairs[:, own] -= before
    pairs[own, own] -= itself
    rows, columns = pairs[:classes], pairs[:, :classes].T
    out, into = pairs.sum(axis=1)[:classes], pairs.sum(axis=0)[:classes]
    diagonal = np.arange(classes)
    gain_rows = _x_log_x(rows + after) - _x_log_x(rows)
    gain_columns = _x_log_x(columns + before) - _x_log_x(columns)
    gain_rows[diagonal, diagonal] = 0
    gain_columns[diagonal, diagonal] = 0
    middle = pairs[diagonal, diagonal]
    both = after[:classes] + before[:classes] + itself
    gain = (
        gain_rows.sum(axis=1)
        + gain_columns.sum(axis=1)
        + _x_log_x(middle + both)
        - _x_log_x(middle)
        - _x_log_x(out + after.sum() + itself)
        + _x_log_x(out)
        - _x_log_x(into + before.sum() + itself)
        + _x_log_x(into)
    )
    chosen = int(np.argmax(gain))
    if gain[chosen] <= gain[own] + 1e-9 * abs(gain[own]):
        chosen = own
    pairs[chosen] += after
    pairs[:, chosen] += before
    pairs[chosen, chosen] += itself
    return chosen, pairs


def settle(
    bigrams: pd.DataFrame,
    clustered: int,
    state: np.ndarray,
    pairs: np.ndarray,
    classes: int,
    rounds: int | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Moves one word at a time until none gains, or for ``rounds`` rounds over all words."""
    state, sides, units = state.copy(), [], np.arange(clustered + 1)
    for own, other in (("left", "right"), ("right", "left")):
        ordered = bigrams.sort_values([own, other])
        starts = np.searchsorted(ordered[own].to_numpy(), units)
        sides.append((ordered[other].to_numpy(), ordered["n"].to_numpy(float), starts))
    done, moving = 0, True
    while moving and (rounds is None or done < rounds):
        moving, done = False, done + 1
        for unit in range(clustered):
            contexts, itself = [], 0.0
            for others, n, starts in sides:
                near, times = (x[starts[unit] : starts[unit + 1]] for x in (others, n))
                itself = float(times[near == unit].sum())
                times = np.where(near == unit, 0, times)
                contexts.append(np.bincount(state[near], times, len(pairs)))
            own = int(state[unit])
            chosen, pairs = best_class(pairs, classes, own, *contexts, itself)
            if chosen != own:
                state[unit], moving = chosen, True
    return state, pairs


def exchange(
    bigrams: DataFrame, clustered: int, classes: int = CLASSES, rounds: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Class of every unit, and the class bigram counts; without ``rounds`` until no word gains."""
    every = classes + SHAPES
    state = np.concatenate(
        [np.arange(clustered) % classes, classes + np.arange(SHAPES)]
    ).astype(int)

    def of(column: str, assigned: np.ndarray):
        return F.get(F.array(*[F.lit(int(c)) for c in assigned]), F.col(column))

    def class_pairs(assigned: np.ndarray) -> np.ndarray:
        rows = bigrams.groupBy(
            of("left", assigned).alias("a"), of("right", assigned).alias("b")
        ).agg(F.sum("n").alias("n"))
        found = np.zeros((every, every))
        for row in rows.collect():
            found[row["a"], row["b"]] = row["n"]
        return found

    pairs = class_pairs(state)
    done = 0
    while rounds is None or done < rounds:
        before, assigned = pairs, state
        contexts = (
            bigrams.where(F.col("left") < clustered)
            .select(
                F.col("left").alias("unit"), F.lit(0).alias("side"),
                of("right", state).alias("class"),
                F.when(F.col("left") == F.col("right"), F.col("n")).otherwise(0).alias("itself"),
                "n",
            )
            .unionByName(
                bigrams.where(F.col("right") < clustered).select(
                    F.col("right").alias("unit"), F.lit(1).alias("side"),
                    of("left", state).alias("class"),
                    F.when(F.col("left") == F.col("right"), F.col("n"))
                    .otherwise(0).alias("itself"),
                    "n",
                )
            )
            .groupBy("unit", "side", "class")
            .agg(F.sum("n").alias("n"), F.sum("itself").alias("itself"))
        )

        def moves(block: pd.DataFrame) -> pd.DataFrame:
            own_pairs, found = before, []
            for unit, part in block.sort_values(["unit", "side", "class"]).groupby("unit"):
                sides = np.zeros((2, every))
                sides[part["side"], part["class"]] = part["n"] - part["itself"]
                itself = float(part.loc[part["side"] == 0, "itself"].sum())
                own = int(assigned[unit])
                chosen, own_pairs = best_class(
                    own_pairs, classes, own, sides[0], sides[1], itself
                )
                if chosen != own:
                    found.append((unit, chosen))
            return pd.DataFrame(found, columns=["unit", "class"]).astype("int32")

        changed = (
            contexts.withColumn("block", F.col("unit") % BLOCKS)
            .groupBy("block")
            .applyInPandas(moves, "unit int, class int")
            .collect()
        )
        after = state.copy()
        for row in changed:
            after[row["unit"]] = row["class"]
        moved = class_pairs(after)
        if not changed:
            break
        if likelihood(moved) <= likelihood(pairs):
            left = None if rounds is None else rounds - done
            return settle(bigrams.toPandas(), clustered, state, pairs, classes, left)
        state, pairs, done = after, moved, done + 1
    return state, pairs


def train(
    texts: DataFrame,
    classes: int = CLASSES,
    seeds: int = SEEDS,
    head: int = HEAD,
    rounds: int | None = None,
    passes: int = PASSES,
) -> tuple[ClassModel, DataFrame]:
    """The model, and ``word, n, class`` of all words of the given texts but the seeds."""
    counts = cut(word_counts(texts))
    total, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    frequent_words = frequent(counts, seeds, head)
    first = frequent_words.clustered
    bigrams = cut(unit_bigrams(texts, frequent_words))
    histories, pairs = exchange(bigrams, first, classes, rounds)

    def reader():
        found = _Reader(frequent_words)

        def read(text: str):
            places, units, others = found.read(text)
            return places, histories[np.concatenate([[0], units[:-1]])], others

        return read

    contexts = written(
        history_counts(texts, reader, list(frequent_words.index), first, classes + SHAPES),
        "contexts",
    )
    table, cells = exchange_vocabulary(contexts, pairs[:, :classes], passes)
    kinds, sizes = np.zeros(classes), np.zeros(classes)
    for row in table.groupBy("class").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).collect():
        kinds[row["class"]] += row["k"]
        sizes[row["class"]] += row["n"]
    head_class = np.zeros(len(frequent_words.counts), np.int64)
    head_class[:first] = histories[:first]
    for place in range(first):
        kinds[histories[place]] += frequent_words.counts[place] > 0
        sizes[histories[place]] += frequent_words.counts[place]
    # At most ``head`` rows.
    for row in table.where("place >= 0").select("place", "class").collect():
        head_class[row["place"]] = row["class"]
    share = (cells + SMOOTHING) / (cells.sum(axis=1, keepdims=True) + SMOOTHING * classes)
    each = sizes + kinds + 1
    model = ClassModel(
        frequent_words, histories, head_class,
        np.log10(share), np.log10(each), np.log10((share / each).sum(axis=1)),
        int(total), int(words),
    )
    return model, table.where("place < 0").select("word", "n", "class")


def score(texts: DataFrame, model: ClassModel, others: DataFrame) -> DataFrame:
    """``id, content`` -> ``id, n_tokens, n_known, base_score, score``.

    ``others`` has ``word, n, class`` of the words outside the head.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model.head)
        log_count = np.log10(model.head.counts + 1.0)
        for batch in stream:
            words, before, times, sizes = [], [], [], []
            sums = ([], [], [], [])
            column, marks = batch.column("content"), batch.column("mark").to_pylist()
            for i in range(batch.num_rows):
                places, units, tail = reader.read(column[i].as_py())
                history = model.histories[np.concatenate([[0], units[:-1]])]
                known = places >= 0
                inside = places[known]
                own = model.head_class[inside]
                part = (
                    len(places),
                    int((model.head.counts[inside] > 0).sum()),
                    float(log_count[inside].sum()),
                    float((model.log_pairs[history[known], own] - model.log_totals[own]).sum()),
                )
                found = Counter(zip(tail, history[~known].tolist()))
                # The document's own row: its key matches no word, and spreads.
                sizes.append(1 + len(found))
                words.append(f" {marks[i]}")
                words += [w.decode() for w, _ in found]
                before.append(0)
                before += [h for _, h in found]
                times.append(0)
                times += found.values()
                for total, value in zip(sums, part):
                    total.append(value)
            if not sizes:
                continue
            at = np.repeat(np.arange(len(sizes)), sizes)
            whole = np.zeros(len(at), bool)
            whole[np.cumsum([0, *sizes[:-1]])] = True
            kinds = (("tokens", pa.int64()), ("known", pa.int64()),
                     ("counted", pa.float64()), ("classes", pa.float64()))
            parts = pa.StructArray.from_arrays(
                [pa.array(total, kind) for total, (_, kind) in zip(sums, kinds)],
                names=[name for name, _ in kinds],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(at)),
                    batch.column("mark").take(pa.array(at)),
                    pa.array(words, pa.string()),
                    pa.array(before, pa.int32()),
                    pa.array(times, pa.int64()),
                    parts.take(pa.array(at, pa.int64(), mask=~whole)),
                ],
                names=["id", "mark", "word", "history", "times", "part"],
            )

    keyed = texts.select("id", F.xxhash64("content").alias("mark"), "content")
    kind = keyed.schema["id"].dataType.simpleString()
    rows = keyed.mapInArrow(
        batches,
        f"id {kind}, mark long, word string, history int, times long, "
        "part struct<tokens:long,known:long,counted:double,classes:double>",
    )
    # One row per history and class, (classes + SHAPES) * (classes + 1) of them.
    chance = np.column_stack([model.log_unseen, model.log_pairs - model.log_totals])
    table = texts.sparkSession.createDataFrame(
        [(h, c - 1, float(v)) for h, row in enumerate(chance) for c, v in enumerate(row)],
        "history int, class int, chance double",
    )
    n = F.coalesce("n", F.lit(0))
    joined = rows.join(others, "word", "left").withColumn(
        "class", F.coalesce("class", F.lit(-1))
    ).join(F.broadcast(table), ["history", "class"])
    summed = joined.groupBy("id", "mark").agg(
        F.count("part").alias("copies"),
        F.sum("part.tokens").alias("tokens"),
        F.sum("part.known").alias("known"),
        F.sum("part.counted").alias("counted"),
        F.sum("part.classes").alias("classes"),
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10(n + 1)).alias("tail_counted"),
        F.sum(F.col("times") * F.col("chance")).alias("tail_classes"),
    )
    # Equal rows have added up and are as many again.
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))

    def whole(value):
        return F.round(value / F.col("copies")).cast("long")

    counted = (F.col("counted") + F.col("tail_counted")) / F.col("copies")
    n_tokens = whole(F.col("tokens"))
    share = float(np.log10(model.tokens + model.words + 1))
    return each.select(
        "id",
        n_tokens.alias("n_tokens"),
        whole(F.col("known") + F.col("tail_known")).alias("n_known"),
        (counted - n_tokens * share).alias("base_score"),
        (counted + (F.col("classes") + F.col("tail_classes")) / F.col("copies")).alias("score"),
    )


def report(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    held_out: tuple[int, int] = (7, 2),
    **options,
) -> DataFrame:
    """Scores of all documents by a model of those that are not held out."""
    modulus, left_out = held_out
    texts = _texts(docs, text, key)
    out = F.coalesce(remainder(F.col("id"), modulus) == left_out, F.lit(False))
    model, others = train(texts.where(~out), **options)
    return score(texts, model, others).select(
        F.col("id").alias("doc_id"),
        out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
