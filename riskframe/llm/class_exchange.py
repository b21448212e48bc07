"""Exchange clustering of a whole vocabulary against fixed histories.

A table has a row per word with how often the word follows each history. The likelihood of the
class bigrams is sum(x log x) over cells (history, class) less the same over classes; a word
moves to the class where it raises that most. All words of a pass move against the same counts,
half of the vocabulary at a time, so that a class is a function of the table and not of its layout.
Tasks hold one batch and the counts of the cells, whose number is bounded by the classes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import fresh_folder

FLUSH = 200_000
MOST_ENTRIES = 20_000
# A 32-bit cell is emptied long before it is full.
FULL = 1 << 30


def x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def cell_likelihood(cells: np.ndarray) -> float:
    """Likelihood of ``cells`` (history x class) up to a constant that classes do not change."""
    return float(x_log_x(cells).sum() - x_log_x(cells.sum(axis=0)).sum())


def written(df: DataFrame, kind: str) -> DataFrame:
    """The table, written to the shared folder and read again."""
    place = fresh_folder(df.sparkSession, kind)
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def history_counts(
    texts: DataFrame, read: Callable[[], Callable], names: Sequence[bytes], first: int, width: int
) -> DataFrame:
    """``word, place, n, near`` of every word from place ``first`` on and of every unplaced word.

    ``read`` gives a task its reader: text -> places (below 0: none), the history before each token, and
    the unplaced words in order. ``near`` holds at most one entry for each of ``width`` histories.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = read()
        words = pa.array([w.decode() for w in names], pa.string())
        dense = np.zeros(len(names) * width, np.int32)
        tail: Counter = Counter()
        open_, size = [], 0

        def rows(own, places, after, times) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
            arrays = [
                x if isinstance(x, pa.Array) else pa.array(x, k)
                for x, k in zip((own, places, after, times), kinds)
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "place", "history", "n"])

        def unplaced() -> pa.RecordBatch:
            keys = list(tail)
            batch = rows(
                [w.decode() for w, _ in keys], [-1] * len(keys), [h for _, h in keys],
                list(tail.values()),
            )
            tail.clear()
            return batch

        def placed() -> Iterator[pa.RecordBatch]:
            seen = np.flatnonzero(dense)
            for start in range(0, len(seen), FLUSH):
                cells = seen[start : start + FLUSH]
                own = words.take(pa.array(cells // width))
                yield rows(own, cells // width, cells % width, dense[cells].astype(np.int64))
            dense[seen] = 0

        def settle() -> None:
            np.add.at(dense, np.concatenate(open_), np.int32(1))
            open_.clear()

        for batch in stream:
            column = batch.column("content")
            for i in range(batch.num_rows):
                places, before, others = reader(column[i].as_py())
                inside = places >= first
                open_.append(places[inside] * width + before[inside])
                size += len(places)
                tail.update(zip(others, before[places < 0].tolist()))
                if len(tail) >= FLUSH:
                    yield unplaced()
                if size >= FLUSH:
                    settle()
                    size = 0
                    if dense.max() > FULL:
                        yield from placed()
        if open_:
            settle()
        if tail:
            yield unplaced()
        yield from placed()

    found = texts.select("content").mapInArrow(
        batches, "word string, place int, history int, n long"
    )
    # One shuffle, by word, serves both aggregations.
    return (
        found.repartition("word")
        .groupBy("word", "place", "history")
        .agg(F.sum("n").alias("n"))
        .groupBy("word", "place")
        .agg(
            F.sum("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("history", "n"))).alias("near"),
        )
    )


def best_classes(
    cells: np.ndarray, starts: np.ndarray, history: np.ndarray, times: np.ndarray,
    own: np.ndarray | None,
) -> np.ndarray:
    """The class that suits each word best; entries of word i start at ``starts[i]``.

    Without ``own`` words are not in ``cells`` yet. A word stays where no class is better.
    """
    totals = cells.sum(axis=0)
    sums = np.add.reduceat(times, starts)
    rows = cells[history]
    gain = np.add.reduceat(x_log_x(rows + times[:, None]) - x_log_x(rows), starts, axis=0)
    gain -= x_log_x(totals + sums[:, None]) - x_log_x(totals)
    if own is None:
        return gain.argmax(axis=1)
    counts = np.diff(np.append(starts, len(times)))
    here = cells[history, np.repeat(own, counts)]
    stay = np.add.reduceat(x_log_x(here) - x_log_x(here - times), starts)
    stay -= x_log_x(totals[own]) - x_log_x(totals[own] - sums)
    gain[np.arange(len(own)), own] = stay
    best = gain.argmax(axis=1)
    better = gain[np.arange(len(own)), best] > stay + 1e-9 * np.abs(stay)
    return np.where(better, best, own)


def _near(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, histories and times of the entries of a batch."""
    lists = batch.column("near")
    flat = lists.flatten()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    history = flat.field("history").to_numpy(zero_copy_only=False)
    times = flat.field("n").to_numpy(zero_copy_only=False).astype(float)
    return starts, history, times


def _choose(cells: np.ndarray, batch: pa.RecordBatch, own: np.ndarray | None) -> np.ndarray:
    """Classes for a batch. Words seen after one history alone are alike by history and count."""
    starts, history, times = _near(batch)
    counts = np.diff(np.append(starts, len(times)))
    chosen = np.zeros(len(starts), np.int64)
    single = np.flatnonzero(counts == 1)
    if len(single):
        at = starts[single]
        keys = [history[at], times[at]] + ([] if own is None else [own[single]])
        alike, back = np.unique(np.stack(keys), axis=1, return_inverse=True)
        kept = None if own is None else alike[2].astype(np.int64)
        found = best_classes(
            cells, np.arange(alike.shape[1]), alike[0].astype(np.int64), alike[1], kept
        )
        chosen[single] = found[back.reshape(-1)]
    several = np.flatnonzero(counts > 1)
    block = np.cumsum(counts[several]) // MOST_ENTRIES
    for words in np.split(several, np.flatnonzero(np.diff(block)) + 1) if len(several) else []:
        size = counts[words]
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        entries = np.arange(size.sum()) - np.repeat(begin - starts[words], size)
        chosen[words] = best_classes(
            cells, begin, history[entries], times[entries], None if own is None else own[words]
        )
    return chosen


def _reclassed(table: DataFrame, cells: np.ndarray, half: int | None) -> DataFrame:
    """The table with ``class`` chosen against ``cells``: all words, or those of one half."""
    kept = table.drop("class") if half is None else table

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not batch.num_rows:
                continue
            if half is None:
                found, base = _choose(cells, batch, None), batch
            else:
                own = batch.column("class").to_numpy(zero_copy_only=False).astype(np.int64)
                turn = batch.column("half").to_numpy(zero_copy_only=False) == half
                found, base = own.copy(), batch.drop_columns(["class"])
                if turn.any():
                    found[turn] = _choose(cells, batch.filter(pa.array(turn)), own[turn])
            yield base.append_column("class", pa.array(found, pa.int32()))

    fields = [*kept.drop("class").schema.fields, T.StructField("class", T.IntegerType())]
    return kept.mapInArrow(batches, T.StructType(fields))


def _cells(table: DataFrame, start: np.ndarray) -> np.ndarray:
    """``start`` and what the words of the table add to it; one row per cell comes back."""
    shape = start.shape

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape[0] * shape[1])
        for batch in stream:
            if not batch.num_rows:
                continue
            starts, history, times = _near(batch)
            own = batch.column("class").to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.repeat(own, np.diff(np.append(starts, len(times))))
            total += np.bincount(history * shape[1] + own, times, len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(total[seen].astype(np.int64))],
            names=["cell", "n"],
        )

    sums = table.select("near", "class").mapInArrow(batches, "cell long, n long")
    whole = start.astype(float).ravel().copy()
    for row in sums.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        whole[row["cell"]] += row["n"]
    return whole.reshape(shape)


def exchange_vocabulary(
    table: DataFrame, seeds: np.ndarray, passes: int
) -> tuple[DataFrame, np.ndarray]:
    """The table of ``history_counts`` with ``class``, and the cells once all words are in.

    ``seeds`` are the cells (history x class) of words that already have a class.
    """
    halves = table.withColumn("half", F.pmod(F.xxhash64("word"), F.lit(2)).cast("int"))
    classed = written(_reclassed(halves, seeds, None), "classes")
    cells = _cells(classed, seeds)
    for number in range(passes):
        moved = written(_reclassed(classed, cells, number % 2), "classes")
        after = _cells(moved, seeds)
        if cell_likelihood(after) <= cell_likelihood(cells):
            break
        classed, cells = moved, after
    return classed, cells
