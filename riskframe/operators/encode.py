"""One dictionary for the values of many columns.

A dictionary of at most ``MOST_HELD`` rows, counted before it is read, travels with the plan: hash
maps for all columns in one transformer, so rows are encoded where they are, without a join or an
exchange. A larger one is joined once for all columns: rows are unpivoted to (row, feature,
value), looked up by one join whose hot values AQE splits, and put together again by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.values import quoted
from riskframe.session import durable

#: Rows of a dictionary that the driver reads and sends with a plan: some 20 MB of short values.
MOST_HELD = 200_000


@dataclass(frozen=True)
class Dictionary:
    """``feature, value, number``; ``held`` has values and numbers per feature if they are few."""

    table: DataFrame
    held: dict[str, tuple[list[str], list[float]]] | None


def dictionary(table: DataFrame, number: str, most: int | None = None) -> Dictionary:
    """A dictionary over ``feature, value, <number>`` rows, one per feature and value."""
    named = table.select("feature", "value", F.col(number).cast("double").alias("number"))
    most = MOST_HELD if most is None else most
    rows = named.limit(most + 1).collect()
    if len(rows) > most:
        return Dictionary(named, None)
    held: dict[str, tuple[list[str], list[float]]] = {}
    for r in rows:
        values, numbers = held.setdefault(r.feature, ([], []))
        values.append(r.value)
        numbers.append(r.number)
    return Dictionary(named, held)


def encode(
    df: DataFrame, words: Dictionary, columns: Sequence[str], unknown: float
) -> DataFrame:
    """Replace the values of ``columns`` by their numbers, unknown and missing ones by ``unknown``."""
    if not columns:
        return df
    found = _held(df, words.held, columns) if words.held is not None else _joined(df, words, columns)
    encoded = {
        c: F.coalesce(F.col(f"_number{i}"), F.lit(float(unknown))) for i, c in enumerate(columns)
    }
    return found.select(*[encoded.get(c, quoted(c)).alias(c) for c in df.columns])


def _held(df: DataFrame, held: dict, columns: Sequence[str]) -> DataFrame:
    known = [i for i, c in enumerate(columns) if c in held]
    nothing = {
        f"_number{i}": F.lit(None).cast("double") for i in range(len(columns)) if i not in known
    }
    if not known:
        return df.withColumns(nothing)
    placed = df.withColumns({f"_value{i}": quoted(columns[i]) for i in known})
    indexed = StringIndexerModel.from_arrays_of_labels(
        [held[columns[i]][0] for i in known],
        inputCols=[f"_value{i}" for i in known],
        outputCols=[f"_place{i}" for i in known],
        handleInvalid="keep",
    ).transform(placed)
    numbers = {}
    for i in known:
        own = held[columns[i]][1]
        # Folded to one constant array by the optimizer; values beyond it are unknown.
        array = F.split(F.lit(",".join(map(repr, own))), ",").cast("array<double>")
        numbers[f"_number{i}"] = F.get(array, F.col(f"_place{i}").cast("int"))
    return indexed.withColumns({**numbers, **nothing})


def _joined(df: DataFrame, words: Dictionary, columns: Sequence[str]) -> DataFrame:
    # The numbers of rows must not change when a task runs again.
    rows = durable(df.withColumn("_row", F.monotonically_increasing_id()))
    cells = F.array(
        *[F.struct(F.lit(i).alias("place"), F.lit(c).alias("feature"), quoted(c).alias("value"))
          for i, c in enumerate(columns)]
    )
    long = rows.select("_row", F.explode(cells).alias("cell")).select("_row", "cell.*")
    met = long.join(words.table, ["feature", "value"]).groupBy("_row").agg(
        *[F.max(F.when(F.col("place") == i, F.col("number"))).alias(f"_number{i}") for i in range(len(columns))]
    )
    return rows.join(met, "_row", "left")
