"""Mixing sources to target weights by weighted sampling without replacement.

Targets: sources in code point order (a missing source last) weigh ``weights`` in turn and share
the words of the whole table; a target stops at ``most`` times its source, and what is over goes
to the others by weight until none is above. Taking: a source's whole epochs come first; the
rest of its target is filled by Efraimidis-Spirakis sampling. Every document draws
-ln(u) / quality, documents are taken in that order, and the prefix sum of their sizes is held
against the remaining budget. u is a hash of seed and id, so reruns agree.

No source is ever sorted in one task: the draw is cut into ranges by its expected distribution,
the number of ranges follows the number of rows, and a range gets its starting sum from the
totals of the ranges before it. The ranges only spread work; they do not change the order.

Defined cases: a missing text has size 0; documents of size 0 take no words and are repeated and
drawn like the others; a missing source is a source of its own; repeated rows are documents
of their own; equal draws are ordered by id and size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm.common import WORD, content, cut, packed, row_tie

WEIGHTS = (5, 2, 1)
MOST = 3
ROWS_PER_RANGE = 4_000
NOISE = "#*$%&|<>!"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"({WORD})")).cast("long")


def quality_weight(text: Column) -> Column:
    """Fourth power of the share of characters that are not noise symbols, at least 0.01."""
    clean = F.length(F.translate(text, NOISE, "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(clean * clean * clean * clean, F.lit(0.01))


def uniform(seed: int, key: Column) -> Column:
    """A number in (0, 1) from 52 bits of a digest of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """``source, source_size`` -> the same with ``target``; one row per source.

    A source is capped if, with every source of a smaller capacity per weight capped, its share
    of what is left exceeds its capacity. Whole numbers throughout, so the test is exact.
    """
    whole = "decimal(38,0)"
    turn = (F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    weighed = sizes.select(
        "source",
        F.col("source_size").cast(whole).alias("size"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
        .cast(whole)
        .alias("weight"),
    )
    by_room = W.orderBy(F.col("size") / F.col("weight"), "weight", F.asc_nulls_last("source"))
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    onward = by_room.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    cap = most * F.col("size")
    placed = weighed.select(
        "*",
        (
            F.sum("size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
        ).alias("left"),
        F.sum("weight").over(onward).alias("open"),
    ).withColumn("capped", F.col("left") * F.col("weight") > cap * F.col("open"))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    taken = F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(everything), F.lit(0))
    share = (
        F.col("weight")
        * (F.sum("size").over(everything) - taken).cast("double")
        / open_weight.cast("double")
    )
    return placed.select(
        "source",
        F.col("size").cast("long").alias("source_size"),
        F.when(F.col("capped"), cap.cast("double")).otherwise(share).alias("target"),
    )


def mixing_plan(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    weight: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = 42,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Every document with ``size, source_size, target, taken, epochs, picked``.

    ``weight`` is an expression over ``content`` (the text); by default ``quality_weight``.
    """
    quality = quality_weight(F.col("content")) if weight is None else weight
    sized = cut(
        packed(docs)
        .select(
            F.col(f"row.`{key}`").alias("id"),
            F.col(f"row.`{source}`").cast("string").alias("source"),
            content(text).alias("content"),
            row_tie(docs.columns).alias("tie"),
        )
        .select(
            "id",
            "source",
            "tie",
            # Joins on a key that is never null.
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("stream"),
            word_count(F.col("content")).alias("size"),
            quality.alias("quality"),
        )
        .withColumn("draw", -F.log(uniform(seed, F.col("id"))) / F.col("quality"))
    )
    rows, mean = sized.agg(F.count(F.lit(1)), F.coalesce(F.avg("quality"), F.lit(1.0))).first()
    ranges = -(-rows // rows_per_range) if rows else 1
    spread = F.floor(F.lit(float(ranges)) * (1 - F.exp(-F.col("draw") * F.lit(mean))))
    ranged = sized.withColumn("range", F.least(spread, F.lit(ranges - 1)))

    totals = ranged.groupBy("stream", "range").agg(
        F.first("source").alias("source"), F.sum("size").alias("range_size")
    )
    targets = source_targets(
        totals.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, most
    ).select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("stream"),
        "source_size",
        "target",
    )
    earlier = W.partitionBy("stream").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "stream",
        "range",
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("start"),
    ).join(targets, "stream")

    inside = W.partitionBy("stream", "range").orderBy("draw", "id", "size")
    placed = ranged.withColumn(
        "inner", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    ).join(starts, ["stream", "range"])
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    # The document that crosses the budget is taken when that comes nearer to it.
    middle = F.col("start") + F.col("inner") + F.col("size") / 2
    return (
        placed.withColumn("epochs", epochs)
        .withColumn("picked", middle <= budget)
        .select(
            F.col("id").alias("doc_id"),
            "source",
            "size",
            "source_size",
            "target",
            (F.col("size") * (F.col("epochs") + F.col("picked").cast("long"))).alias("taken"),
            "epochs",
            "picked",
            "tie",
        )
    )


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The documents of the mix with their own columns, each as often as the plan takes it."""
    plan = mixing_plan(docs, text=text, key=key, **options)
    copies = plan.groupBy(F.col("doc_id").alias("id"), "tie").agg(
        F.sum(F.col("epochs") + F.col("picked").cast("long")).alias("copies")
    )
    # Rows that agree in every column are one entry here and add up in ``copies``.
    one = W.partitionBy("id", "tie").orderBy(F.lit(1))
    rows = (
        packed(docs)
        .select("row", F.col(f"row.`{key}`").alias("id"), row_tie(docs.columns).alias("tie"))
        .withColumn("place", F.row_number().over(one))
        .where("place = 1")
    )
    chosen = rows.alias("a").join(
        copies.where("copies > 0").alias("b"),
        F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.tie") == F.col("b.tie")),
    )
    return chosen.select(
        F.col("row"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    ).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
