"""Exact deduplication that stays even under hot contents.

Copies are combined three times, each time by comparing the full content: inside every input
task (the map-side half of the first aggregate), then among the copies with one digest and one
salt, then among the salt winners of a digest. A content that fills a third of the table is
thus spread over ``salts`` tasks and reaches its final group as at most ``salts`` rows.

Defined cases: a missing text equals an empty one; a missing id loses to any other; rows that
agree in id and text are one copy each, and of them the one with the largest hash over the other
columns stays; an empty table gives an empty result; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm.common import content, packed, row_tie

SALTS = 256


def _keyed(docs: DataFrame, text: str, key: str, salts: int) -> DataFrame:
    others = [c for c in docs.columns if c not in (text, key)]
    rows = packed(docs).select("row", content(text).alias("content"))
    return rows.select(
        "row",
        "content",
        F.col(f"row.`{key}`").alias("id"),
        F.sha2("content", 256).alias("digest"),
        F.pmod(F.xxhash64(F.col(f"row.`{key}`")), F.lit(salts)).alias("salt"),
        row_tie(others).alias("tie"),
    )




def decisions(
    docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    keyed = _keyed(docs, text, key, salts)
    local = keyed.groupBy("digest", "salt", "content").agg(
        F.max("id").alias("best"), F.count(F.lit(1)).alias("n")
    )
    group = W.partitionBy("digest", "content")
    merged = local.select(
        "digest",
        "salt",
        F.length("content").alias("chars"),
        F.max("best").over(group).alias("keep_id"),
        F.sum("n").over(group).alias("group_size"),
    )
    # Rows of one id and one content: the first by tie is the copy that can stay.
    copies = W.partitionBy("digest", "salt", "id").orderBy(F.desc("tie"))
    members = (
        keyed.select("digest", "salt", "id", "tie", F.length("content").alias("own_chars"))
        .repartition("digest", "salt")
        .withColumn("copy", F.row_number().over(copies))
    )
    return members.join(merged, ["digest", "salt"]).where("own_chars = chars").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def survivors(
    docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """The rows that stay, with their own columns; texts move twice and are never joined back."""
    others = [c for c in docs.columns if c != text]
    order = F.struct("id", "tie")
    keyed = _keyed(docs, text, key, salts).select(
        "digest",
        "salt",
        "content",
        order.alias("rank"),
        F.struct(
            F.col(f"row.`{text}`").isNull().alias("absent"),
            *[F.col(f"row.`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
        ).alias("rest"),
    )
    best = (F.max_by("rest", "rank").alias("rest"), F.max("rank").alias("rank"))
    local = keyed.groupBy("digest", "salt", "content").agg(*best)
    final = local.groupBy("digest", "content").agg(*best)
    found = {c: F.col(f"rest.c{i}") for i, c in enumerate(others)}
    found[text] = F.when(~F.col("rest.absent"), F.col("content"))
    return final.select(*[found[c].alias(c) for c in docs.columns])
