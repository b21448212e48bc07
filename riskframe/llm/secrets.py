"""Secret scan over an inverted trigram index, in built-in Spark SQL functions only.

Each rule's expression is turned into a Boolean trigram query. The index holds, for every
trigram that some query asks, the documents that contain it (in lower case). Postings are
intersected by counting, per document and alternative, the trigrams present; an alternative whose
trigrams are all there makes the document a candidate of its rule. Candidates are verified with
the expression itself. A rule without mandatory trigrams scans every document.

Positions are code points. A span's start is the length of all that lies before it: the pieces
between the matches and the matches themselves.

Defined cases: a missing text is empty; ids may be missing or repeated, since postings are keyed
by id and a hash of the text (a clash adds a candidate, never a result); further columns play no
part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import content, packed
from riskframe.llm.trigrams import trigram_query


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` must mean the same in Java and Python; ``group`` needs ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Where a minimum length follows a maximal run of one class, it stands in the expression; a
# shorter run holds no longer one. The key of an assignment may stand in the value of a dropped
# one, so there the length is tested after the match.
BASE_RULES = (
    SecretRule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
ADDED_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    SecretRule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    SecretRule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("payment_key", r"[sr]k_live_[A-Za-z0-9]{20,}"),
)
RULES = BASE_RULES + ADDED_RULES


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    return (
        packed(docs)
        .select(F.col(f"row.`{key}`").alias("id"), content(text).alias("content"))
        .withColumn("mark", F.xxhash64("content"))
    )


def postings(keyed: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """``trigram, id, mark``: one row per document and asked trigram that it contains."""
    lowered = keyed.select("id", "mark", F.lower("content").alias("low"))
    present = F.array_compact(
        F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    )
    return lowered.select("id", "mark", F.explode(present).alias("trigram"))


def candidates(keyed: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """``id, mark, kinds``: documents and the rules whose query they satisfy."""
    clauses = [
        (rule.kind, sorted(clause))
        for rule in rules
        for clause in sorted(trigram_query(rule.pattern), key=sorted)
    ]
    by_trigram: dict[str, list[int]] = {}
    for number, (_, clause) in enumerate(clauses):
        for trigram in clause:
            by_trigram.setdefault(trigram, []).append(number)
    asked = F.create_map(
        *[x for t, ns in sorted(by_trigram.items()) for x in (F.lit(t), _literals(ns))]
    )
    needs = _literals([len(clause) for _, clause in clauses])
    kinds = _literals([kind for kind, _ in clauses])
    return (
        postings(keyed, sorted(by_trigram))
        .select("id", "mark", F.explode(asked[F.col("trigram")]).alias("clause"))
        .groupBy("id", "mark", "clause")
        .agg(F.count(F.lit(1)).alias("found"))
        # A key that stands for several texts of one id may count more than it needs.
        .where(F.col("found") >= F.get(needs, F.col("clause")))
        .groupBy("id", "mark")
        .agg(F.collect_set(F.get(kinds, F.col("clause"))).alias("kinds"))
    )


def _literals(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def spans(text: Column, rule: SecretRule, order: int) -> Column:
    """Spans of a rule in a text as structs that sort by start, then by the rules' order."""
    pattern = F.lit(rule.pattern)
    pieces = F.split(text, rule.pattern, -1)
    lengths = F.zip_with(
        F.transform(pieces, lambda x: F.length(x)),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x)),
        lambda before, own: F.struct(before.alias("before"), own.alias("own")),
    )
    checked = F.transform(
        F.regexp_extract_all(text, pattern, F.lit(rule.group)),
        lambda x: F.length(x) >= rule.least,
    )
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    walked = F.aggregate(
        F.filter(lengths, lambda x: x.own.isNotNull()),
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda state, x: F.struct(
            (state["at"] + x.before + x.own).alias("at"),
            F.concat(
                state["found"],
                F.array(
                    F.struct(
                        (state["at"] + x.before).alias("start"),
                        F.lit(order).alias("order"),
                        (state["at"] + x.before + x.own).alias("end"),
                        F.lit(rule.kind).alias("kind"),
                    )
                ),
            ).alias("found"),
        ),
    )["found"]
    kept = F.filter(walked, lambda x, i: F.get(checked, i)) if rule.least else walked
    return F.when(F.rlike(text, pattern), kept).otherwise(none)


def _listed(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ","
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    rules: Sequence[SecretRule] = RULES,
) -> DataFrame:
    """``doc_id`` and ``found``: all spans of all rules, ordered by start and rule."""
    keyed = _keyed(docs, text, key)
    indexed = [r for r in rules if trigram_query(r.pattern) is not None]
    if not indexed:
        matched = keyed.withColumn("kinds", F.array().cast("array<string>"))
    else:
        matched = (
            keyed.alias("a")
            .join(
                candidates(keyed, indexed).alias("b"),
                F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.mark") == F.col("b.mark")),
                "left",
            )
            .select("a.id", "a.content", F.coalesce("b.kinds", F.array()).alias("kinds"))
        )
    each = []
    for order, rule in enumerate(rules):
        own = spans(F.col("content"), rule, order)
        if rule in indexed:
            own = F.when(F.array_contains("kinds", rule.kind), own)
        each.append(F.coalesce(own, F.array()))
    return matched.select(
        F.col("id").alias("doc_id"), F.array_sort(F.concat(*each)).alias("found")
    )


def _of_kind(kind: str):
    return lambda x: x.kind == kind


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts and listings of the base rules, and the listing of all rules, per document."""
    listed = [rule.kind for rule in BASE_RULES]
    found = scan(docs, text, key)
    base = F.filter("found", lambda x: x.kind.isin(listed))
    counts = [
        F.size(F.filter("found", _of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in listed
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )
