"""Repair of conversations: the cheapest edits that give a legal order of roles.

A repaired conversation is empty, or an optional system turn and then user and assistant in turn.
Edits and their costs: Keep a row 0, Rerole it to user or assistant 3, Delete it 4 (blank and
duplicate rows must go), Insert an empty turn 3; a truncated row that stays adds 3. The edits are
a path through a lattice whose nodes are (rows read, state of the order). Dijkstra runs from both
ends with a heap each; nodes leave a heap by (cost, rows read), so a node's least audit is known
when it leaves. The search goes on until the two heaps together exceed the best cost, so every
crossing of that cost is found, and the least of the concatenated audits wins.

A table is ordered by ranges of (conversation, turn, role, text), so rows of one conversation may
lie in several tasks. Each task cuts its rows into segments of one conversation and at most
``SEGMENT`` rows. A segment that is a whole conversation needs one search; the others give the
best audit between each two states, and segments are joined in order. Two audits of equal cost
between the same states are never one the start of the other (what is longer costs more), so
the least whole audit is made of least parts.

The text digest of a conversation has no parallel form; its rows stream through one task in order,
one at a time.

Defined cases: a missing role or text is one space; a missing turn comes first and a missing
conversation id is a conversation; rows of one turn are ordered by role and text; repeated rows
count each and all but the first are duplicates; roles count by their first character; other
columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from riskframe.llm.common import SPACES, cut, packed

SEGMENT = 256
DAMAGES = 20
DROP, EMPTY, UNPOINT, REPEAT, USER = range(5)
SENTENCE_ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of the order: nothing yet, after a system, a user and an assistant turn.
START, SYSTEM, ASKED, REPLIED = range(4)
STATES = range(4)
LEGAL_ENDS = (START, REPLIED)
NEXT = {START: ASKED, SYSTEM: ASKED, REPLIED: ASKED, ASKED: REPLIED}
NAMES = {ASKED: "user", REPLIED: "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")

Row = tuple[str, bool, bool]  # first character of the role, must go, truncated
Found = tuple[int, str]


def damaged(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv, turn, role, text`` after planted damage, chosen by a hash of conversation and turn."""
    rows = _named(turns, key, turn, role, text)
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    fault = F.crc32(F.concat_ws(":", *spelled)) % DAMAGES
    times = F.when(fault == REPEAT, 2).otherwise(1)
    return rows.where(fault != DROP).select(
        "conv",
        "turn",
        F.when(fault == USER, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == EMPTY, "")
        .when(fault == UNPOINT, F.translate("text", SENTENCE_ENDS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    ).drop("copy")


def _named(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    return packed(turns).select(
        F.col(f"row.`{key}`").alias("conv"),
        F.col(f"row.`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"row.`{role}`"), space).alias("role"),
        F.coalesce(F.col(f"row.`{text}`"), space).alias("text"),
    )


def _same(a: str, b: str, names: Iterable[str]):
    met = F.lit(True)
    for c in names:
        met = met & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return met


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in order, with their first fault, their task ``part`` and their number in it."""
    names = ["conv", "turn", "role", "text"]
    distinct = rows.groupBy(*names).agg(F.count(F.lit(1)).cast("int").alias("times"))
    marked = distinct.withColumn("mark", F.sha2("text", 256))
    # Only the first turn of a text is named: one row per text, however often it comes.
    turn = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    firsts = (
        marked.groupBy("conv", "role", "mark").agg(F.min(turn).alias("first"))
        .select("conv", "role", "mark", F.col("first.turn").alias("turn"))
    )
    told = (
        marked.alias("a")
        .join(firsts.alias("b"), _same("a", "b", ("conv", "role", "mark", "turn")), "left")
        .select("a.*", F.col("b.mark").isNotNull().alias("first"))
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spoken = F.rtrim("text", F.lit(SPACES))
    each = (
        told.repartitionByRange(parts, *names)
        .sortWithinPartitions(*names)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
    )
    blank = spoken == ""
    copy = ~F.col("first") | (F.col("copy") > 1)
    last = F.substring(spoken, -1, 1)
    fault = (
        F.when(blank, "blank").when(copy, "duplicate")
        .when(~last.isin(*SENTENCE_ENDS), "truncated").otherwise("")
    )
    return each.select(
        *names,
        fault.alias("fault"),
        F.spark_partition_id().cast("long").alias("part"),
        F.monotonically_increasing_id().alias("place"),
    )


def kept_state(state: int, initial: str) -> int | None:
    """State after keeping a row, if the order allows it."""
    if initial == "s" and state == START:
        return SYSTEM
    if initial == "u" and state != ASKED:
        return ASKED
    if initial == "a" and state == ASKED:
        return REPLIED
    return None


def edits(rows: list[Row], i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits at a node: letter, cost, rows read and state afterwards."""
    yield "I", INSERT, i, NEXT[state]
    if i == len(rows):
        return
    initial, must_go, truncated = rows[i]
    yield "D", DELETE, i + 1, state
    if not must_go:
        more = TRUNCATED if truncated else 0
        after = kept_state(state, initial)
        if after is not None:
            yield "K", more, i + 1, after
        yield "R", REROLE + more, i + 1, NEXT[state]


def edits_into(rows: list[Row], i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits that lead to a node: letter, cost, rows read and state before."""
    for before in STATES:
        for at in (i, i - 1):
            if at >= 0:
                for letter, cost, j, after in edits(rows, at, before):
                    if (j, after) == (i, state):
                        yield letter, cost, at, before


def cheapest(rows: list[Row], start: int, goals: Iterable[int]) -> Found | None:
    """Least cost and, of equal cost, least audit from a state to any of the goals."""
    ends = [{(0, start): (0, "")}, {(len(rows), g): (0, "") for g in goals}]
    heaps = [[(0, 0, start)], [(0, -len(rows), g) for g in goals]]
    heapq.heapify(heaps[1])
    settled: list[set] = [set(), set()]
    best: int | None = None
    if ends[0].keys() & ends[1].keys():
        best = 0
    # Both ends leave their heaps before the search may stop.
    opening = [0, *[1] * len(heaps[1])]
    while opening or (heaps[0] and heaps[1]):
        if opening:
            side = opening.pop()
        elif best is not None and heaps[0][0][0] + heaps[1][0][0] > best:
            break
        else:
            side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, i, state = heapq.heappop(heaps[side])
        node = (abs(i), state)
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = ends[side][node][1]
        for letter, more, j, other in (edits_into if side else edits)(rows, *node):
            reached, total = (j, other), cost + more
            new = (total, letter + audit if side else audit + letter)
            old = ends[side].get(reached)
            if old is None or new < old:
                ends[side][reached] = new
                if old is None or total < old[0]:
                    heapq.heappush(heaps[side], (total, -j if side else j, other))
            across = ends[1 - side].get(reached)
            if across is not None and (best is None or total + across[0] < best):
                best = total + across[0]
    if best is None:
        return None
    audits = []
    for node in settled[0]:
        cost, audit = ends[0][node]
        if node in settled[1] and cost + ends[1][node][0] == best:
            audits.append(audit + ends[1][node][1])
        for letter, more, j, other in edits(rows, *node):
            if (j, other) in settled[1] and cost + more + ends[1][j, other][0] == best:
                audits.append(audit + letter + ends[1][j, other][1])
    return best, min(audits)


def applied(audit: str, state: int, rows: list[tuple]) -> Iterator[tuple[str, int | None, str, str]]:
    """Edit, turn, role and text of every repaired row; rows are (turn, role, text)."""
    i = 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "I":
            state = NEXT[state]
            yield letter, None, NAMES[state], ""
            continue
        turn, role, text = rows[i]
        i += 1
        if letter == "K":
            state = kept_state(state, role[:1])
        else:
            state = NEXT[state]
            role = NAMES[state]
        yield letter, turn, role, text


COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _segment_type(df: DataFrame) -> str:
    kind = df.schema["conv"].dataType.simpleString()
    return (
        f"conv {kind}, part long, seg long, whole boolean, head string, tail string,"
        " low long, high long, turns long, blank long, duplicate long, truncated long,"
        " illegal long, costs array<long>, audits array<string>"
    )


def _summary(rows: list[dict], part: int, seg: int, whole: bool) -> dict:
    first = [r["role"][:1] for r in rows]
    known = [r["turn"] for r in rows if r["turn"] is not None]
    lattice = [
        (c, r["fault"] in ("blank", "duplicate"), r["fault"] == "truncated")
        for c, r in zip(first, rows)
    ]
    if whole:
        found = [cheapest(lattice, START, LEGAL_ENDS)]
    else:
        found = [cheapest(lattice, a, (b,)) for a in STATES for b in STATES]
    return {
        "conv": rows[0]["conv"], "part": part, "seg": seg, "whole": whole,
        "head": first[0], "tail": first[-1],
        "low": known[0] if known else None, "high": known[-1] if known else None,
        "turns": len(set(known)),
        **{k: sum(r["fault"] == k for r in rows) for k in COUNTS[:3]},
        "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(first, first[1:])),
        "costs": [f and f[0] for f in found],
        "audits": [f and f[1] for f in found],
    }


def _segments(ordered: DataFrame) -> DataFrame:
    """One row per segment. ``ordered`` is a checkpoint, so its tasks read their rows in order."""

    def streams(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        seg, first_conv, cut_before = 0, True, False
        out = []

        def close(ends_conv: bool, at_edge: bool) -> None:
            nonlocal seg, held
            whole = ends_conv and not cut_before and not first_conv and not at_edge
            out.append(_summary(held, held[0]["part"], seg, whole))
            seg, held = seg + 1, []

        for batch in stream:
            for row in batch.to_pylist():
                if held and row["conv"] != held[0]["conv"]:
                    close(True, False)
                    first_conv = cut_before = False
                elif len(held) == SEGMENT:
                    close(False, False)
                    cut_before = True
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if held:
            close(True, True)
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    given = ordered.select("conv", "turn", "role", "fault", "part")
    kind = _segment_type(ordered)
    empty = ordered.sparkSession.createDataFrame([], kind)
    schema = to_arrow_schema(empty.schema)
    return given.mapInArrow(streams, kind)


def _joined(parts: list[dict]) -> tuple[dict, list[dict]]:
    """A conversation's totals, and every segment's first state and audit."""
    parts.sort(key=lambda p: (p["part"], p["seg"]))
    best: dict[int, tuple[int, str, list]] = {START: (0, "", [])}
    total = {k: 0 for k in (*COUNTS, "turns")}
    tail, low, high = None, None, None
    for p in parts:
        reached: dict[int, tuple[int, str, list]] = {}
        for a, (cost, audit, path) in best.items():
            for b in STATES:
                more = p["costs"][4 * a + b]
                if more is not None:
                    piece = p["audits"][4 * a + b]
                    new = (cost + more, audit + piece, [*path, (a, piece)])
                    if b not in reached or new[:2] < reached[b][:2]:
                        reached[b] = new
        best = reached
        for k in total:
            total[k] += p[k]
        if tail is not None:
            total["illegal"] += tail + p["head"] not in LEGAL_PAIRS
        tail = p["tail"]
        if p["low"] is not None:
            total["turns"] -= high == p["low"]
            low, high = p["low"] if low is None else low, p["high"]
    cost, audit, path = min((best[b] for b in LEGAL_ENDS if b in best), key=lambda x: x[:2])
    conv = {"conv": parts[0]["conv"], "low": low, "high": high, **total, "cost": cost, "audit": audit}
    pieces = [
        {"conv": p["conv"], "part": p["part"], "seg": p["seg"], "state": a, "piece": piece}
        for p, (a, piece) in zip(parts, path)
    ]
    return conv, pieces


class Repair:
    """Repaired conversations of a table: totals, turns and digests."""

    def __init__(
        self, turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
    ):
        self.rows = cut(_ordered(_named(turns, key, turn, role, text)))
        segments = cut(_segments(self.rows))
        kind = self.rows.schema["conv"].dataType.simpleString()
        one = segments.where("whole")
        numbers = ["low", "high", *COUNTS, "turns"]
        fields = f"conv {kind}, " + ", ".join(f"{c} long" for c in numbers) + ", cost long, audit string"
        parted = f"conv {kind}, part long, seg long, state int, piece string"
        many = segments.where("not whole").groupBy("conv")
        spark = turns.sparkSession
        conv_schema = to_arrow_schema(spark.createDataFrame([], fields).schema)
        piece_schema = to_arrow_schema(spark.createDataFrame([], parted).schema)

        def join_totals(sent: pa.Table) -> pa.Table:
            return pa.Table.from_pylist([_joined(sent.to_pylist())[0]], schema=conv_schema)

        def join_pieces(sent: pa.Table) -> pa.Table:
            return pa.Table.from_pylist(_joined(sent.to_pylist())[1], schema=piece_schema)

        self.totals = one.select(
            "conv", *numbers, F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit")
        ).unionByName(many.applyInArrow(join_totals, fields))
        self.pieces = one.select(
            "conv", "part", "seg", F.lit(START).alias("state"), F.col("audits")[0].alias("piece")
        ).unionByName(many.applyInArrow(join_pieces, parted))

    def _streamed(self, *by: str) -> DataFrame:
        """Pieces and the rows they edit, in order; a piece comes before the rows of its segment."""
        nothing = F.lit(None)
        pieces = self.pieces.select(
            "conv", "part", "seg", F.lit(-1).cast("long").alias("place"), "state", "piece",
            nothing.cast("long").alias("turn"), nothing.cast("string").alias("role"),
            nothing.cast("string").alias("text"),
        )
        rows = self.rows.withColumn("seg", F.lit(0).cast("long")).select(
            "conv", "part", "seg", "place", nothing.cast("int").alias("state"),
            nothing.cast("string").alias("piece"), "turn", "role", "text",
        )
        parts = int(self.rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # A conversation's pieces of one task come first, in order, then its rows of that task.
        return (
            pieces.unionByName(rows)
            .repartition(parts, *by)
            .sortWithinPartitions("conv", "part", F.col("piece").isNull(), "seg", "place")
        )

    def turns(self) -> DataFrame:
        """``conv, part, number, edit, turn, role, text``: the repaired rows in order."""
        kind = self.rows.schema["conv"].dataType.simpleString()
        fields = f"conv {kind}, part long, number long, edit string, turn long, role string, text string"

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, rows in enumerate(_repaired(batches)):
                yield pa.RecordBatch.from_pylist(
                    [
                        {"conv": conv, "part": part, "number": number * SEGMENT * 4 + i, "edit": edit,
                         "turn": turn, "role": role, "text": text}
                        for i, (conv, part, edit, turn, role, text) in enumerate(rows)
                    ],
                    schema=schema,
                )

        schema = to_arrow_schema(self.rows.sparkSession.createDataFrame([], fields).schema)
        return self._streamed("conv", "part").mapInArrow(stream, fields)

    def digests(self) -> DataFrame:
        """``conv, repaired_sha256``: digest of ``role:text`` lines."""
        kind = self.rows.schema["conv"].dataType.simpleString()
        fields = f"conv {kind}, repaired_sha256 string"

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from hashlib import sha256

            state, current, started, lines = sha256(), None, False, 0
            for rows in _repaired(batches, empty=True):
                done = []
                for conv, _, _, _, role, text in rows:
                    if started and conv != current:
                        done.append({"conv": current, "repaired_sha256": state.hexdigest()})
                        state, lines = sha256(), 0
                    current, started = conv, True
                    if role is not None:
                        state.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                        lines += 1
                if done:
                    yield pa.RecordBatch.from_pylist(done, schema=schema)
            if started:
                last = [{"conv": current, "repaired_sha256": state.hexdigest()}]
                yield pa.RecordBatch.from_pylist(last, schema=schema)

        schema = to_arrow_schema(self.rows.sparkSession.createDataFrame([], fields).schema)
        return self._streamed("conv").mapInArrow(stream, fields)


def _repaired(batches: Iterator[pa.RecordBatch], empty: bool = False) -> Iterator[list[tuple]]:
    """Repaired rows of every segment; with ``empty`` one row without a role where none stay."""
    waiting: list[dict] = []
    held: list[tuple] = []

    def need() -> int:
        return sum(c != "I" for c in waiting[0]["piece"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["piece"] is not None:
                waiting.append(row)
                continue
            held.append((row["turn"], row["role"], row["text"]))
            if len(held) == need():
                piece = waiting.pop(0)
                found = [
                    (row["conv"], row["part"], *edit)
                    for edit in applied(piece["piece"], piece["state"], held)
                ]
                if not found and empty:
                    found = [(row["conv"], row["part"], None, None, None, None)]
                held = []
                if found:
                    yield found


def report(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Every conversation's faults and repair after planted damage."""
    every = packed(turns).select(F.col(f"row.`{key}`").alias("conv")).distinct()
    repair = Repair(damaged(turns, key, turn, role, text), "conv", "turn", "role", "text")
    totals, digests = repair.totals, repair.digests()
    zero = F.lit(0).cast("long")
    return (
        every.alias("e")
        .join(totals.alias("t"), _same("e", "t", ["conv"]), "left")
        .join(digests.alias("d"), _same("e", "d", ["conv"]), "left")
        .select(
            F.col("e.conv").alias("conv_id"),
            F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), zero).alias("gaps"),
            *[F.coalesce(F.col(c), zero).alias(c) for c in (*COUNTS, "cost")],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
