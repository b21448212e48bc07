"""Near-duplicate groups by SimHash, with candidates from pigeonring filtering.

Fingerprint: lower-cased (A-Z) words, shingles of ``SHINGLE`` words with repeats, XXH64 with seed
42 of each shingle; a bit is set if it is set in more than half of the hashes.

Linking: the 64 bits are a ring of four segments. If two fingerprints differ in at most three
bits, some segment starts a chain in which the first segment differs in 0 bits, the first two in
at most 1, the first three in at most 2 and all four in at most 3 (each bound is the proportional
share of the budget, rounded down). The first two conditions are the join: for every start of
the ring a fingerprint is listed under its two leading segments, and it asks under its own two
and under those with one set bit of the second cleared; for a pair that differs in that one bit,
just one side has it set, so each pair meets once per start. A key thus fixes 32 bits, so
unrelated fingerprints rarely meet whatever the size of the table. The third and fourth
condition filter inside the join, so only links leave it.

Equal fingerprints are one node, so copies cost nothing here. Groups of linked nodes come from
rounds of large-star and small-star steps over links alone, each round cut into the shared
folder, until nothing changes.

``similar`` groups by Jaccard similarity of shingle sets instead, at any threshold and shingle. Two
texts at a similarity of 0.8 differ in about ten of 64 bits, spread over all segments, so a segment
of such a fingerprint fixes too little. The ring is therefore longer and each of its segments a
SimHash of its own: the distinct shingles are dealt to segments by a hash, about six to each, and a
segment holds the 64 bits of those dealt to it. A shingle that only one text has touches one
segment, so by the pigeonhole principle some segments stay equal: the chain starts there, at 0 bits,
and texts that share such a segment are compared on their whole sets. ``RING`` segments are listed;
short texts deal their shingles several times. Texts of similar size must deal to as many segments,
so the number follows the size in steps of the square root of two, and a text just below a step is
listed on both sides of it. At 0.8 a segment of a long text is equal and listed with a probability of about
0.18 or more, so a pair meets nowhere with one of about 0.82^48, 7 in 100,000; every pair that is
linked has been checked. Segments with the same members are compared once. Up to ``MET`` members are
compared in one task; more are dealt into slots, each with the segment's smallest node. Where that
leaves members in several groups, those outside the largest group are compared with all members of
other groups, block by block, so no pair that shares a segment is left out. Texts with equal sets (by
a 64-bit hash) are one node; sets hold 40 bits of every hash.

Defined cases: a missing text is empty; a text without words has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; the group id is the smallest id
reachable, null only if no member has an id; repeated rows share a group; an empty table gives
an empty result; further columns are carried by ``representatives`` and never read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm.common import content, cut, packed, row_tie

SHINGLE = 3
SEED = 42
SEGMENTS = 4
SEGMENT_BITS = 16
BUDGET = 3
BANDS = 25
BAND_ROWS = 4
#: Segments that a text lists for ``similar``.
RING = 48
#: Shingles dealt to a segment, on average at most.
DEALT = 7
#: Fewest shingles whose fingerprint is listed, for texts of ``LONG`` shingles or more.
FEWEST = 4
LONG = 16
#: Members of a key that are compared in one task.
MET = 256
#: Bytes of a hash that sets keep.
SET_BYTES = 5
#: Hashes whose bits are counted at once.
BLOCK = 1 << 14


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Hash of every shingle of a text, repeats included; none without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    total = max(1, len(words) - shingle + 1)
    return np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64, total)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a text as a signed 64-bit integer."""
    hashes = shingle_hashes(text, shingle)
    total = len(hashes)
    if not total:
        return 0
    ones = np.zeros(64, np.int64)
    for start in range(0, total, BLOCK):
        block = hashes[start : start + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``id, content`` and further columns -> the same without ``content``, with ``fp``."""
    others = [c for c in rows.columns if c != "content"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = [
                fingerprint(batch.column("content")[i].as_py(), shingle)
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(found, pa.int64())],
                names=[*others, "fp"],
            )

    schema = rows.select(*others, F.lit(0).cast("long").alias("fp")).schema
    return rows.select(*others, "content").mapInArrow(batches, schema)


def _rotated(fp: Column, start: int) -> Column:
    """The ring read from segment ``start`` on."""
    if start == 0:
        return fp
    bits = start * SEGMENT_BITS
    return F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits))


def _lead(ring: Column) -> Column:
    """The two leading segments."""
    return F.shiftrightunsigned(ring, 2 * SEGMENT_BITS)


def links(nodes: DataFrame) -> DataFrame:
    """``fp`` (distinct) -> ``a, b``: pairs within the budget, each at least once, a < b."""
    starts = [
        F.struct(F.lit(s).alias("start"), _rotated(F.col("fp"), s).alias("ring"))
        for s in range(SEGMENTS)
    ]
    rings = nodes.select(F.explode(F.array(*starts)).alias("x")).select("x.start", "x.ring")
    listed = rings.select("start", _lead(F.col("ring")).alias("lead"), F.col("ring").alias("other"))
    lead = _lead(F.col("ring"))
    cleared = [
        F.when(lead.bitwiseAND(F.lit(1 << bit)) != 0, lead.bitwiseXOR(F.lit(1 << bit)))
        for bit in range(SEGMENT_BITS)
    ]
    asking = rings.select(
        "start", "ring", F.explode(F.array_compact(F.array(lead, *cleared))).alias("lead")
    )
    apart = F.col("ring").bitwiseXOR(F.col("other"))
    met = asking.join(listed, ["start", "lead"]).where(
        (F.bit_count(F.shiftrightunsigned(apart, SEGMENT_BITS)) <= 2)
        & (F.bit_count(apart) <= BUDGET)
        & (apart != 0)
        # Pairs with equal leading segments meet from both sides.
        & ((_lead(apart) != 0) | (F.col("ring") < F.col("other")))
    )

    def back(ring: Column) -> Column:
        home = _rotated(ring, 0)
        for s in range(1, SEGMENTS):
            home = F.when(F.col("start") == s, _rotated(ring, SEGMENTS - s)).otherwise(home)
        return home

    pair = met.select(back(F.col("ring")).alias("x"), back(F.col("other")).alias("y"))
    return pair.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def groups(pairs: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``a, b`` with a < b -> ``node, root``: every linked node and its group's smallest node."""
    edges = cut(pairs)
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: larger neighbours are hung on the smallest one.
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("m").alias("a"), "b")
            .where("a < b")
            .distinct()
        )
        # Small star: a node and its smaller neighbours are hung on the smallest of them.
        smallest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(smallest, "b").select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b"))
            .otherwise(F.col("a")).alias("b")
        )
        own = smallest.select(F.col("m").alias("a"), "b")
        edges = cut(small.unionByName(own).where("a < b").distinct())
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = state
    raise RuntimeError(f"groups did not settle in {most_rounds} rounds")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE
) -> DataFrame:
    """Every row's ``id, tie, fp, root, component_id``."""
    rows = packed(docs).select(
        F.col(f"row.`{key}`").alias("id"),
        row_tie(docs.columns).alias("tie"),
        content(text).alias("content"),
    )
    found = cut(fingerprints(rows, shingle))
    nodes = cut(found.groupBy("fp").agg(F.min("id").alias("least")))
    grouped = groups(links(nodes.select("fp")))
    placed = nodes.join(
        grouped.withColumnRenamed("node", "fp"), "fp", "left"
    ).select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fp", "root", "component_id")
    return found.join(named, "fp").select("id", "tie", "fp", "root", "component_id")


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """``BANDS`` min-hash keys of a set of shingle hashes, to compare ``segment_keys`` with."""
    from xxhash import xxh64_intdigest

    draw = np.random.Generator(np.random.PCG64(SEED))
    factors, shifts = draw.integers(0, 1 << 64, (2, BANDS * BAND_ROWS), np.uint64)
    factors |= np.uint64(1)
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max)
    for start in range(0, len(hashes), BLOCK >> 3):
        block = hashes[start : start + (BLOCK >> 3)]
        # The upper half folded in: the order of products alone follows that of the hashes.
        mixed = block[None, :] * factors[:, None] + shifts[:, None]
        mixed ^= mixed >> np.uint64(32)
        mixed *= factors[::-1, None]
        least = np.minimum(least, mixed.min(axis=1))
    rows = least.reshape(BANDS, BAND_ROWS)
    keys = [xxh64_intdigest(r.tobytes(), band) for band, r in enumerate(rows)]
    return np.array(keys, np.uint64).view(np.int64)


def _majority(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """SimHash of every run of hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Runs are short: eight counts of a byte are added up as one number.
    if counts.max() < 256:
        ones = np.add.reduceat(bits.view(np.uint64), starts, axis=0).view(np.uint8)
        more = ones > (counts // 2).astype(np.uint8)[:, None]
    else:
        more = np.add.reduceat(bits, starts, axis=0, dtype=np.int64) * 2 > counts[:, None]
    return np.packbits(more, axis=1, bitorder="little").view("<u8").ravel()


def _mixed(values: np.ndarray, factor: np.uint64) -> np.ndarray:
    values = values * factor
    values ^= values >> np.uint64(32)
    return values * np.uint64(0x9E3779B97F4A7C15)


def steps(size: int, similarity: float) -> range:
    """Steps of the square root of two under which a set of this size is listed."""
    step = int(np.floor(2 * np.log2(size) + 1e-9))
    above = int(np.floor(2 * np.log2(size / similarity) + 1e-9))
    return range(step, above + 1)


def segment_prints(hashes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places on the ring and the SimHash of the distinct hashes dealt to each; few make none."""
    parts = max(2, int(np.ceil(2 ** ((step + 1) / 2) / DEALT)))
    turns = np.arange(-(-RING // parts))
    # The upper bits of a product follow all bits of the hash.
    factors = (2 * turns + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    place = (_mixed(hashes[None, :], factors[:, None]) >> np.uint64(32)).astype(np.int64)
    place = place % parts + (turns * parts)[:, None]
    listed = place < RING
    place, own = place[listed], np.broadcast_to(hashes, place.shape)[listed]
    if not len(place):
        return place, own
    order = np.argsort(place.astype(np.uint16), kind="stable")
    place, own = place[order], own[order]
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    counts = np.diff(np.append(starts, len(place)))
    kept = counts >= (FEWEST if 2 ** (step / 2) >= LONG else 1)
    return place[starts][kept], _majority(own, starts, counts)[kept]


def segment_keys(hashes: np.ndarray, similarity: float) -> np.ndarray:
    """Keys of a set of shingle hashes: step, place and SimHash of its segments, as signed longs."""
    keys = [np.zeros(0, np.uint64)]
    for step in steps(len(hashes), similarity):
        place, prints = segment_prints(hashes, step)
        where = _mixed((place + step * RING + 1).astype(np.uint64), np.uint64(0xD6E8FEB86659FD93))
        keys.append(_mixed(prints ^ where, np.uint64(0xC2B2AE3D27D4EB4F)))
    return np.concatenate(keys).view(np.int64)


def _signatures(rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``id, tie, content`` -> ``id, tie, node, keys``; a text without words has no keys."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in stream:
            nodes, keys = [], []
            for i in range(batch.num_rows):
                own = np.unique(shingle_hashes(batch.column("content")[i].as_py(), shingle))
                nodes.append(xxh64_intdigest(own.tobytes(), SEED))
                keys.append(segment_keys(own, similarity) if len(own) else [])
            found = np.array(nodes, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tie"),
                 pa.array(found, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "tie", "node", "keys"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "tie", "content").mapInArrow(
        batches, f"id {kind}, tie long, node long, keys array<long>"
    )


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets given as sorted arrays."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def closed_set(hashes: np.ndarray) -> bytes:
    """Sorted distinct hashes at ``SET_BYTES`` bytes each."""
    kept = np.unique(hashes >> np.uint64(64 - 8 * SET_BYTES)).astype("<u8")
    return kept.view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def opened_set(data: bytes) -> np.ndarray:
    found = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    found[:, :SET_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    return found.view("<u8").ravel()


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets reach a similarity; their sizes alone may tell that they don't."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    return jaccard(a, b) >= similarity


def linked(nodes: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that connect what all pairs at or above ``similarity`` connect."""
    parts: list[list[int]] = []
    found = []
    for i in range(len(nodes)):
        joined, apart = [i], []
        for part in parts:
            near = next(
                (j for j in part if alike(sets[i], sets[j], similarity)),
                None,
            )
            if near is None:
                apart.append(part)
            else:
                found.append((min(nodes[i], nodes[near]), max(nodes[i], nodes[near])))
                joined = part + joined
        parts = [*apart, joined]
    return found


def similar(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, similarity: float = 0.8
) -> DataFrame:
    """Every row's ``id, tie, root``: groups of texts linked by ``similarity`` of shingle sets."""
    rows = packed(docs).select(
        F.col(f"row.`{key}`").alias("id"),
        row_tie(docs.columns).alias("tie"),
        content(text).alias("content"),
    )
    found = cut(_signatures(rows, shingle, similarity))
    place = F.struct(F.col("id").isNull().alias("absent"), "id", "tie")
    nodes = cut(found.groupBy("node").agg(F.min(place).alias("place")))
    # Nearly all keys have one member, so rows are dealt out as they are and most end here.
    listed = cut(
        found.select("node", F.explode("keys").alias("key"))
        .repartition("key")
        .distinct()
        .withColumn("n", F.count(F.lit(1)).over(W.partitionBy("key")))
        .where("n > 1")
        .select("node", "key")
    )
    same = cut(
        listed.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("node").alias("least"),
            F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"),
        )
        .groupBy("n", "least", "members")
        .agg(F.min("key").alias("key"))
    )
    slots = F.ceil(F.col("n") / MET).cast("long")
    met = cut(
        listed.join(same, "key")
        .where("node != least")
        .select("key", F.pmod(F.xxhash64("node", "key"), slots).alias("slot"), "node")
        .unionByName(
            same.select("key", _each(slots).alias("slot"), F.col("least").alias("node"))
        )
    )
    whole = _whole_sets(rows, met.select("node").distinct().join(nodes, "node"), shingle)

    def compared(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("node").sort_values("node")
        arrays = [opened_set(x) for x in part["hashes"]]
        pairs = linked([int(x) for x in part["node"]], arrays, similarity)
        return pd.DataFrame(pairs, columns=["a", "b"]).astype("int64")

    met_sets = met.join(whole, "node").groupBy("key", "slot")
    pairs = cut(met_sets.applyInPandas(compared, "a long, b long").distinct())
    grouped = groups(pairs)
    more = cut(_across(listed, same, grouped, rows, nodes, shingle, similarity).distinct())
    if not more.isEmpty():
        grouped = groups(pairs.unionByName(more).distinct())
    return found.join(grouped, "node", "left").select(
        "id", "tie", F.coalesce("root", "node").alias("root")
    )


def _each(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


def _whole_sets(rows: DataFrame, asked: DataFrame, shingle: int) -> DataFrame:
    """``node, hashes`` of the asked nodes, read from one text of each."""

    def sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = batch.column("content").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"),
                 pa.array([closed_set(shingle_hashes(t, shingle)) for t in texts], pa.binary())],
                names=["node", "hashes"],
            )

    texts = rows.alias("r").join(
        asked.select("node", "place.id", "place.tie").alias("n"),
        F.col("r.id").eqNullSafe(F.col("n.id")) & (F.col("r.tie") == F.col("n.tie")),
    )
    return texts.select("node", "content").mapInArrow(sets, "node long, hashes binary")


def _across(
    listed: DataFrame,
    same: DataFrame,
    grouped: DataFrame,
    rows: DataFrame,
    nodes: DataFrame,
    shingle: int,
    similarity: float,
) -> DataFrame:
    """``a, b``: links between groups that share a key with more than ``MET`` members.

    Members outside the key's largest group ask all members of other groups. Askers and asked are
    dealt into blocks of about ``MET``; a task compares one block with one.
    """
    rooted = (
        listed.join(same.where(F.col("n") > MET).select("key"), "key")
        .join(grouped, "node", "left")
        .select("key", "node", F.coalesce("root", "node").alias("root"))
    )
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    open_keys = (
        sizes.groupBy("key")
        .agg(
            F.max_by("root", F.struct("size", "root")).alias("main"),
            F.sum("size").alias("n"),
            (F.sum("size") - F.max("size")).alias("outside"),
        )
        .where("outside > 0")
    )
    held = cut(rooted.join(open_keys, "key"))
    mine, theirs = (F.ceil(F.col(c) / MET).cast("long") for c in ("outside", "n"))
    dealt = F.xxhash64("key", "node")
    asking = held.where("root != main").select(
        "key", "node", "root", F.lit(True).alias("asks"),
        F.pmod(dealt, mine).alias("mine"), _each(theirs).alias("theirs"),
    )
    asked = held.select(
        "key", "node", "root", F.lit(False).alias("asks"),
        _each(mine).alias("mine"), F.pmod(dealt, theirs).alias("theirs"),
    )
    whole = _whole_sets(rows, held.select("node").distinct().join(nodes, "node"), shingle)

    def compared(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["node", "asks"])
        part = part.assign(hashes=[opened_set(x) for x in part["hashes"]])
        links = []
        others = list(part[~part["asks"]][["node", "root", "hashes"]].itertuples(index=False))
        for node, root, own in part[part["asks"]][["node", "root", "hashes"]].itertuples(index=False):
            done = {root}
            for other, its, theirs in others:
                if its not in done and alike(own, theirs, similarity):
                    done.add(its)
                    links.append((min(node, other), max(node, other)))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    blocks = asking.unionByName(asked).join(whole, "node").groupBy("key", "mine", "theirs")
    return blocks.applyInPandas(compared, "a long, b long")


def representatives(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shingle: int = SHINGLE,
    similarity: float | None = None,
) -> DataFrame:
    """One row of every group with its own columns: the one with the smallest id.

    Groups are those of ``near_duplicates``, or of ``similar`` where a similarity is given.

    A missing id comes last; rows that agree in id and group are told apart by a hash of all
    columns, and rows that agree in every column are one.
    """
    member = F.struct(F.col("id").isNull().alias("last"), "id", "tie", "times")
    if similarity is None:
        found = near_duplicates(docs, text, key, shingle)
    else:
        found = similar(docs, text, key, shingle, similarity)
    chosen = cut(
        found.groupBy("root", "id", "tie")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("root")
        .agg(F.min(member).alias("best"))
        .select("best.id", "best.tie", "best.times")
    )
    rows = packed(docs).select(
        "row", F.col(f"row.`{key}`").alias("id"), row_tie(docs.columns).alias("tie")
    )

    def met(wanted: DataFrame) -> DataFrame:
        same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.tie") == F.col("b.tie"))
        return rows.alias("a").join(wanted.alias("b"), same, "left_semi")

    # Only rows that occur several times are dealt out again, to keep one.
    first = W.partitionBy("id", "tie").orderBy(F.lit(1))
    several = (
        met(chosen.where("times > 1"))
        .withColumn("place", F.row_number().over(first))
        .where("place = 1")
    )
    kept = met(chosen.where("times = 1")).select("row").unionByName(several.select("row"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    return near_duplicates(docs, text, key).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
