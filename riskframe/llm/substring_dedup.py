"""Repeated passages: every window of words that starts earlier elsewhere is removed.

Anchors: the words of each distinct text are cut into reference blocks of ``BLOCK`` words that do
not overlap, and the blocks are indexed; every rolling window of ``BLOCK`` words of every text
probes the index. A passage of ``WINDOW`` words holds a whole reference block wherever it starts
(WINDOW >= 2 * BLOCK - 1), so passages that occur twice always meet. Hits are extended to all
passages of ``WINDOW`` words around them; of passages with equal words, told by 128 bits, the
earliest stays and the others are covered. Overlapping covered passages join to maximal repeats.

Order: documents are dealt into chunks by ranges of (id, row hash), so a bucket of the exchange
(see ``chunks``) tells the earlier occurrence from the number of the chunk alone; inside a chunk
the order is known. Only firsts are named, one per distinct passage, so a passage that a third of
all documents share costs a bucket one entry per chunk. Texts with equal words are one text in all
of this: of such documents all but the earliest are repeats as a whole.

Defined cases: a missing text has no words; documents with fewer than ``WINDOW`` words keep
all; a missing id comes after all others; rows of one id are in the order of a hash over all
columns; rows that agree in every column are one document and have one result each; an empty
table gives an empty result; other columns, whatever their names, only enter that hash. The key
is an integer.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import chunks
from riskframe.llm.common import content, cut, packed, row_tie

WINDOW = 20
BLOCK = 10
#: Kinds of answers: documents whose words no earlier one has; shared halves; masks of firsts.
FIRST_TEXT, SHARED, FIRST_PASSAGE = 0, 1, 2
LAST = (1 << 63) - 1


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    id_ = F.col(f"row.`{key}`").cast("long")
    return packed(docs).select(
        id_.alias("id"),
        F.coalesce(id_, F.lit(LAST)).alias("place"),
        row_tie(docs.columns).alias("tie"),
        content(text).alias("content"),
    )


def _edges(rows: DataFrame, count: int) -> list[tuple[int, int]]:
    """First (place, tie) of every chunk but the first: at most as many as there are chunks."""
    ranged = rows.select("place", "tie").repartitionByRange(count, "place", "tie")
    least = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("place", "tie")).alias("least"))
    return sorted((r.least.place, r.least.tie) for r in least.collect())[1:]


def _dealt(rows: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    """Chunks of documents with compressed words; rows of a batch that agree are one."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for batch in stream:
            found: dict[tuple[int, int], list] = {}
            for i in range(batch.num_rows):
                name = (batch.column("place")[i].as_py(), batch.column("tie")[i].as_py())
                if name in found:
                    found[name][-1] += 1
                    continue
                words = batch.column("content")[i].as_py().encode().split()
                body = b" ".join(words)
                digest = blake2b(body, digest_size=32).digest()
                found[name] = [
                    bisect_right(edges, name), batch.column("id")[i].as_py(), *name, digest,
                    len(words), chunks.squeezed(body), 1,
                ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found.values()), DOC_ARROW)]
                if found else [pa.array([], f.type) for f in DOC_ARROW],
                schema=DOC_ARROW,
            )

    return rows.mapInArrow(batches, DOC)


DOC = (
    "chunk long, id long, place long, tie long, digest binary, words long, body binary, times long"
)
DOC_ARROW = pa.schema(
    [("chunk", pa.int64()), ("id", pa.int64()), ("place", pa.int64()), ("tie", pa.int64()),
     ("digest", pa.binary()), ("words", pa.int64()), ("body", pa.binary()), ("times", pa.int64())]
)
FIRSTS = "chunk long, kind int, bucket long, payload binary"


class Chunk:
    """The documents of one chunk in order, and the windows of those that are first texts."""

    def __init__(self, docs: pa.Table, told: pa.Table):
        rows = docs.select(["place", "tie", "id", "words", "body", "times"]).to_pylist()
        rows.sort(key=lambda r: (r["place"], r["tie"]))
        self.rows: list[dict] = []
        for r in rows:
            if self.rows and (r["place"], r["tie"]) == (self.rows[-1]["place"], self.rows[-1]["tie"]):
                self.rows[-1]["times"] += r["times"]
            else:
                self.rows.append(r)
        firsts = {
            payload
            for kind, payload in zip(told.column("kind").to_pylist(), told.column("payload").to_pylist())
            if kind == FIRST_TEXT
        }
        for r in self.rows:
            name = np.array([r["place"], r["tie"]], "<i8").tobytes()
            r["first"] = name in firsts
        self.read = [r for r in self.rows if r["first"] and r["words"] >= WINDOW]
        self.hashes = [_word_hashes(chunks.spread(r["body"])) for r in self.read]

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all rolling blocks, and which of them are reference blocks."""
        found = [chunks.Prefixes(h[:, 0]).windows(BLOCK) for h in self.hashes]
        marks = [np.arange(len(f)) % BLOCK == 0 for f in found]
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        return np.concatenate(found), np.concatenate(marks)

    def passages(self, shared: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
        """Document, start and two fingerprints of the passages around all hits."""
        owner, start, one, two = [], [], [], []
        for i, h in enumerate(self.hashes):
            first = chunks.Prefixes(h[:, 0])
            hit = chunks.among(chunks.halves(first.windows(BLOCK), buckets), shared)
            if not hit.any():
                continue
            # A passage from s on holds the blocks from s to s + WINDOW - BLOCK.
            heard = np.concatenate([[0], np.cumsum(hit)])
            at = np.flatnonzero(heard[WINDOW - BLOCK + 1 :] - heard[: len(h) - WINDOW + 1])
            owner.append(np.full(len(at), i, np.int32))
            start.append(at.astype(np.int32))
            one.append(first.windows(WINDOW)[at])
            two.append(chunks.Prefixes(h[:, 1]).windows(WINDOW)[at])
        if not owner:
            none = np.zeros(0, np.uint64)
            return np.zeros(0, np.int32), np.zeros(0, np.int32), none, none
        return tuple(np.concatenate(x) for x in (owner, start, one, two))


def _word_hashes(body: bytes) -> np.ndarray:
    """128 bits of every word, as two columns."""
    from xxhash import xxh3_128_digest

    joined = b"".join(map(xxh3_128_digest, body.split(b" ")))
    return np.frombuffer(joined, "<u8").reshape(-1, 2)


def _grouped(one: np.ndarray, two: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket and fingerprint, starts of equal runs in it, bucket of every run."""
    bucket = chunks.bucket_of(one, buckets)
    order = np.lexsort((two, one, bucket))
    a, b = one[order], two[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    runs = np.flatnonzero(fresh)
    return order, runs, bucket[order][runs]


def _bucket_runs(numbers: np.ndarray) -> Iterator[tuple[int, slice]]:
    edges = np.flatnonzero(np.diff(numbers, prepend=-1, append=-1))
    for start, stop in zip(edges[:-1], edges[1:]):
        yield int(numbers[start]), slice(int(start), int(stop))


def repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document ``id, words, removed, kept, spans``.

    ``kept`` are the words that stay, joined by single spaces; ``spans`` the maximal repeats that
    go, as (start, words) counted in words.
    """
    spark = docs.sparkSession
    buckets = chunks.bucket_count(spark)
    rows = _rows(docs, text, key)
    dealt = chunks.cut_by(_dealt(rows, _edges(rows, chunks.chunk_count(spark))), "chunk")
    by_chunk = dealt.groupBy("chunk")

    first = dealt.groupBy("digest").agg(F.min(F.struct("place", "tie", "chunk")).alias("first"))

    def named(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            names = np.stack([batch.column("place").to_numpy(), batch.column("tie").to_numpy()], 1)
            rows = [r.tobytes() for r in names.astype("<i8")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), pa.array([FIRST_TEXT] * len(rows), pa.int32()),
                 pa.array([0] * len(rows), pa.int64()), pa.array(rows, pa.binary())],
                schema=chunks.ANSWER_ARROW,
            )

    firsts = cut(first.select("first.chunk", "first.place", "first.tie").mapInArrow(named, FIRSTS))

    def index_and_probe(name: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        prints, reference = Chunk(own, told).blocks()
        seen, inverse, count = np.unique(
            chunks.halves(prints, buckets), return_inverse=True, return_counts=True
        )
        indexed = np.zeros(len(seen), bool)
        indexed[inverse[reference]] = True
        found = []
        for bucket, part in chunks.parts_of(seen):
            # In four lists: probes met once or more, then the same of reference blocks.
            kind = indexed[part] * 2 + (count[part] > 1)
            low = (seen[part] & np.uint64(0xFFFFFFFF)).astype("<u4")
            sizes = np.bincount(kind, minlength=4).astype("<u4")
            found.append((bucket, sizes.tobytes() + b"".join(low[kind == k].tobytes() for k in range(4))))
        return chunks.letters(name[0].as_py(), found)

    probes = by_chunk.cogroup(firsts.groupBy("chunk")).applyInArrow(index_and_probe, chunks.LETTERS)

    def meet(name: tuple, sent: pa.Table) -> pa.Table:
        low, who, kind = [], [], []
        for i, payload in enumerate(sent.column("payload").to_pylist()):
            sizes = np.frombuffer(payload, "<u4", 4)
            low.append(np.frombuffer(payload, "<u4", offset=16))
            who.append(np.full(len(low[-1]), i))
            kind.append(np.repeat(np.arange(4, dtype=np.int8), sizes))
        values, who, kind = (np.concatenate(x) for x in (low, who, kind))
        seen, inverse = np.unique(values, return_inverse=True)
        times = np.bincount(inverse, weights=1 + (kind & 1), minlength=len(seen))
        indexed = np.bincount(inverse, weights=kind >> 1, minlength=len(seen))
        shared = ((times > 1) & (indexed > 0))[inverse]
        senders = sent.column("chunk").to_pylist()
        values, who = values[shared], who[shared]
        order = np.argsort(who, kind="stable")
        values, counts = values[order], np.bincount(who, minlength=len(senders))
        ends = np.cumsum(counts)
        return chunks.answers(
            name[0].as_py(),
            SHARED,
            [
                (c, values[e - n : e].astype("<u4").tobytes())
                for c, n, e in zip(senders, counts, ends)
                if n
            ],
        )

    shared = probes.groupBy("bucket").applyInArrow(meet, chunks.ANSWERS)
    told = cut(firsts.unionByName(shared))

    def extend(name: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        held = Chunk(own, told)
        _, _, one, two = held.passages(chunks.answered(told, SHARED), buckets)
        order, runs, numbers = _grouped(one, two, buckets)
        pairs = np.stack([one[order][runs], two[order][runs]], 1).astype("<u8")
        return chunks.letters(
            name[0].as_py(), [(b, pairs[part].tobytes()) for b, part in _bucket_runs(numbers)]
        )

    passages = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(extend, chunks.LETTERS)

    def settle(name: tuple, sent: pa.Table) -> pa.Table:
        senders = np.array(sent.column("chunk").to_pylist())
        each = [np.frombuffer(p, "<u8").reshape(-1, 2) for p in sent.column("payload").to_pylist()]
        sizes = np.array([len(x) for x in each])
        pairs, chunk = np.concatenate(each), np.repeat(senders, sizes)
        order = np.lexsort((chunk, pairs[:, 1], pairs[:, 0]))
        a = pairs[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (a[1:] != a[:-1]).any(axis=1)
        first = np.zeros(len(order), bool)
        first[order] = fresh
        ends = np.cumsum(sizes)
        return chunks.answers(
            name[0].as_py(),
            FIRST_PASSAGE,
            [
                (int(c), np.packbits(first[e - n : e]).tobytes())
                for c, n, e in zip(senders, sizes, ends)
            ],
        )

    verdicts = passages.groupBy("bucket").applyInArrow(settle, chunks.ANSWERS)

    def strip(name: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        held = Chunk(own, told)
        owner, start, one, two = held.passages(chunks.answered(told, SHARED), buckets)
        order, runs, numbers = _grouped(one, two, buckets)
        masks = {
            b: payload
            for k, b, payload in zip(*(told.column(c).to_pylist() for c in ("kind", "bucket", "payload")))
            if k == FIRST_PASSAGE
        }
        first = np.zeros(len(runs), bool)
        for b, part in _bucket_runs(numbers):
            bits = np.unpackbits(np.frombuffer(masks[b], np.uint8), count=part.stop - part.start)
            first[part] = bits
        # The earliest of a run is the first of the stable order; it stays if its chunk is first.
        repeated = np.ones(len(order), bool)
        repeated[order[runs[first]]] = False
        owner, start = owner[repeated], start[repeated]
        by_owner = np.searchsorted(owner, np.arange(len(held.read) + 1))
        place = {id(r): i for i, r in enumerate(held.read)}
        out: dict[str, list] = {f.name: [] for f in OUT_ARROW}
        for r in held.rows:
            n, i = r["words"], place.get(id(r))
            spans = []
            if not r["first"] and n >= WINDOW:
                spans = [(0, n)]
            elif i is not None:
                at = start[by_owner[i] : by_owner[i + 1]]
                if len(at):
                    gaps = np.flatnonzero(np.diff(at) > WINDOW)
                    heads = at[np.concatenate([[0], gaps + 1])]
                    tails = at[np.concatenate([gaps, [len(at) - 1]])] + WINDOW
                    spans = list(zip(heads.tolist(), (tails - heads).tolist()))
            gone = sum(size for _, size in spans)
            if gone == n:
                kept = b""
            elif gone:
                words, kept, at = chunks.spread(r["body"]).split(b" "), [], 0
                for head, size in spans:
                    kept += words[at:head]
                    at = head + size
                kept = b" ".join(kept + words[at:])
            else:
                kept = chunks.spread(r["body"])
            row = {
                "id": r["id"], "words": n, "removed": gone, "kept": kept.decode(),
                "spans": [{"start": s, "words": w} for s, w in spans],
            }
            for column, value in row.items():
                out[column].extend([value] * r["times"])
        return chunks.table(out, OUT_ARROW)

    every = cut(told.unionByName(verdicts))
    return by_chunk.cogroup(every.groupBy("chunk")).applyInArrow(strip, OUT)


OUT = "id long, words long, removed long, kept string, spans array<struct<start:long,words:long>>"
OUT_ARROW = pa.schema(
    [("id", pa.int64()), ("words", pa.int64()), ("removed", pa.int64()), ("kept", pa.string()),
     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())])))]
)


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    return repeats(docs, text, key).select(
        F.col("id").alias("doc_id"),
        F.col("words").alias("n_words"),
        F.col("removed").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
