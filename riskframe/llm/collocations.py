"""Phrases whose words occur together more often than their parts would by chance.

Counting follows Rabin and Karp: prefix polynomials over word hashes give the fingerprint of
every n-gram of a chunk of texts in NumPy. Chunks send half fingerprints with their counts to
buckets (see ``chunks``), which add them up and answer each chunk which of its own may reach
``least``. Words and pairs go first; longer n-grams are sent only where each of their pairs is
frequent, which loses none, as a phrase is no more frequent than its parts. What remains is
looked up in the texts: a chunk groups the occurrences, compares each with the first of its group
word by word, and sends counts under the half fingerprint and a second, independent one; with the
bucket's number they hold over 64 bits. The bucket adds up again, and of the chunks that hold a frequent phrase one is asked to spell it:
the chunk is the pointer to the occurrence. Only frequent phrases become text.

Everything is per language. Equal texts of one language meet in one chunk and are read once.

Scores are exact: products are decimals of up to 38 digits (phrase counts below 10^16, words of a
language below 10^18) and are divided as integers.

Defined cases: a missing text is empty; a missing language is ``und`` and the same as a language
of that name; only A-Z are lower-cased; other columns are never read; ties are broken by count
and then by the bytes of the phrase; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm import chunks
from riskframe.llm.common import content, cut, packed

LONGEST = 5
LEAST = 100
TOP = 2000
#: A phrase goes if a longer one holds it and has at least so many percent of its count.
HELD_PERCENT = 100
#: Tasks that a language's word total is copied to.
SPREAD = 64
SHORT, LONG, WEIGHED = 0, 1, 2
# What ends a piece, and the one blank besides the space.
ENDS = b".,;:!?\n\x0b\x0c\r"
TO_LINES = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")

DOC = "chunk long, lang string, body binary, times long"
DOC_ARROW = pa.schema(
    [("chunk", pa.int64()), ("lang", pa.string()), ("body", pa.binary()), ("times", pa.int64())]
)
FOUND = "lang string, size int, phrase string, times long"
FOUND_ARROW = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("times", pa.int64())]
)


def lines(text: str) -> bytes:
    """Lower-cased text with one piece per line."""
    return text.encode().lower().translate(TO_LINES)


def _dealt(docs: DataFrame, text: str, lang: str, count: int) -> DataFrame:
    rows = packed(docs).select(
        content(text).alias("content"), F.coalesce(F.col(f"row.`{lang}`"), F.lit("und")).alias("lang")
    )

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in stream:
            times: dict[tuple[str, str], int] = {}
            for pair in zip(batch.column("lang").to_pylist(), batch.column("content").to_pylist()):
                times[pair] = times.get(pair, 0) + 1
            found = [
                (xxh3_64_intdigest(t) % count, name, chunks.squeezed(lines(t)), n)
                for (name, t), n in times.items()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in found], f.type) for i, f in enumerate(DOC_ARROW)],
                schema=DOC_ARROW,
            )

    return rows.mapInArrow(batches, DOC)


class Words:
    """The words of a chunk in one language, every piece apart from the next."""

    def __init__(self, lang: str, texts: list[tuple[bytes, int]]):
        from xxhash import xxh3_64_intdigest

        words: list[bytes] = []
        sizes: list[int] = []
        weights: list[int] = []
        for body, times in texts:
            for line in chunks.spread(body).split(b"\n"):
                own = line.split()
                if own:
                    words += own
                    sizes.append(len(own))
                    weights.append(times)
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.names = coded.dictionary.to_pylist()
        self.ids = coded.indices.to_numpy().astype(np.int32)
        self.weights = np.repeat(np.array(weights, np.int64), sizes)
        # Words left in the piece, the word itself included.
        ends = np.repeat(np.cumsum(sizes), sizes) if sizes else np.zeros(0, np.int64)
        self.left = ends - np.arange(len(self.ids))
        seed = xxh3_64_intdigest(lang.encode())
        self.prefixes, self.checks = (
            chunks.Prefixes(np.array([xxh3_64_intdigest(w, s) for w in self.names], np.uint64)[self.ids])
            for s in (seed, seed ^ (1 << 63))
        )

    def prints(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and fingerprints of the n-grams of one size."""
        at = np.flatnonzero(self.left >= size)
        return at, self.prefixes.at(size, at)

    def second(self, size: int, at: np.ndarray) -> np.ndarray:
        """Another 32 bits of the n-grams at the given starts."""
        return self.checks.at(size, at) >> np.uint64(32)


def _by_lang(docs: pa.Table) -> Iterator[tuple[str, Words]]:
    texts: dict[str, dict[bytes, int]] = {}
    for lang, body, times in zip(*(docs.column(c).to_pylist() for c in ("lang", "body", "times"))):
        own = texts.setdefault(lang, {})
        own[body] = own.get(body, 0) + times
    for lang, own in sorted(texts.items()):
        yield lang, Words(lang, list(own.items()))


def _totals(prints: list[np.ndarray], weights: list[np.ndarray], buckets: int) -> Iterator[tuple[int, bytes]]:
    """Distinct halves of every bucket: those counted once, then the others with their counts."""
    if not prints:
        return
    halves, weights = chunks.halves(np.concatenate(prints), buckets), np.concatenate(weights)
    if not len(halves):
        return
    order = np.argsort(halves)
    halves = halves[order]
    runs = np.flatnonzero(np.concatenate([[True], halves[1:] != halves[:-1]]))
    seen, times = halves[runs], np.add.reduceat(weights[order], runs)
    for bucket, part in chunks.parts_of(seen):
        low = (seen[part] & np.uint64(0xFFFFFFFF)).astype("<u4")
        own = times[part]
        once = own == 1
        yield bucket, (
            np.array([once.sum()], "<u4").tobytes()
            + low[once].tobytes()
            + low[~once].tobytes()
            + own[~once].astype("<i8").tobytes()
        )


def _opened(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    once = int(np.frombuffer(payload, "<u4", 1)[0])
    more = (len(payload) - 4 - 4 * once) // 12
    low = np.frombuffer(payload, "<u4", once + more, 4)
    times = np.frombuffer(payload, "<i8", more, 4 + 4 * (once + more))
    return low, np.concatenate([np.ones(once, np.int64), times])


def _frequent(kind: int, least: int):
    def add_up(name: tuple, sent: pa.Table) -> pa.Table:
        low, times = zip(*map(_opened, sent.column("payload").to_pylist()))
        sizes = [len(x) for x in low]
        values, times = np.concatenate(low), np.concatenate(times)
        seen, inverse = np.unique(values, return_inverse=True)
        total = np.zeros(len(seen), np.int64)
        np.add.at(total, inverse, times)
        enough = (total >= least)[inverse]
        ends = np.cumsum(sizes)
        kept = [(c, values[e - n : e][enough[e - n : e]]) for c, n, e in zip(sent.column("chunk").to_pylist(), sizes, ends)]
        return chunks.answers(
            name[0].as_py(), kind, [(c, v.astype("<u4").tobytes()) for c, v in kept if len(v)]
        )

    return add_up


def _frequent_pairs(words: Words, short: np.ndarray, buckets: int) -> np.ndarray:
    """Which starts begin a frequent pair; one place longer than the words."""
    at, prints = words.prints(2)
    frequent = np.zeros(len(words.ids) + 1, bool)
    frequent[at] = chunks.among(chunks.halves(prints, buckets), short)
    return frequent


def _long_starts(words: Words, frequent: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sizes above two with the starts of n-grams whose pairs are all frequent."""
    good = frequent[:-1]
    for size in range(3, longest + 1):
        # The pairs of a start are those of the shorter n-gram and one more.
        good = good[:-1] & frequent[size - 2 : size - 2 + len(good) - 1] if len(good) else good
        yield size, np.flatnonzero(good & (words.left[: len(good)] >= size))


def _found(words: Words, at: np.ndarray, size: int, prints: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fingerprint, check, first start and count of the distinct n-grams at the given starts.

    Every occurrence is compared with the first one of its group, word by word.
    """
    checks = words.second(size, at)
    order = np.argsort(prints)
    if ((prints[order][1:] == prints[order][:-1]) & (checks[order][1:] != checks[order][:-1])).any():
        order = np.lexsort((checks, prints))
    a, b = prints[order], checks[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(fresh) - 1
    runs = np.flatnonzero(fresh)
    pointer = at[order][runs]
    for j in range(size):
        if (words.ids[at[order] + j] != words.ids[pointer[group] + j]).any():
            raise ValueError("two phrases share both fingerprints")
    times = np.zeros(len(runs), np.int64)
    np.add.at(times, group, words.weights[at[order]])
    return a[runs], b[runs], pointer, times


def _starts(words: Words, short: np.ndarray, long: np.ndarray, buckets: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sizes, starts and fingerprints of the n-grams that buckets named."""
    # Single words are looked up once each, wherever they occur.
    once = np.zeros(len(words.names), np.int64)
    once[words.ids] = np.arange(len(words.ids))
    known = chunks.among(chunks.halves(words.prefixes.at(1, once), buckets), short)
    frequent = _frequent_pairs(words, short, buckets)
    named = [(1, np.flatnonzero(known[words.ids])), (2, np.flatnonzero(frequent))]
    for size, at in _long_starts(words, frequent, longest):
        named.append((size, at[chunks.among(chunks.halves(words.prefixes.at(size, at), buckets), long)]))
    for size, at in named:
        if len(at):
            yield size, at, words.prefixes.at(size, at)


def _closed(low: np.ndarray, checks: np.ndarray, times: np.ndarray) -> bytes:
    """Counts that fit a byte first, each in one byte."""
    order = np.argsort(times > 255, kind="stable")
    low, checks, times = low[order], checks[order], times[order]
    few = int((times <= 255).sum())
    return (
        np.array([len(low), few], "<u4").tobytes() + low.astype("<u4").tobytes()
        + checks.astype("<u4").tobytes() + times[:few].astype("u1").tobytes()
        + times[few:].astype("<i8").tobytes()
    )


def _checked(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, few = np.frombuffer(payload, "<u4", 2).tolist()
    times = np.frombuffer(payload, "u1", few, 8 + 8 * n).astype(np.int64)
    more = np.frombuffer(payload, "<i8", n - few, 8 + 8 * n + few)
    return (
        np.frombuffer(payload, "<u4", n, 8),
        np.frombuffer(payload, "<u4", n, 8 + 4 * n),
        np.concatenate([times, more]),
    )


def _pointed(least: int):
    """Add up counts by both fingerprints; one of the chunks that hold a phrase is to spell it."""

    def add_up(name: tuple, sent: pa.Table) -> pa.Table:
        low, checks, times = (np.concatenate(x) for x in zip(*map(_checked, sent.column("payload").to_pylist())))
        sizes = [len(_checked(p)[0]) for p in sent.column("payload").to_pylist()]
        senders = np.repeat(np.array(sent.column("chunk").to_pylist(), np.int64), sizes)
        # Any of the holders, so that no chunk spells most phrases.
        turn = chunks.mixed(checks.astype(np.uint64) ^ chunks.mixed(senders.astype(np.uint64)))
        order = np.lexsort((turn, checks, low))
        a, b = low[order], checks[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        runs = np.flatnonzero(fresh)
        total = np.add.reduceat(times[order], runs)
        frequent = runs[total >= least]
        total, holder = total[total >= least], senders[order][frequent]
        found = []
        for chunk in np.unique(holder).tolist():
            own = holder == chunk
            found.append((chunk, _closed(a[frequent][own], b[frequent][own], total[own])))
        return chunks.answers(name[0].as_py(), WEIGHED, found)

    return add_up


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
) -> DataFrame:
    """``lang, size, phrase, times``: phrases of up to ``longest`` words with ``least`` occurrences.

    A row of size 0 holds the number of words of the language.
    """
    spark = docs.sparkSession
    buckets = chunks.bucket_count(spark)
    dealt = chunks.cut_by(_dealt(docs, text, lang, chunks.chunk_count(spark)), "chunk")
    by_chunk = dealt.groupBy("chunk")

    def short(name: tuple, own: pa.Table) -> pa.Table:
        prints, weights = [], []
        for _, words in _by_lang(own):
            for size in (1, 2):
                at, found = words.prints(size)
                prints.append(found)
                weights.append(words.weights[at])
        return chunks.letters(name[0].as_py(), _totals(prints, weights, buckets))

    heard = by_chunk.applyInArrow(short, chunks.LETTERS).groupBy("bucket")
    told = cut(heard.applyInArrow(_frequent(SHORT, least), chunks.ANSWERS))

    def long(name: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        pairs = chunks.answered(told, SHORT)
        prints, weights = [], []
        for _, words in _by_lang(own):
            frequent = _frequent_pairs(words, pairs, buckets)
            for size, at in _long_starts(words, frequent, longest):
                prints.append(words.prefixes.at(size, at))
                weights.append(words.weights[at])
        return chunks.letters(name[0].as_py(), _totals(prints, weights, buckets))

    heard = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(long, chunks.LETTERS)
    more = heard.groupBy("bucket").applyInArrow(_frequent(LONG, least), chunks.ANSWERS)
    every = cut(told.unionByName(more))

    def weigh(name: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        short, long = chunks.answered(told, SHORT), chunks.answered(told, LONG)
        found = [
            _found(words, at, size, prints)
            for _, words in _by_lang(own)
            for size, at, prints in _starts(words, short, long, buckets, longest)
        ]
        if not found:
            return chunks.letters(name[0].as_py(), [])
        prints, checks, _, times = (np.concatenate(x) for x in zip(*found))
        halves = chunks.halves(prints, buckets)
        order = np.argsort(halves, kind="stable")
        halves, checks, times = halves[order], checks[order], times[order]
        low = halves & np.uint64(0xFFFFFFFF)
        return chunks.letters(
            name[0].as_py(),
            [(b, _closed(low[p], checks[p], times[p])) for b, p in chunks.parts_of(halves)],
        )

    heard = by_chunk.cogroup(every.groupBy("chunk")).applyInArrow(weigh, chunks.LETTERS)
    pointed = heard.groupBy("bucket").applyInArrow(_pointed(least), chunks.ANSWERS)
    # Every chunk counts its words, asked or not.
    pointers = cut(pointed)

    def spell(name: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        asked: dict[tuple[int, int], int] = {}
        for kind, bucket, payload in zip(*(told.column(c).to_pylist() for c in ("kind", "bucket", "payload"))):
            if kind == WEIGHED:
                low, checks, times = _checked(payload)
                names = (low.astype(np.uint64) | (np.uint64(bucket) << np.uint64(32))).tolist()
                asked.update(zip(zip(names, checks.tolist()), times.tolist()))
        wanted = np.sort(np.array([check for _, check in asked], np.uint64))
        # Most starts are told by twenty bits of their check alone.
        seen = np.zeros(1 << 20, bool)
        seen[wanted & np.uint64(0xFFFFF)] = True
        out: dict[str, list] = {f.name: [] for f in FOUND_ARROW}

        def add(*row) -> None:
            for column, value in zip(out, row):
                out[column].append(value)

        for lang_, words in _by_lang(own):
            if len(words.ids):
                add(lang_, 0, "", int(words.weights.sum()))
            for size in range(1, longest + 1):
                at = np.flatnonzero(words.left >= size)
                checks = words.second(size, at)
                maybe = np.flatnonzero(seen[checks & np.uint64(0xFFFFF)])
                at = at[maybe[chunks.among(checks[maybe], wanted)]]
                if not len(at):
                    continue
                prints, checks, pointer, _ = _found(words, at, size, words.prefixes.at(size, at))
                halves = chunks.halves(prints, buckets).tolist()
                for half, check, start in zip(halves, checks.tolist(), pointer.tolist()):
                    times = asked.get((half, check))
                    if times is not None:
                        parts = [words.names[i] for i in words.ids[start : start + size]]
                        add(lang_, size, b" ".join(parts).decode(), times)
        return chunks.table(out, FOUND_ARROW)

    spelled = by_chunk.cogroup(pointers.groupBy("chunk")).applyInArrow(spell, FOUND)
    return spelled.groupBy("lang", "size", "phrase").agg(F.sum("times").alias("times"))


def scores(found: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, size, phrase, a, l, r, n, score`` of every phrase of two words or more."""
    counts = found.where("size > 0").select("lang", "phrase", "times")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("copy")
    words = found.where("size = 0").select("lang", F.col("times").alias("n"), copies)
    parts = F.split("phrase", " ")
    cuts = (
        found.where("size > 1")
        .select(
            "lang", "size", "phrase", F.col("times").alias("a"), parts.alias("parts"),
            F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
        )
        .select(
            "lang", "size", "phrase", "a", "k",
            F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("head"),
            F.array_join(F.slice("parts", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"),
        )
    )
    met = (
        cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("times").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("times").alias("r")), ["lang", "tail"])
        .withColumn("copy", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)).cast("int"))
        .join(words, ["lang", "copy"])
    )
    exact = F.expr(
        "(cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0)))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    least = F.min(F.struct(exact.alias("score"), "k", "l", "r", "n")).alias("least")
    return met.groupBy("lang", "size", "phrase", "a").agg(least).select(
        "lang", "size", "phrase", "a", "least.l", "least.r", "least.n", "least.score"
    )


def not_held(scored: DataFrame, percent: int = HELD_PERCENT) -> DataFrame:
    """Without phrases that a longer one holds with ``percent`` of their count or more."""
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1),"
        " s -> array_join(slice(split(phrase, ' '), s, w), ' '))))"
    )
    holders = (
        scored.where("size > 2")
        .select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("held"))
        .groupBy("lang", "phrase")
        .agg(F.max("held").alias("held"))
    )
    met = scored.join(holders, ["lang", "phrase"], "left")
    return met.where(F.col("held").isNull() | (100 * F.col("held") < percent * F.col("a"))).drop("held")


def report(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """The ``top`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``."""
    found = cut(frequent_phrases(docs, text, lang))
    kept = not_held(cut(scores(found)))
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        kept.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
    )
