"""Byte-level BPE by backtracking over longest vocabulary matches, and its inverse.

A sequence of tokens is the one that rank-ordered merging would give exactly if every pair of
neighbours is: merging the bytes of the pair alone must give the pair back. So the encoder needs
no merging of whole words. All vocabulary entries in a piece are found in one pass of an
Aho-Corasick automaton over its bytes, read as Latin-1 characters; from the left the longest
match is tried that fits the token before it, shorter ones next, and a position from which
nothing fits is marked and never tried again. Whether two tokens fit is remembered. The work is
linear in the piece.

The rank file is read once on the driver and travels with the tasks; each Python worker builds
the automaton once. Memories of pieces and pairs are bounded and start anew when full.

Defined cases: a missing text is empty and has no tokens; ids and further columns are carried or
ignored but never read; repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import content, packed

MOST_PIECES = 300_000
MOST_PAIRS = 400_000
#: Pieces longer than this are not remembered.
LONG_PIECE = 64
#: Bytes of text per Arrow batch handled at once.
BATCH_ROWS = 256


class Encoder:
    """Encodes pieces of text by the ranks of a vocabulary; one per Python worker."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        import ahocorasick
        import regex

        lines = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.packed = {rank: rank.to_bytes(4, "little") for rank in self.token}
        self.fits: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.wide = re.compile(r"^ |  |\s | \s| $").search
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            # An entry that merging never forms cannot stand inside a sequence.
            if len(token) < 3 or self._merge(token) == [rank]:
                self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()

    def _merge(self, data: bytes) -> list[int]:
        """Plain rank-ordered merging; used on two tokens at most."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _fit(self, left: int, right: int) -> bool:
        found = self._merge(self.token[left] + self.token[right]) == [left, right]
        if len(self.fits) >= MOST_PAIRS:
            self.fits.clear()
        self.fits[left, right] = found
        return found

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size = len(data)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for end, match in self.automaton.iter(data.decode("latin-1")):
            starts[end + 1 - match[0]].append(match)  # by rising length
        fits = self.fits
        tokens: list[int] = []
        lengths: list[int] = []
        at = 0
        while at < size:
            left = tokens[-1] if tokens else -1
            # The tokens up to here are the only ones for these bytes, so a position from which
            # nothing fits is dead whatever came before: its list of matches is emptied.
            for length, rank in reversed(starts[at]):
                after = at + length
                if after < size and not starts[after]:
                    continue
                if left >= 0:
                    fit = fits.get((left, rank))
                    if not (self._fit(left, rank) if fit is None else fit):
                        continue
                tokens.append(rank)
                lengths.append(length)
                at = after
                break
            else:
                starts[at] = []
                tokens.pop()
                at -= lengths.pop()
        return tokens

    def _pieces(self, text: str) -> bytes:
        pieces, name = self.pieces, self.packed
        found = []
        for piece in self.find(text):
            ids = pieces.get(piece)
            if ids is None:
                ids = b"".join([name[t] for t in self.encode_piece(piece.encode())])
                if len(piece) <= LONG_PIECE:
                    if len(pieces) >= MOST_PIECES:
                        pieces.clear()
                    pieces[piece] = ids
            found.append(ids)
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Token ids of a text as little-endian unsigned 32-bit integers.

        A space between two characters that are no white space always starts a piece. Texts in
        which every space is such a one are therefore split there, and what stands between two
        spaces is remembered as a whole; other texts go through the pattern from end to end.
        """
        if self.wide(text) is not None:
            return self._pieces(text)
        first, *rest = text.split(" ")
        chunks = self.chunks
        found = [self._pieces(first)]
        for chunk in rest:
            ids = chunks.get(chunk)
            if ids is None:
                ids = self._pieces(" " + chunk)
                if len(chunk) <= LONG_PIECE:
                    if len(chunks) >= MOST_PIECES:
                        chunks.clear()
                    chunks[chunk] = ids
            found.append(ids)
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I")))


_encoders: dict[bytes, Encoder] = {}


def _encoder(rank_file: bytes, pattern: str) -> Encoder:
    key = hashlib.sha256(rank_file + pattern.encode()).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(rank_file, pattern)
    return _encoders[key]


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _rows(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    own = F.struct(*[F.col(f"row.`{c}`").alias(c) for c in columns]).alias("row")
    return packed(docs).select(own, content(text).alias("content"))


def _encoded(
    docs: DataFrame,
    rank_file: bytes,
    pattern: str,
    text: str,
    columns: list[str],
    outputs: dict[str, tuple[str, pa.DataType, Callable[[Encoder, bytes], object]]],
) -> DataFrame:
    """The given columns and, for every output, a function of the ids: one pass, one text at a
    time, so a task holds one text's ids besides the batch."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(rank_file, pattern)
        for batch in stream:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                found: list[list] = [[] for _ in outputs]
                for value in part.column("content"):
                    ids = encoder.encode(value.as_py())
                    for column, (_, _, use) in zip(found, outputs.values()):
                        column.append(use(encoder, ids))
                arrays = [pa.array(x, k) for x, (_, k, _) in zip(found, outputs.values())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), *arrays], names=["row", *outputs]
                )

    rows = _rows(docs, columns, text)
    fields = [T.StructField(n, _KINDS[k]) for n, (k, _, _) in outputs.items()]
    return rows.mapInArrow(batches, T.StructType([rows.schema["row"], *fields]))


_KINDS = {"long": T.LongType(), "string": T.StringType(), "binary": T.BinaryType()}
_COUNT = ("long", pa.int64(), lambda encoder, ids: len(ids) // 4)


def encode(
    docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``doc_id, ids, decoded``: little-endian ids as bytes, and the bytes they decode to."""
    outputs = {
        "ids": ("binary", pa.binary(), lambda encoder, ids: ids),
        "decoded": ("binary", pa.binary(), lambda encoder, ids: encoder.decode(ids)),
    }
    found = _encoded(docs, rank_file, pattern, text, [key], outputs)
    return found.select(F.col(f"row.`{key}`").alias("doc_id"), "ids", "decoded")


def digests(
    docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``; ids and decoded texts stay in Python."""

    def ids_hash(encoder: Encoder, ids: bytes) -> str:
        return hashlib.sha256(ids).hexdigest()

    def text_hash(encoder: Encoder, ids: bytes) -> str:
        return hashlib.sha256(encoder.decode(ids)).hexdigest()

    outputs = {
        "n_tokens": _COUNT,
        "ids_sha256": ("string", pa.string(), ids_hash),
        "decoded_sha256": ("string", pa.string(), text_hash),
    }
    found = _encoded(docs, rank_file, pattern, text, [key], outputs)
    return found.select(F.col(f"row.`{key}`").alias("doc_id"), *outputs)


def tokenized(
    docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text"
) -> DataFrame:
    """The columns of the input, ``n_tokens`` and ``token_ids`` (little-endian, four bytes each).

    Columns of these names in the input give way.
    """

    outputs = {
        "n_tokens": _COUNT,
        "token_ids": ("binary", pa.binary(), lambda encoder, ids: ids),
    }
    kept = [c for c in docs.columns if c not in outputs]
    found = _encoded(docs, rank_file, pattern, text, kept, outputs)
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *outputs)
