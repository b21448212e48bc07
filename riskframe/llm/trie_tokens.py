"""Unigram token counts of texts by dynamic programming over a trie of pre-tokens.

A pre-token is a word with the word mark before it. Its tokenisation is the one with the largest
sum of piece scores; a character that no piece covers is spelled in bytes, one token each, at
``BYTE_PENALTY`` below the worst piece. Pre-tokens are inserted in a trie whose nodes carry the
best forward score of their prefix and its token count, computed when the node is made from the
at most ``longest piece`` nodes above it. So a prefix shared by many pre-tokens is scored once,
and a pre-token met before costs a lookup of the count at its end.

Piece scores come from the vocabulary file; a model without probabilities orders its pieces, and
then a piece's score is the logarithm of Zipf's law at its rank. Scores are whole micro-units, so
sums are exact; of equal sums the one with fewer tokens counts.

A trie is kept per Python worker and starts anew when it reaches ``MOST_NODES``; a word that would
fill half of it is walked with the scores of the last prefixes alone. This bounds memory and
changes no count.

Defined cases: a missing text is empty and has no tokens; ids are carried, further columns play
no part; repeated rows are counted each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import content, packed

WORD_MARK = "▁"
BYTE_PENALTY = 10_000_000
MOST_NODES = 1_000_000
MOST_WORDS = 300_000
LONG_WORD = 64
CHARACTERS = 0x110000


def zipf_scores(ordered_pieces: list[str]) -> dict[str, int]:
    """Score of every piece, in millionths, from its rank in the list."""
    total = math.log(sum(1 / rank for rank in range(1, len(ordered_pieces) + 1)))
    return {
        piece: round(-1_000_000 * (math.log(rank) + total))
        for rank, piece in enumerate(ordered_pieces, 1)
    }


def read_pieces(path: str) -> dict[str, int]:
    """Scores of the ordinary pieces of a SentencePiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    ordinary.sort(key=lambda i: (-model.get_score(i), i))
    return zipf_scores([model.id_to_piece(i) for i in ordinary])


class Trie:
    """Forward scores and token counts of all prefixes of the pre-tokens inserted so far."""

    def __init__(self, pieces: dict[str, int], most_nodes: int = MOST_NODES) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.spelled = min(pieces.values(), default=0) - BYTE_PENALTY
        self.most_nodes = most_nodes
        # Lengths of the pieces that end in one or two given characters: few, of all lengths there are.
        lengths: dict[str, set[int]] = {}
        for piece in pieces:
            lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {ending: tuple(sorted(found)) for ending, found in lengths.items()}
        self.words: dict[str, tuple[int, int, int]] = {}
        self._clear()

    def _clear(self) -> None:
        # (node, character) as one number -> node.
        self.next: dict[int, int] = {}
        self.score = [0]
        self.count = [0]
        self.bytes = [0]

    def _grow(self, word: str, path: list[int]) -> int:
        """Node for the next character of ``word`` after the nodes of ``path``."""
        end = len(path)
        char = word[end - 1]
        size = 1 if char < "\x80" else len(char.encode())
        last = path[-1]
        pieces, scores, counts = self.pieces, self.score, self.count
        score, count = scores[last] + self.spelled * size, counts[last] + size
        spelled = self.bytes[last] + size
        for start in self._starts(word, end):
            own = pieces.get(word[start:end])
            if own is not None:
                node = path[start]
                own += scores[node]
                if own >= score:
                    tokens, in_bytes = counts[node] + 1, self.bytes[node]
                    if own > score or (tokens, in_bytes) < (count, spelled):
                        score, count, spelled = own, tokens, in_bytes
        scores.append(score)
        counts.append(count)
        self.bytes.append(spelled)
        made = len(self.score) - 1
        self.next[last * CHARACTERS + ord(char)] = made
        return made

    def _starts(self, word: str, end: int) -> list[int]:
        """Where a piece that ends at ``end`` can start."""
        found = [end - 1] if word[end - 1] in self.pieces else []
        if end > 1:
            found += [end - n for n in self.lengths.get(word[end - 2 : end], ()) if n <= end]
        return found

    def _walk(self, word: str) -> tuple[int, int, int]:
        """The same as ``insert`` without nodes: the scores of the last ``longest`` prefixes are kept."""
        kept = [(0, 0, 0)] * (self.longest + 1)  # score, -tokens, bytes of a prefix, by its length
        size = len(kept)
        for end in range(1, len(word) + 1):
            score, tokens, spelled = kept[(end - 1) % size]
            own_bytes = len(word[end - 1].encode())
            best, spelled = (score + self.spelled * own_bytes, tokens - own_bytes), spelled + own_bytes
            for start in self._starts(word, end):
                own = self.pieces.get(word[start:end])
                if own is not None:
                    before, tokens, bytes_ = kept[start % size]
                    found = (before + own, tokens - 1)
                    if found > best or (found == best and bytes_ < spelled):
                        best, spelled = found, bytes_
            kept[end % size] = (*best, spelled)
        score, tokens, spelled = kept[len(word) % size]
        return -tokens, spelled, score

    def insert(self, word: str) -> tuple[int, int, int]:
        """Tokens, byte tokens and score of the best tokenisation of a pre-token."""
        if len(word) > self.most_nodes // 2:
            return self._walk(word)
        if len(self.score) + len(word) > self.most_nodes:
            self._clear()
        path, end, step = [0], 0, self.next.get
        for char in word:
            known = step(end * CHARACTERS + ord(char))
            end = self._grow(word, path) if known is None else known
            path.append(end)
        return self.count[end], self.bytes[end], self.score[end]

    def lookup(self, word: str) -> tuple[int, int, int]:
        found = self.words.get(word)
        if found is None:
            found = self.insert(WORD_MARK + word)
            if len(word) <= LONG_WORD:
                if len(self.words) >= MOST_WORDS:
                    self.words.clear()
                self.words[word] = found
        return found


_tries: dict[bytes, Trie] = {}


def _trie(pieces: dict[str, int]) -> Trie:
    key = hashlib.sha256(repr(sorted(pieces.items())).encode()).digest()
    if key not in _tries:
        _tries.clear()
        _tries[key] = Trie(pieces)
    return _tries[key]


def words(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


def count_tokens(
    docs: DataFrame, pieces: dict[str, int], text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_byte_tokens, score`` (score in nats)."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(pieces)
        for batch in stream:
            column = batch.column("content")
            found = []
            for i in range(batch.num_rows):
                each = [trie.lookup(w) for w in words(column[i].as_py())]
                sums = [sum(x) for x in zip(*each)] if each else [0, 0, 0]
                found.append((len(each), *sums))
            n_words, n_tokens, n_bytes, score = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(n_bytes, pa.int64()),
                    pa.array([s / 1e6 for s in score], pa.float64()),
                ],
                names=["doc_id", "n_words", "n_tokens", "n_byte_tokens", "score"],
            )

    rows = packed(docs).select(F.col(f"row.`{key}`").alias("doc_id"), content(text).alias("content"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        batches,
        f"doc_id {kind}, n_words long, n_tokens long, n_byte_tokens long, score double",
    )
