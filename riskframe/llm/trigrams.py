"""Boolean trigram queries that every match of a regular expression must satisfy.

A query is a list of alternatives; each is the set of trigrams that a matching text must all
contain, in lower case. ``None`` means that nothing is mandatory. Python's own parser reads the
expression; what is kept of it are runs of literal text.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser

MOST_STRINGS = 64
Query = list[frozenset[str]]
_REPEATS = (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT)


def trigram_query(pattern: str) -> Query | None:
    """Alternatives of mandatory trigrams, or None if a match need not contain any."""
    found = _Runs()
    found.sequence(_parser.parse(pattern))
    found.close()
    return found.query


class _Runs:
    """Walks a parsed expression; ``strings`` are the texts the open literal run can be."""

    def __init__(self) -> None:
        self.strings: set[str] = {""}
        self.query: Query | None = None

    def sequence(self, items) -> None:
        for kind, value in items:
            options = _options(kind, value)
            if options is not None and len(self.strings) * len(options) <= MOST_STRINGS:
                self.strings = {a + b for a in self.strings for b in options}
                continue
            self.close()
            if kind is op.SUBPATTERN:
                self.sequence(value[-1])
                self.close()
            elif kind is op.BRANCH:
                self.require(_either([trigram_query_of(x) for x in value[1]]))
            elif kind in _REPEATS and value[0] > 0:
                self.sequence(value[2])
                self.close()

    def close(self) -> None:
        """End the run: one of its strings must be there, with all of its trigrams."""
        each = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in self.strings]
        self.strings = {""}
        self.require(None if frozenset() in each else each)

    def require(self, more: Query | None) -> None:
        if more is None:
            return
        both = more if self.query is None else [a | b for a in self.query for b in more]
        self.query = [c for c in set(both) if not any(o < c for o in both)]


def trigram_query_of(items) -> Query | None:
    found = _Runs()
    found.sequence(items)
    found.close()
    return found.query


def _either(queries: list[Query | None]) -> Query | None:
    if any(q is None for q in queries):
        return None
    return [clause for q in queries for clause in q]


def _options(kind, value) -> set[str] | None:
    """All texts an item can match, in lower case, if they are few."""
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN and all(k is op.LITERAL for k, _ in value):
        return {chr(v).lower() for _, v in value}
    if kind is op.SUBPATTERN:
        return _options_of(value[-1])
    if kind is op.BRANCH:
        each = [_options_of(x) for x in value[1]]
        return None if None in each else set().union(*each)
    if kind in _REPEATS and value[1] == 1:
        inner = _options_of(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _options_of(items) -> set[str] | None:
    found = {""}
    for kind, value in items:
        more = _options(kind, value)
        if more is None or len(found) * len(more) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in more}
    return found
