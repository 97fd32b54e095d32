"""Boolean trigram queries of regular expressions.

A query is a tuple of clauses, any of which may hold; a clause is a set of trigrams that
all must occur (in lower case). The empty clause holds always: such a regex needs a full
scan. The walk over the parsed pattern keeps, for every part, either the exact strings it
can match (while few and short) or the clauses of trigrams that any match must contain.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _parser as parser
from re import _constants as op

MOST_STRINGS = 24  # exact strings kept of a part
MOST_CLAUSES = 24

Query = frozenset  # of clauses, each a frozenset of trigrams
ANY: Query = frozenset([frozenset()])


def _grams(text: str) -> frozenset:
    return frozenset(text[k : k + 3] for k in range(len(text) - 2))


def _simple(query: Query) -> Query:
    """Without clauses that another one implies; ANY if too many are left."""
    kept = frozenset(c for c in query if not any(o < c for o in query))
    return kept if len(kept) <= MOST_CLAUSES else ANY


def _both(a: Query, b: Query) -> Query:
    return _simple(frozenset(x | y for x in a for y in b)) if len(a) * len(b) <= 400 else min(a, b, key=len)


@dataclass(frozen=True)
class _Part:
    """exact: all strings it can match, or None; query: what any match must contain."""

    exact: frozenset | None
    query: Query = ANY


def _known(strings: frozenset) -> Query:
    return _simple(frozenset(_grams(s) for s in strings))


def _chars(items) -> frozenset | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= MOST_STRINGS else None


def _join(parts: list[_Part]) -> _Part:
    """Parts one after another: exact strings grow together until one part is not exact."""
    query, run, whole = ANY, frozenset([""]), True
    for part in parts:
        if part.exact is not None and len(run) * len(part.exact) <= MOST_STRINGS:
            run = frozenset(a + b for a in run for b in part.exact)
            continue
        query, whole = _both(query, _known(run)), False
        if part.exact is not None:
            run = part.exact
        else:
            query, run = _both(query, part.query), frozenset([""])
    return _Part(run) if whole else _Part(None, _both(query, _known(run)))


def _either(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        strings = frozenset().union(*(p.exact for p in parts))
        if len(strings) <= MOST_STRINGS:
            return _Part(strings)
    clauses = [p.query if p.exact is None else _known(p.exact) for p in parts]
    return _Part(None, _simple(frozenset().union(*clauses)))


def _walk(tree) -> _Part:
    parts = []
    for kind, value in tree:
        if kind is op.LITERAL:
            parts.append(_Part(frozenset([chr(value).lower()])))
        elif kind is op.IN:
            chars = _chars(value)
            parts.append(_Part(chars))
        elif kind is op.BRANCH:
            parts.append(_either([_walk(t) for t in value[1]]))
        elif kind is op.SUBPATTERN:
            parts.append(_walk(value[3]))
        elif kind is op.ATOMIC_GROUP:
            parts.append(_walk(value))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            part = _walk(inner)
            if (least, most) == (0, 1) and part.exact is not None:
                parts.append(_Part(part.exact | {""}))
            elif least == 0:
                parts.append(_Part(None))
            else:
                parts += [part] * min(least, 4)
                if most != least or least > 4:
                    parts.append(_Part(None))
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            continue  # takes no characters; what it demands beside is left to the check
        else:
            parts.append(_Part(None))
    return _join(parts)


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """Clauses of lower-case trigrams, one of which every text with a match contains."""
    part = _walk(parser.parse(pattern, flags))
    return part.query if part.exact is None else _known(part.exact)
