"""Mandatory trigrams of a regular expression, as a Boolean query.

``clauses(pattern)`` gives an OR of ANDs: every match of the pattern holds, after
ASCII lower-casing, all trigrams of at least one clause.  ``None`` means that the
pattern has no mandatory trigram.  The standard library's regex parser reads the
pattern; it sees a handful of rules, never data.
"""

from __future__ import annotations

from itertools import product
from re import _parser as parser

#: A part of a pattern is spelled out as literal strings up to so many of them.
MAX_STRINGS = 32


def _strings(op, arg) -> set[str] | None:
    """All strings that a node can match, or None if they are too many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "AT":
        return {""}
    if name == "IN":
        out: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                out.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < MAX_STRINGS:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if name == "SUBPATTERN":
        return _sequence_strings(arg[-1])
    if name == "BRANCH":
        parts = [_sequence_strings(b) for b in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 5:
        one = _sequence_strings(arg[2])
        if one is None:
            return None
        out = set()
        for n in range(arg[0], arg[1] + 1):
            if len(one) ** n > MAX_STRINGS:
                return None
            out |= {"".join(p) for p in product(sorted(one), repeat=n)}
        return out
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        part = _strings(op, arg)
        if part is None or len(out) * len(part) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _of(strings: set[str]) -> list[frozenset] | None:
    if any(len(s) < 3 for s in strings):
        return None
    return [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]


def _both(a: list[frozenset] | None, b: list[frozenset] | None) -> list[frozenset] | None:
    if a is None or b is None:
        return a if b is None else b
    if len(a) * len(b) > MAX_STRINGS:
        return min(a, b, key=len)
    return [x | y for x in a for y in b]


def _query(nodes) -> list[frozenset] | None:
    found, run = None, {""}
    for op, arg in nodes:
        part = _strings(op, arg)
        if part is not None and len(run) * len(part) <= MAX_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        found, run = _both(found, _of(run)), {""}
        name = str(op)
        if name == "SUBPATTERN":
            found = _both(found, _query(arg[-1]))
        elif name == "BRANCH":
            each = [_query(b) for b in arg[1]]
            if all(q is not None for q in each):
                found = _both(found, [c for q in each for c in q])
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            found = _both(found, _query(arg[2]))
    return _both(found, _of(run))


def clauses(pattern: str) -> list[frozenset] | None:
    found = _query(parser.parse(pattern))
    return None if found is None else sorted(set(found), key=sorted)
