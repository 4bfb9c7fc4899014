"""Boolean trigram queries from regular expressions.

A query is True (no mandatory trigram), a trigram, or ("and" | "or", queries). A text that the pattern matches anywhere
satisfies the query; letters are folded to lower case on both sides.
"""

from __future__ import annotations

import re._constants as K
import re._parser as parser

#: Sets of strings a part may stand for are followed up to this size.
MOST = 16


def _all(kind: str, queries: list) -> object:
    found: list = []
    for q in queries:
        if q is True:
            if kind == "or":
                return True
        elif isinstance(q, tuple) and q[0] == kind:
            found += [x for x in q[1] if x not in found]
        elif q not in found:
            found.append(q)
    return True if not found else found[0] if len(found) == 1 else (kind, found)


def _strings(exact: set[str]) -> object:
    return _all("or", [_all("and", [s[i : i + 3] for i in range(len(s) - 2)]) if len(s) > 2 else True for s in sorted(exact)])


def _exact(op, arg) -> set[str] | None:
    """All strings that a part can stand for, in lower case, if they are few."""
    if op is K.LITERAL:
        return {chr(arg).lower()}
    if op is K.IN and all(o in (K.LITERAL, K.RANGE) for o, _ in arg):
        chars = {chr(c).lower() for o, a in arg for c in (range(a[0], a[1] + 1) if o is K.RANGE else [a])}
        return chars if len(chars) <= MOST else None
    if op is K.SUBPATTERN:
        return _sequence_exact(arg[3])
    if op is K.BRANCH:
        parts = [_sequence_exact(x) for x in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) and sum(map(len, parts)) <= MOST else None
    if op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[1] is not K.MAXREPEAT and arg[1] <= 4:
        part = _sequence_exact(arg[2])
        if part is None:
            return None
        now, found = {""}, {""} if arg[0] == 0 else set()
        for i in range(1, arg[1] + 1):
            now = {a + b for a in now for b in part}
            if len(now) > MOST:
                return None
            found |= now if i >= arg[0] else set()
        return found if len(found) <= MOST else None
    return {""} if op is K.AT else None


def _sequence_exact(sequence) -> set[str] | None:
    now = {""}
    for op, arg in sequence:
        part = _exact(op, arg)
        if part is None or len(now) * len(part) > MOST:
            return None
        now = {a + b for a in now for b in part}
    return now


def _sequence(sequence) -> object:
    queries, now = [], {""}
    for op, arg in sequence:
        part = _exact(op, arg)
        if part is not None and len(now) * len(part) <= MOST:
            now = {a + b for a in now for b in part}
            continue
        queries.append(_strings(now))
        now = part if part is not None else {""}
        if part is None:
            if op is K.SUBPATTERN:
                queries.append(_sequence(arg[3]))
            elif op is K.BRANCH:
                queries.append(_all("or", [_sequence(x) for x in arg[1]]))
            elif op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] > 0:
                queries.append(_sequence(arg[2]))
    return _all("and", [*queries, _strings(now)])


def trigram_query(pattern: str) -> object:
    return _sequence(parser.parse(pattern))


def trigrams_of(query: object) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))
