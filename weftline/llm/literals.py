"""Patterns of many alternatives, tried only on texts with a literal that every match must have."""

from __future__ import annotations

import re
from re import _parser
from re._constants import ATOMIC_GROUP, BRANCH, LITERAL, MAX_REPEAT, MIN_REPEAT, POSSESSIVE_REPEAT, SUBPATTERN

import ahocorasick


def _better(a: frozenset[str], b: frozenset[str]) -> frozenset[str]:
    """The set whose shortest literal is longer, and of these the smaller; the empty set says nothing."""
    return (a or b) if not (a and b) else max(a, b, key=lambda x: (min(map(len, x)), -len(x)))


def _of_sequence(parts) -> frozenset[str]:
    """Literals of which each match of a parsed sequence has one: those of its best part, alternatives taken together."""
    best: frozenset[str] = frozenset()
    run = ""
    for op, value in parts:
        if op is LITERAL:
            run += chr(value)
            continue
        best, run = _better(best, frozenset({run} if run else ())), ""
        own: frozenset[str] = frozenset()
        if op is SUBPATTERN:
            own = _of_sequence(value[-1])
        elif op is ATOMIC_GROUP:
            own = _of_sequence(value)
        elif op in (MAX_REPEAT, MIN_REPEAT, POSSESSIVE_REPEAT) and value[0] >= 1:
            own = _of_sequence(value[2])
        elif op is BRANCH:
            sides = [_of_sequence(side) for side in value[1]]
            own = frozenset().union(*sides) if all(sides) else own
        best = _better(best, own)
    return _better(best, frozenset({run} if run else ()))


def needed_literals(pattern: str) -> frozenset[str]:
    """Literals of which every match of a pattern, case counting, has at least one; empty if there are none that must be."""
    return _of_sequence(_parser.parse(pattern))


class GatedPattern:
    """A pattern that is searched where one of its needed literals stands."""

    def __init__(self, pattern: str):
        self.pattern = re.compile(pattern)
        found = needed_literals(pattern)
        self.gate = None
        if found:
            self.gate = ahocorasick.Automaton()
            for literal in found:
                self.gate.add_word(literal, True)
            self.gate.make_automaton()

    def search(self, text: str) -> re.Match | None:
        if self.gate is not None and next(self.gate.iter(text), None) is None:
            return None
        return self.pattern.search(text)
