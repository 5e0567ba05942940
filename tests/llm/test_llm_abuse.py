"""How far the grammar of abuse reaches beyond its lists, and that one automaton accepts what its patterns do."""

from __future__ import annotations

import importlib.util
import os
import random

import pytest

from weftline.llm import abuse

_PATH = os.path.join(os.path.dirname(__file__), "unseen_messages.py")


def unseen():
    spec = importlib.util.spec_from_file_location("unseen_messages", _PATH)
    made = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(made)
    return made.OFFENDING, made.HARMLESS


def test_unseen_messages():
    """Sentences that weren't looked at while the lists were extended: every second one, of the offending those after the first 36. Many are like a seen one in another language."""
    offending, harmless = unseen()
    offending, harmless = offending[37::2], harmless[1::2]
    right = sum(abuse.message_score(t) >= abuse.THRESHOLD for t in offending)
    wrong = sum(abuse.message_score(t) >= abuse.THRESHOLD for t in harmless)
    assert len(offending) + len(harmless) == 99 and right >= 0.7 * len(offending) and wrong <= 0.1 * len(harmless)


def accepts(positions, pattern, gap):
    ends = [i for i, c in enumerate(positions) if pattern[0] in c]
    for symbol in pattern[1:]:
        ends = [j for j in range(len(positions)) if symbol in positions[j] and any(0 < j - e <= gap + 1 for e in ends)]
    return bool(ends)


def test_one_pass_accepts_what_each_pattern_does():
    rng = random.Random(6)
    symbols = sorted({c for pattern, _, _ in abuse.PATTERNS for c in pattern})
    for _ in range(400):
        clause = ["".join(rng.sample(symbols, rng.choice([0, 0, 1, 1, 2]))) for _ in range(rng.randint(1, 16))]
        want = {n for n, (pattern, gap, _) in enumerate(abuse.PATTERNS) if accepts(clause, pattern, gap)}
        assert abuse.PATTERN_AUTOMATON.accepted(clause) == want


@pytest.mark.parametrize(
    "text, offends",
    [
        ("You are a complete nitwit.", True), ("I will stab you tonight.", True), ("Voy a estrangularte.", True), ("Je vais t'étrangler.", True), ("Your ugly rat face!", True),
        ("The novel's villain says: I will kill you all, and the hero laughs.", False), ("The rat in your lab is ugly.", False), ("I will beat you at chess.", False), ("Je vais casser ton record.", False),
        ("Tu perro es un animal inteligente.", False), ("I will kill the process on your server.", False), ("I will kill you!", True), ("Je VAIS te f**r* mal.", True), ("Eres tonto, cáll@te la b*c*.", True), ("vou te m*ch*c*r", True), ("They should be dr*v*n out, those s*vages.", True), ("**Note**: 3 * 4 = 12, a*b*c", False), ("तू अपदार्थ नहीं, निकम्मा है।", False),
    ],
)
def test_open_classes_and_contexts(text, offends):
    assert (abuse.message_score(text) >= abuse.THRESHOLD) is offends


def test_long_and_empty_messages():
    assert abuse.message_score("no " * 200_000) == 0.0 and abuse.message_score(" ") == 0.0
    assert abuse.message_score("The doors are open every day. " * 5_000 + "You idiot!") >= abuse.THRESHOLD
