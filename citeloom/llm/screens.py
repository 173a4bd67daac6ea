"""Screens: strings that spare a text the patterns that cannot find anything in it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import lru_cache

import ahocorasick

#: What lower() leaves apart and a pattern without case takes for one.
_CASES = {0x17F: "s", 0x131: "i", 0x307: None, 0xA0: " "}


def lowered(text: str) -> str:
    """The text in lower case as patterns without case see it."""
    lower = text.lower()
    return lower if lower.isascii() or not any(chr(c) in lower for c in _CASES) else lower.translate(_CASES)


@lru_cache(maxsize=8)
def _automaton(items: tuple[tuple[str, tuple[str, ...]], ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for hint in {h for _, hints in items for h in hints}:
        found.add_word(hint, [n for n, hints in items if hint in hints])
    found.make_automaton()
    return found


def hints_in(sets: Mapping[str, Sequence[str]], text: str, lower: bool = True) -> set[str]:
    """The names of the sets of which the text (in lower case and with usual blanks) holds a string, in one pass."""
    automaton = _known.get(id(sets))
    if automaton is None:
        automaton = _known[id(sets)] = _automaton(tuple((n, tuple(h)) for n, h in sets.items()))
    found: set[str] = set()
    for _, names in automaton.iter(lowered(text) if lower else text):
        found.update(names)
        if len(found) == len(sets):
            break
    return found


def times_in(words: Iterable[str], text: str) -> int:
    """How often any of the words stands in the text, in words or by itself."""
    return sum(1 for _ in _automaton((("words", tuple(words)),)).iter(lowered(text)))


#: By the identity of tables that live as long as their module.
_known: dict[int, ahocorasick.Automaton] = {}
