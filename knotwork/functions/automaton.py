"""Many literal terms sought in a text at once, as whole words and whatever their case."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick

#: Unicode's white space.
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
_WORD_KINDS = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Mn", "Me", "Mc", "Nd", "Pc"}


def _fold(c: str) -> str:
    """A character without case: its upper case's lower case, where these are one character."""
    up = c.upper()
    low = (up if len(up) == 1 else c).lower()
    return low if len(low) == 1 else c


class _Folds(dict):
    def __missing__(self, code: int) -> str:
        self[code] = _fold(chr(code))
        return self[code]


_folds = _Folds()


def folded(text: str) -> str:
    """``text`` without case, character by character, so that places stay the same."""
    return text.lower() if text.isascii() else text.translate(_folds)


@lru_cache(1 << 16)
def in_word(c: str) -> bool:
    """Whether ``c`` is a letter, mark, decimal digit, joining punctuation or a joiner."""
    return unicodedata.category(c) in _WORD_KINDS or c in "‌‍" or "Ⓐ" <= c <= "ⓩ"


class Terms:
    """A machine (Aho-Corasick) of all terms. It passes over a text once, however many they are."""

    def __init__(self, terms: list[str]):
        by: dict[str, list[int]] = {}
        for k, t in enumerate(terms):
            if t:
                by.setdefault(folded(t), []).append(k)
        self.machine = ahocorasick.Automaton()
        for form, ks in by.items():
            self.machine.add_word(form, (len(form), in_word(form[0]), in_word(form[-1]), ks))
        self.any = bool(by)
        if self.any:
            self.machine.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(term, place, length) of each term with some whole-word occurrence; the place is that of its first occurrence, within a word or not."""
        if not self.any or not text:
            return
        first: dict[int, int] = {}
        whole: dict[int, tuple[int, list[int]]] = {}
        n = len(text)
        for end, (length, head, tail, ks) in self.machine.iter(folded(text)):
            begin = end - length + 1
            if ks[0] not in first:
                first[ks[0]] = begin
            if ks[0] not in whole:
                before = begin > 0 and in_word(text[begin - 1])
                after = end + 1 < n and in_word(text[end + 1])
                if before != head and after != tail:
                    whole[ks[0]] = (length, ks)
        for k, (length, ks) in whole.items():
            for term in ks:
                yield term, first[k], length


def around(text: str, place: int, length: int, window: int = 120) -> str:
    """``window`` characters on both sides of a place, white space collapsed."""
    return _WHITE.sub(" ", text[max(0, place - window) : place + length + window]).strip(" ")
