"""Phrases in a text by words: where they stand, what stands right before or after a place, and what comes before what."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from functools import lru_cache

_WORD = re.compile(r"[^\W_]+|[^\w\s]")
Phrase = tuple[str, ...]


def phrase(said: str) -> Phrase:
    return tuple(_WORD.findall(said.lower()))


def phrases(said: Iterable[str]) -> tuple[Phrase, ...]:
    """Longest first."""
    return tuple(sorted(map(phrase, said), key=len, reverse=True))


@lru_cache(maxsize=1024)
def _heads(sought: tuple[Phrase, ...]) -> frozenset[str]:
    return frozenset(p[0] for p in sought)


class Words:
    """A text's words and signs, in small letters, with their places."""

    def __init__(self, text: str):
        found = list(_WORD.finditer(text))
        self.words = [m[0].lower() for m in found]
        self.known = frozenset(self.words)
        self.starts = [m.start() for m in found]
        self.stops = [m.end() for m in found]

    def at(self, offset: int) -> int:
        """The number of the first word that starts at or behind an offset."""
        return bisect_left(self.starts, offset)

    def __getitem__(self, k: int) -> str:
        return self.words[k] if 0 <= k < len(self.words) else ""

    def here(self, k: int, sought: Iterable[Phrase]) -> int | None:
        """The word behind the first of sought that starts with word k."""
        return next((k + len(p) for p in sought if tuple(self.words[k : k + len(p)]) == p), None)

    def first(self, lo: int, hi: int, sought: tuple[Phrase, ...]) -> tuple[int, int] | None:
        """First and next word of the first place in words lo to hi with one of sought whole."""
        heads = _heads(sought)
        if heads.isdisjoint(self.known):
            return None
        for k, word in enumerate(self.words[lo:hi], lo):
            if word in heads and (end := self.here(k, sought)) is not None and end <= hi:
                return k, end
        return None

    def follows(self, lo: int, hi: int, *steps: tuple[Phrase, ...]) -> bool:
        """Whether phrases, one of each step, come one after the other in words lo to hi."""
        for sought in steps:
            place = self.first(lo, hi, sought)
            if place is None:
                return False
            lo = place[1]
        return True

    def ends_with(self, k: int, sought: Iterable[Phrase], skip: frozenset[str] = frozenset()) -> bool:
        """Whether one of sought stands right before word k, but for words of skip."""
        while k > 0 and self.words[k - 1] in skip:
            k -= 1
        return any(len(p) <= k and tuple(self.words[k - len(p) : k]) == p for p in sought)

    def starts_with(self, k: int, sought: Iterable[Phrase], skip: frozenset[str] = frozenset()) -> bool:
        """Whether one of sought starts with word k, but for words of skip."""
        while k < len(self.words) and self.words[k] in skip:
            k += 1
        return self.here(k, sought) is not None


_DIGITS = bytes.maketrans(b"123456789", b"000000000")


@lru_cache(maxsize=64)
def even_digits(text: str) -> str:
    """The text with 0 for each of the digits 0 to 9: texts that differ in digits only are alike to rules that name none."""
    return text.encode("utf-8", "surrogatepass").translate(_DIGITS).decode("utf-8", "surrogatepass")


def words_of(text: str) -> Words:
    """The words of a text, with 0 for each digit, as phrases have none."""
    return _words_of(even_digits(text))


@lru_cache(maxsize=1024)
def _words_of(text: str) -> Words:
    return Words(text)
