"""Byte-level BPE over words that workers have met before.

Wherever white space follows other text, the tokenizer's pattern ends a match, whatever stands before. A text
is cut there into units (white space, then other text), each tokenized by itself and remembered for as long as
the memory of a worker allows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: White space of the tokenizer's pattern (the Unicode property White_Space).
SPACE = r"\t-\r \x85\xa0  -     　"
UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
REMEMBERED = 400_000
#: Longer units are not remembered.
LONGEST = 64


class Uneven(Exception):
    """A text has white space that cutting at single spaces does not respect."""


class Memory(dict):
    """What ``work`` gives for a space and the key; emptied when full, which changes no result."""

    def __init__(self, work: Callable[[str], object]):
        super().__init__()
        self.work = work

    def __missing__(self, word: str):
        if not word or word[-1].isspace():
            raise Uneven
        value = self.work(" " + word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value

    def over(self, text: str) -> Iterator:
        """The values of all units of a text, in order."""
        if not text:
            return iter(())
        first, *words = text.split(" ")
        try:
            if not first or first[-1].isspace():
                raise Uneven
            return iter([self.work(first), *map(self.__getitem__, words)])
        except Uneven:
            return map(self.work, UNIT.findall(text))
