"""Splitting a text into stretches that byte-level tokenizers treat independently of one another.

A stretch is a run without white space together with the one space before it, or a run of white space. The pattern of
the byte-level vocabularies never matches across the end of such a stretch, so its matches inside the stretches are its
matches in the text. Stretches repeat far more often than texts do, hence their tokens are found once and kept.
"""

from __future__ import annotations

import re

#: The characters with the Unicode property White_Space, as the tokenizers' \s has them.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: What Python's \s and str.split take for white space beyond that.
PYTHON_ONLY_SPACE = re.compile("[\x1c-\x1f]")

_FAST = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_EXACT = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")

#: Stretches kept by a Python worker; beyond it the worker starts afresh.
KEPT = 400_000
#: Longer stretches are not kept.
KEPT_CHARS = 64


def stretches(text: str) -> list[str]:
    """The consecutive stretches of a text; joined they are the text."""
    return (_EXACT if PYTHON_ONLY_SPACE.search(text) else _FAST).findall(text)


class Memo(dict):
    """What `of` says of keys, of bounded size: it is emptied when full, and long keys are not kept."""

    def __init__(self, of, kept: int = KEPT):
        super().__init__()
        self.of, self.kept = of, kept

    def __missing__(self, key):
        value = self.of(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= self.kept:
                self.clear()
            self[key] = value
        return value
