"""Texts as arrays of code points, with the character classes the text
classifiers count."""

from __future__ import annotations

import sys
from functools import cache

import numpy as np

LETTER, UPPER, DIGIT, SPACE = 1, 2, 4, 8


@cache
def classes() -> np.ndarray:
    """Class bits of every code point, from Python's own character tests."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        out[c] = (LETTER * ch.isalpha() | UPPER * ch.isupper() | DIGIT * ch.isdigit() | SPACE * ch.isspace())
    return out


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
