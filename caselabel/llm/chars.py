"""Code points of many texts at once, and tables over all code points."""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

POINTS = 0x110000


@functools.cache
def letters() -> np.ndarray:
    """True at every code point that is a letter."""
    table = np.zeros(POINTS, bool)
    table[[c for c in range(POINTS) if unicodedata.category(chr(c))[0] == "L"]] = True
    return table


@functools.cache
def numbers() -> np.ndarray:
    """True at every code point that is a number."""
    table = np.zeros(POINTS, bool)
    table[[c for c in range(POINTS) if unicodedata.category(chr(c))[0] == "N"]] = True
    return table


def code_points(texts: list[str], between: str = "\n") -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by ``between``, and where each text begins."""
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=first[1:])
    joined = between.join([*texts, ""])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), first
