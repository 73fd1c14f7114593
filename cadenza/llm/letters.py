"""Texts as arrays of small letter codes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

SLICE = 1 << 20   # characters mapped at once


def alphabet(texts: Iterable[str], size: int) -> str:
    """The most frequent lower-case letters, at most ``size``."""
    seen: Counter = Counter()
    for t in texts:
        seen.update(t.lower())
    letters = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if c.isalpha()]
    return "".join(letters[:size])


def letter_table(letters: str) -> np.ndarray:
    """Code point (up to 0xFFFF, above: 0xFFFF) to code: 0 no letter, 1... the
    letters given, len(letters) + 1 any other letter."""
    table = np.fromiter((chr(c).isalpha() for c in range(1 << 16)), np.uint8, 1 << 16)
    table[0xFFFF] = 0
    table *= len(letters) + 1
    for k, c in enumerate(letters):
        if ord(c) < 0xFFFF:
            table[ord(c)] = k + 1
    return table


def codes(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of a text in lower case; a run of other characters is one 0."""
    parts = []
    for lo in range(0, len(text), SLICE):
        points = np.frombuffer(text[lo:lo + SLICE].lower().encode("utf-32-le", "replace"), "<u4")
        parts.append(table[np.minimum(points, 0xFFFF)])
    if not parts:
        return np.zeros(0, np.uint8)
    c = parts[0] if len(parts) == 1 else np.concatenate(parts)
    keep = c != 0
    keep[0] = True
    keep[1:] |= c[:-1] != 0
    return c[keep]


def groups(texts: list[str], limit: int) -> Iterable[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters each."""
    lo = total = 0
    for k, t in enumerate(texts):
        total += len(t)
        if total >= limit:
            yield lo, k + 1
            lo, total = k + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def strings(column: pa.Array) -> list[str]:
    """Texts of a binary column; bytes that are no UTF-8 become U+FFFD."""
    return [b.decode("utf-8", "replace") for b in column.to_pylist()]
