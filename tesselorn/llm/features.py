"""Features of whole texts for classifiers: hashed words and structure."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np

WORD_BITS = 18
# Fixed order of the structure statistics.
STRUCTURE = ["log words", "log chars a word", "upper case", "digits", "marks", "distinct words", "commonest word", "words with marks but for one at the end", "repeated lines", "log lines", "log n_chars"]


def words(seen: Iterable[bytes]) -> np.ndarray:
    """Bucket of each distinct lower-cased word of ``seen``, ascending."""
    own = np.array(list(map(zlib.crc32, set(map(bytes.lower, seen)))), np.uint32)
    return np.unique(own & np.uint32((1 << WORD_BITS) - 1)).astype(np.int32)


_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def structure(text: bytes, seen: Counter, n_chars: int | None = None) -> np.ndarray:
    """Statistics of a text, whose words ``seen`` counts, and of its recorded
    length (as found where null)."""
    n = seen.total()
    upper, digits, marks = (len(text) - len(text.translate(None, kind)) for kind in (_UPPER, _DIGITS, _MARKS))
    size = max(len(text), 1)
    lines = text.split(b"\n")
    # words with more marks than one at their end
    odd = sum(k for w, k in seen.items() if len(w) - len(w.translate(None, _MARKS)) > (w[-1] in _MARKS))
    length = len(text) if n_chars is None else n_chars
    return np.array([
        np.log1p(n) / 4, np.log1p(len(text) / max(n, 1)), upper / size, digits / size, 4 * marks / size,
        len(seen) / max(n, 1), max(seen.values(), default=0) / max(n, 1), odd / max(n, 1),
        1 - len(set(lines)) / len(lines), np.log1p(len(lines)) / 3, np.log1p(max(length, 0)) / 6,
    ], np.float32)
