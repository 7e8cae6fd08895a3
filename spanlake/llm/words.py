"""ASCII-folded words: A-Z are lower-cased, a word is a run of 0-9, a-z and anything beyond ASCII."""

from __future__ import annotations

import numpy as np

#: Byte to byte: letters folded, what is no part of a word becomes a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_IS_WORD = np.frombuffer(FOLD, np.uint8) != 32


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def count_words(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each of the texts that lie end to end in `raw`; a word never crosses from one text to the next."""
    inside = _IS_WORD[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(raw)]
    starts[first] = inside[first]
    total = np.r_[0, np.cumsum(starts, dtype=np.int64)]
    return total[offsets[1:]] - total[offsets[:-1]]
