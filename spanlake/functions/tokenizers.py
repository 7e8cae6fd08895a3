"""Token counters of real vocabularies, for operators.segment: a text to the spans of its tokens."""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate
from pathlib import Path
from typing import Any

#: Fixed value: a limit from here on says that a tokenizer has none.
NO_LIMIT = 1_000_000


@lru_cache(maxsize=4)
def _load(path: str) -> Any:
    """A tokenizer file, once for each worker. Markers such as <|endoftext|> are text where a text shows them."""
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


#: The longest word whose number of tokens is kept, and how many words a worker keeps.
KEPT_CHARS, KEPT_WORDS = 64, 500_000

_between = re.compile(r"(?<=\S)(?=[ \n])")


@lru_cache(maxsize=4)
def _apart(path: str) -> bool:
    """Whether a file's tokens of a text are those of its words one by one: plain byte-level pairs, which no token joins over the begin of white space."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    split = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    plain = model["type"] == "BPE" and not model.get("dropout") and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
    return bool(split and plain and all(x["special"] for x in spec.get("added_tokens", [])))


@lru_cache(maxsize=4)
def _kept(path: str) -> dict[str, int]:
    return {}


class _Words:
    """How many tokens text[a:b] has: words in full are looked up and added up, those that are cut are tokenised for themselves."""

    def __init__(self, text: str, path: str):
        self.text, self.path, self.cut = text, path, {}
        words = _between.split(text)
        self.starts = [0, *accumulate(map(len, words))]
        self.sums = [0, *accumulate(map(self._of, words))]

    def _of(self, word: str) -> int:
        kept = _kept(self.path)
        n = kept.get(word)
        if n is None:
            n = len(_load(self.path).encode(word, add_special_tokens=False))
            if len(word) <= KEPT_CHARS:
                if len(kept) >= KEPT_WORDS:
                    kept.clear()
                kept[word] = n
        return n

    def _part(self, a: int, b: int) -> int:
        if (a, b) not in self.cut:
            self.cut[a, b] = self._of(self.text[a:b])
        return self.cut[a, b]

    def __call__(self, a: int, b: int) -> int:
        b = min(b, len(self.text))
        if a >= b:
            return 0
        i, j = bisect_right(self.starts, a) - 1, bisect_right(self.starts, b) - 1  # the words that a and b are in
        if i == j:
            return self._part(a, b)
        first = i if self.starts[i] == a else i + 1
        return (self._part(a, self.starts[first]) if first > i else 0) + self.sums[j] - self.sums[first] + (self._part(self.starts[j], b) if self.starts[j] < b else 0)


class VocabularyTokens:
    """Spans of the tokens of a text by a `tokenizers` file, whose path every worker can read."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, text: str) -> list[tuple[int, int]]:
        return _load(self.path).encode(text, add_special_tokens=False).offsets

    def counter(self, text: str) -> Callable[[int, int], int] | None:
        """Tells the tokens of text[a:b] for any a and b; None where a file's tokens may reach over words."""
        return _Words(text, self.path) if _apart(self.path) else None


def model_limit(folder: str) -> int | None:
    """The limit that a tokenizer's settings name (model_max_length of tokenizer_config.json, truncation of tokenizer.json); None if they name none."""
    found: list[Callable[[], int | None]] = [
        lambda: json.loads(Path(folder, "tokenizer_config.json").read_text(encoding="utf-8")).get("model_max_length"),
        lambda: (json.loads(Path(folder, "tokenizer.json").read_text(encoding="utf-8")).get("truncation") or {}).get("max_length"),
    ]
    for read in found:
        try:
            limit = read()
        except (OSError, ValueError, AttributeError):
            continue
        if isinstance(limit, (int, float)) and 0 < limit < NO_LIMIT:
            return int(limit)
    return None
