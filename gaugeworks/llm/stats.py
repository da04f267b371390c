"""Counts of a whole text that quality rules and the quality classifier share."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeworks.llm.text import map_texts, words_of

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_BLANKS = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
         "n_same_next", "n_exclaim", "n_upper", "n_lower", "n_digits", "n_points", "n_other", "n_capital")
DDL = ", ".join(f"{n} long" for n in NAMES)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    hit = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    marked = np.zeros(len(words), bool)
    for k in range(3):
        marked[k:k + len(hit)] |= hit
    return int(marked.sum())


def text_stats(raw: bytes | None) -> tuple[int, ...]:
    """All counts of one text, in the order of ``NAMES``; null counts as the empty text."""
    if not raw:
        return (0,) * len(NAMES)
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = words_of(raw)
    n_dup, n_lines, seen = 0, 0, set()
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    chars = len(raw) - int(by[0x80:0xC0].sum()) - int(by[_BLANKS].sum())
    same = sum(map(bytes.__eq__, words, words[1:]))
    return (len(words), chars, int(by[list(SYMBOLS)].sum()), n_dup, repeated_words(words), n_lines,
            len(set(words)), same, int(by[0x21]), int(by[0x41:0x5B].sum()), int(by[0x61:0x7B].sum()),
            int(by[0x30:0x3A].sum()), int(by[[0x2E, 0x2C]].sum()), int(by[0xC0:].sum()),
            sum(w[:1].isupper() for w in words))


def _arrays(texts: list[bytes | None]) -> list[pa.Array]:
    table = np.array([text_stats(t) for t in texts], np.int64).reshape(len(texts), len(NAMES))
    return [pa.array(table[:, k]) for k in range(len(NAMES))]


def with_stats(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df[keep]`` with the counts of every whole text as further columns. A null text counts as an empty one: all
    counts are 0."""
    return map_texts(df, text, DDL, _arrays, keep)
