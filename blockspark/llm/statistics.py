"""Counts and shapes of one text, shared by the quality operators.

Words are runs of anything but the six ASCII white-space characters, as
``bytes.split`` finds them. Null counts as the empty text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

SPACE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: Words in a window that may repeat.
WINDOW = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside a window of ``size`` words that the text holds twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    windows = list(zip(*[words[i:] for i in range(size)], strict=False))
    if len(set(windows)) == n:
        return 0
    times = Counter(windows)
    total, past = 0, 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            total += i + size - max(i, past)
            past = i + size
    return total


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word: all, and those equal to an earlier one."""
    lines = [x for x in text.split("\n") if x.strip(SPACE)] if "\n" in text else [text] if text.strip(SPACE) else []
    return len(lines), len(lines) - len(set(lines))


def base(text: str | None, words: list[bytes] | None = None) -> tuple[int, int, int, int, int]:
    """The counts named in BASE."""
    if not text:
        return 0, 0, 0, 0, 0
    words = split(text) if words is None else words
    return len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), duplicate_lines(text)[1], repeated_words(words)


FEATURES = (
    "log_words", "word_length", "word_spread", "symbols", "dup_lines", "repeats", "distinct", "commonest", "upper", "capital", "digits", "marks", "bangs", "stops", "packed",
    "line_words", "short_lines", "bars", "foreign", "short_words", "longest", "controls",
)


def features(text: str | None) -> list[float]:
    """The numbers named in FEATURES, all finite; zeros for a text without a word."""
    words = split(text)
    if not words or not text:
        return [0.0] * len(FEATURES)
    n, chars, symbols, dups, repeats = base(text, words)
    raw = text.encode("utf-8", "surrogatepass")
    lines, _ = duplicate_lines(text)
    times = Counter(words)
    lengths = list(map(len, words))
    mean = sum(lengths) / n
    swapped = raw.lower()
    upper = sum(map(int.__ne__, raw, swapped)) if len(raw) < 256 else len(raw) - _same(raw, swapped)
    digits = sum(map(raw.count, b"0123456789"))
    marks = sum(map(raw.count, b".,;:?\"'()-"))
    return [
        math.log1p(n), chars / n, math.sqrt(sum(x * x for x in lengths) / n - mean * mean + 1e-9), symbols / n, dups / max(lines, 1), repeats / n, math.log(len(times) + 1) - math.log(n + 1), max(times.values()) / n, upper / chars,
        sum(w[:1].isupper() for w in words) / n, digits / chars, marks / chars, text.count("!") / chars, (text.count(".") + text.count("?")) / n, len(zlib.compress(raw, 1)) / len(raw), n / max(lines, 1), _short(text) / max(lines, 1), text.count("|") / n,
        1 - len(text) / len(raw), sum(x <= 3 for x in lengths) / n, math.log1p(max(lengths)), sum(map(text.count, "\x00�​")) / chars,
    ]


def _same(a: bytes, b: bytes) -> int:
    """Places at which two strings of one length agree."""
    import numpy as np

    return int((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).sum())


def _short(text: str) -> int:
    return sum(1 for x in text.split("\n") if 0 < len(x) < 30)
