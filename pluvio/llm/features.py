"""Shape statistics of whole texts, as variance-stabilised numbers."""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from operator import eq

import numpy as np

NAMES = ["log_words", "log_word_length", "upper_share", "symbol_share", "digit_share",
         "repeat_share", "distinct_log_ratio", "stop_rate", "commonest_share", "line_rate"]
_OTHER, _LETTER, _UPPER, _DIGIT, _SPACE, _STOP = range(6)
_TABLE_SIZE = 0x2000


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point below the table's end."""
    made = np.zeros(_TABLE_SIZE, np.int64)
    for i in range(_TABLE_SIZE):
        c = chr(i)
        made[i] = (_UPPER if c.isupper() else _LETTER if c.isalpha() else _DIGIT if c.isnumeric()
                   else _SPACE if c.isspace() else _STOP if c in ".,;:?'\"()-" else _OTHER)
    return made


def _angle(part: float, whole: float) -> float:
    """Arcsine transform of a share, drawn a little to the middle for short texts."""
    return float(np.arcsin(np.sqrt(part / (whole + 1.0))))


def statistics(text: str) -> list[float]:
    """The statistics named in ``NAMES``; an empty text has those of no words."""
    counts = np.zeros(6, np.int64)
    for at in range(0, len(text), 1 << 20):  # a very long text is read in pieces
        points = np.frombuffer(text[at:at + (1 << 20)].encode("utf-32-le", "surrogatepass"), "<u4")
        known = points < _TABLE_SIZE
        counts += np.bincount(_classes()[points[known]], minlength=6)
        counts[_LETTER] += len(points) - int(known.sum())
    words = text.split()
    tally = Counter(words)
    n, chars = len(words), len(text)
    letters = int(counts[_LETTER] + counts[_UPPER])
    repeats = sum(map(eq, words, words[1:]))
    return [
        float(np.log1p(n)),
        float(np.log((chars - int(counts[_SPACE]) + 5) / (n + 1))),
        _angle(int(counts[_UPPER]), letters),
        _angle(int(counts[_OTHER]), chars),
        _angle(int(counts[_DIGIT]), chars),
        _angle(repeats, n),
        float(np.log(len(tally) + 1) / np.log(n + 2)),
        float(np.sqrt(int(counts[_STOP]) / (n + 1))),
        _angle(max(tally.values(), default=0), n + 10),
        float(np.sqrt((text.count("\n") + 1) / (n + 5))),
    ]
