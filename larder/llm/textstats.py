"""Statistics of one whole text, counted on its bytes and words; used by the two quality operators.

Words are runs without ASCII white space. A null text counts as empty. Cost and memory follow the
length of the one text.
"""

import math

import numpy as np

from larder.llm.common import mix

WHITE = list(b" \t\n\r\x0b\x0c")
SYMBOLS = list(b"#*$%&|<>")
DIGITS = list(b"0123456789")
UPPER = list(range(65, 91))
ENDS = list(b".,;:?")
WINDOW = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "digit_share", "ends_per_word", "bangs_per_word", "top_word_share",
    "stutter_share", "lines_per_word", "longest_word", "wide_share", "pipe_share",
]
# more of these can only lower a document's quality
FALLING = ["symbol_share", "dup_line_share", "repeat_share", "bangs_per_word", "stutter_share",
           "pipe_share"]


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five counts and the features of a text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return [0, 0, int(sum(map(text.count, "#*$%&|<>"))), 0, 0], [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = len(text) - int(seen[WHITE].sum())
    symbols = int(seen[SYMBOLS].sum())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    dup_lines = len(lines) - len(set(lines))
    number = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
    covered = repeated_words(ids)
    top = int(np.bincount(ids.astype(np.int64)).max())
    stutter = int((ids[1:] == ids[:-1]).sum())
    total = len(data)
    return [n, chars, symbols, dup_lines, covered], [
        math.log1p(n), chars / n, symbols / chars, dup_lines / len(lines), covered / n,
        len(number) / n, int(seen[UPPER].sum()) / chars, int(seen[DIGITS].sum()) / chars,
        int(seen[ENDS].sum()) / n, int(seen[33]) / n, top / n, stutter / n, len(lines) / n,
        math.log1p(max(map(len, number))), int(seen[128:].sum()) / total, int(seen[124]) / chars,
    ]


def repeated_words(ids: np.ndarray) -> int:
    """Words that stand in a window of five words which the text holds twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    spread = mix(ids + np.uint64(1))
    windows = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        windows = mix(windows + spread[k:k + n] + np.uint64(k + 1))
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        covered[k:k + n] |= twice
    return int(covered.sum())


def matrix(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and features of many texts, a row each."""
    both = [statistics(t) for t in texts]
    return (np.array([b[0] for b in both], np.int64).reshape(-1, len(COUNTS)),
            np.array([b[1] for b in both], np.float64).reshape(-1, len(FEATURES)))
