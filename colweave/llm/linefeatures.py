"""Counts and features of words and lines of whole texts, all rows of a group at once."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np

from colweave.llm import textops as T

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
IS_UPPER = np.zeros(256, bool)
IS_UPPER[ord("A") : ord("Z") + 1] = True
IS_LOWER = np.zeros(256, bool)
IS_LOWER[ord("a") : ord("z") + 1] = True
IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[ord("0") : ord("9") + 1] = True
IS_CODE = np.zeros(256, bool)
IS_CODE[list(b"{}[];=/\\_@~^")] = True
IS_STOP = np.zeros(256, bool)
IS_STOP[list(b".?:;\"')")] = True
#: Features of a line, in the order of `line_features`.
LINE_FEATURES = ["bias", "log_words", "short", "symbols", "symbols_any", "bangs", "uppers", "digits", "bars", "code", "echo", "repeated", "copied", "unstopped", "word_size"]


def scan(data: np.ndarray, offsets: np.ndarray) -> SimpleNamespace:
    """Words and lines of all rows with their numbers, repeats and owners."""
    x = SimpleNamespace(data=data, offsets=offsets, n=len(offsets) - 1)
    x.word_at, x.word_to = T.words(data, offsets)
    x.words = T.per_row(x.word_at, offsets)
    x.word_row = T.rows_of(x.words)
    x.word_number = T.numbered(data, x.word_at, x.word_to)
    x.repeated = repeated_words(x.word_number, x.word_row)
    # lines: from a row's start or after a line feed to the next line feed or the row's end
    feeds = np.flatnonzero(data == 10)
    x.line_at = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    x.line_to = np.sort(np.concatenate([feeds, offsets[1:]]), kind="stable")
    first = T.per_row(x.word_at, x.line_at)
    with_word = (T.per_row(x.word_at, x.line_to) > first) & (x.line_to > x.line_at)
    x.line_at, x.line_to = x.line_at[with_word], x.line_to[with_word]
    x.lines = T.per_row(x.line_at, offsets)
    x.line_row = T.rows_of(x.lines)
    x.line_words = T.per_row(x.word_at, np.append(x.line_at, len(data)))
    key = T.numbered(data, x.line_at, x.line_to) * x.n + x.line_row
    _, first, group, size = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    x.copied_line = size[group] > 1
    x.later_line = np.arange(len(key)) != first[group]
    return x


def repeated_words(number: np.ndarray, word_row: np.ndarray) -> np.ndarray:
    """Words in a window of three words that its row holds twice or more, the first included."""
    out = np.zeros(len(number), bool)
    at = np.flatnonzero(word_row[2:] == word_row[:-2]) if len(number) > 2 else np.zeros(0, np.int64)
    if len(at):
        kinds = int(number.max()) + 1
        key = number[at] * kinds + number[at + 1]
        for more, many in ((number[at + 2], kinds), (word_row[at], int(word_row[-1]) + 1)):
            key = np.unique(key, return_inverse=True)[1] * many + more
        _, group, size = np.unique(key, return_inverse=True, return_counts=True)
        at = at[size[group] > 1]
        for k in range(3):
            out[at + k] = True
    return out


def base_counts(x: SimpleNamespace) -> dict[str, np.ndarray]:
    """Per row: words, their code points, symbols, later copies of lines, words in repeats."""
    inside = (~T.IS_SPACE[x.data]) & ((x.data & 0xC0) != 0x80)
    return {
        "n_words": np.diff(x.words),
        "word_chars": _between(inside, x.offsets),
        "n_symbols": _between(IS_SYMBOL[x.data], x.offsets),
        "n_dup_lines": T.sums_by_row(x.later_line, x.lines),
        "n_repeat_words": T.sums_by_row(x.repeated, x.words),
    }


def _between(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def line_features(x: SimpleNamespace) -> np.ndarray:
    """One row of `LINE_FEATURES` for each line with a word, each between 0 and about 1."""
    size = np.maximum(x.line_to - x.line_at, 1)

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[x.line_to] - total[x.line_at]

    words = np.diff(x.line_words)
    echo = np.zeros(len(x.word_number), bool)
    echo[1:] = x.word_number[1:] == x.word_number[:-1]
    upper, lower = count(IS_UPPER[x.data]), count(IS_LOWER[x.data])
    symbols = count(IS_SYMBOL[x.data])
    columns = [
        np.ones(len(size)),
        np.log1p(words) / 6,
        words < 6,
        np.minimum(symbols * 4 / size, 1),
        symbols > 0,
        np.minimum(count(x.data == 0x21) * 4 / size, 1),
        upper / np.maximum(upper + lower, 1),
        np.minimum(count(IS_DIGIT[x.data]) * 2 / size, 1),
        np.minimum(count(x.data == 0x7C) * 8 / size, 1),
        np.minimum(count(IS_CODE[x.data]) * 8 / size, 1),
        T.sums_by_row(echo, x.line_words) / np.maximum(words, 1),
        T.sums_by_row(x.repeated, x.line_words) / np.maximum(words, 1),
        x.copied_line,
        ~IS_STOP[x.data[x.line_to - 1]],
        np.minimum(size / np.maximum(words, 1) / 12, 2),
    ]
    return np.stack([c.astype(np.float64) for c in columns], axis=1)
