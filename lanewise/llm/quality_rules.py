"""Quality rules on repetition: characters inside n-grams and lines that occur more than once in a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from lanewise.llm.common import texts

#: Largest share of a text's word characters inside repeated n-grams, by n-gram length; lines as share of all line characters.
NGRAM_LIMITS = {4: 0.50, 5: 0.45, 6: 0.42, 7: 0.40, 8: 0.38, 9: 0.36, 10: 0.34}
LINE_LIMIT = 0.35
SYMBOL_LIMIT = 0.10
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _mixed(codes: np.ndarray) -> np.ndarray:
    h = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def _covered(repeated: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of `total` words lie in a window of n words that is marked."""
    change = np.zeros(total + 1, dtype=np.int32)
    starts = np.flatnonzero(repeated)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def _twice(keys: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more."""
    held = np.sort(keys)
    again = held[1:][held[1:] == held[:-1]]
    if not len(again):
        return np.zeros(len(keys), dtype=bool)
    return again[np.minimum(np.searchsorted(again, keys), len(again) - 1)] == keys


def _word_chars(data: bytes) -> np.ndarray:
    """Code points of each word."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inner = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
    edges = np.flatnonzero(np.diff(inner.astype(np.int8), prepend=0, append=0))
    before = np.concatenate([[0], np.cumsum(inner & ((raw & 0xC0) != 0x80))])
    return before[edges[1::2]] - before[edges[::2]]


def measure(text: str, lengths: tuple[int, ...] = tuple(NGRAM_LIMITS)) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, line_chars, {n: characters}).

    Windows of three words are compared exactly, longer ones by 64-bit rolling hashes over the words' numbers.
    """
    data = text.encode()
    words = data.split()
    n = len(words)
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    word_chars = len(b"".join(words)) - (len(data) - len(text))  # bytes after a character's first are never white space
    seen, n_dup_lines, dup_line_chars, line_chars = set(), 0, 0, 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            line_chars += len(line)
            if line in seen:
                n_dup_lines += 1
                dup_line_chars += len(line)
            seen.add(line)
    inside = dict.fromkeys(lengths, 0)
    n_repeat_words = 0
    if n >= 4:  # two windows of three words at least
        number = {word: i for i, word in enumerate(dict.fromkeys(words))}
        codes = np.fromiter(map(number.__getitem__, words), np.uint64, n)
        pair = codes[:-1] * np.uint64(len(number)) + codes[1:]
        if len(number) >= 1 << 21:
            _, pair = np.unique(pair, return_inverse=True)
        again = _twice(pair.astype(np.uint64)[:-1] * np.uint64(len(number)) + codes[2:])
        if again.any():
            n_repeat_words = int(_covered(again, 3, n).sum())
            mixed = rolled = _mixed(codes)
            chars = None
            for at in range(2, max(lengths) + 1):
                if at > n:
                    break
                rolled = rolled[: n - at + 1] * _BASE + mixed[at - 1 :]
                if at > 3:
                    # A repeated window consists of two repeated windows that are a word shorter.
                    places = np.flatnonzero(again[:-1] & again[1:])
                    again = np.zeros(n - at + 1, dtype=bool)
                    again[places[_twice(rolled[places])]] = True
                    if not again.any():
                        break
                if at > 3 and at in inside:
                    chars = _word_chars(data) if chars is None else chars
                    inside[at] = int(chars[_covered(again, at, n)].sum())
    return n, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, line_chars, inside


def quality(docs: DataFrame, limits: dict[int, float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict per row of `docs`.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows of three. kept: not base_failed,
    and no share above its limit: word characters inside repeated n-grams for each length in `limits`, characters of
    repeated lines, and symbols per word character. A missing or empty text has no words and is not kept. Each row is
    judged by itself, so repeated rows, ties and empty tables need no rule of their own.
    """
    limits = dict(NGRAM_LIMITS if limits is None else limits)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text in frame["text"]:
                n, chars, symbols, lines, repeat, dup_chars, line_chars, inside = measure(text, tuple(limits))
                failed = n < MIN_WORDS or 100 * repeat > 50 * n
                shares = max((inside[k] / chars - limit for k, limit in limits.items()), default=-1.0) if chars else 0.0
                good = shares <= 0 and dup_chars <= LINE_LIMIT * line_chars and symbols <= SYMBOL_LIMIT * chars
                out.append((n, chars, symbols, lines, repeat, failed, not failed and good, inside.get(max(limits), 0), dup_chars))
            found = pd.DataFrame(out, columns=[name.split()[0] for name in _SCHEMA.split(", ")[1:]])
            found.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield found

    return texts(docs, id_col, text_col).mapInPandas(run, _SCHEMA)


_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, chars_in_longest long, chars_in_dup_lines long"
)
