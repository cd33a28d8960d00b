"""License notices: fixed phrases, and short notices with a few wrong characters, found from exact pieces of them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame

from lanewise.llm.common import texts


@dataclass(frozen=True)
class Notice:
    """Words of a notice in lower case, one space between them, and the wrong, missing or added characters it may have."""

    label: str
    text: str
    errors: int


#: Phrases and labels of the contract; fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Openings of widely used licenses and the short forms by which files refer to them. Where the name itself is short, one
#: error at most: with two, "mpl" would pass for "mit".
NOTICES = (
    Notice("mit", "under the mit license", 1),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 3),
    Notice("apache", "under the apache license", 2),
    Notice("apache", "you may not use this file except in compliance with the license", 3),
    Notice("gpl", "gnu general public license", 2),
    Notice("lgpl", "gnu lesser general public license", 2),
    Notice("agpl", "gnu affero general public license", 2),
    Notice("bsd", "under the bsd license", 1),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 3),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 3),
    Notice("unlicense", "free and unencumbered software released into the public domain", 3),
    Notice("cc", "licensed under cc by", 1),
    Notice("cc", "creative commons attribution", 2),
    Notice("reserved", "all rights reserved", 1),
)

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
_GAPS = bytes(byte if chr(byte).isascii() and chr(byte).isalnum() or byte >= 0x80 else 0x20 for byte in range(256))


@dataclass(frozen=True)
class Span:
    """A notice in a text: characters [start, end) of its normal form, and the errors it was found with."""

    label: str
    start: int
    end: int
    edits: int
    score: float


def normal(text: str) -> str:
    """The words in lower case (A-Z only) between single spaces, one also at either end."""
    return f" {b' '.join(text.encode().lower().translate(_GAPS).split()).decode()} "


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """(offset, piece): the notice cut into one more piece than it may have errors, so that one of them stands unchanged."""
    n = notice.errors + 1
    cuts = [len(notice.text) * i // n for i in range(n + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Finder:
    """Finds notices in normal forms. Pieces of all notices are looked up at once; around the places where one stands,
    the bounded-error pattern of its notice decides."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES):
        self.notices = notices
        # A match starts and ends with whole words.
        self.patterns = [regex.compile(rf"(?e)(?<= )(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.errors}}}(?= )") for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            for offset, piece in pieces(notice):
                seeds.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(notice, start, end): stretches of the text that hold every match of the notice.

        Starts that a piece asks for are taken together while they lie within a notice's length of the first, so a window
        stays short however often the pieces occur; windows overlap so that each start has its whole surroundings in one.
        """
        starts: dict[int, list[int]] = {}
        for end, (length, uses) in self.automaton.iter(text):
            for number, offset in uses:
                starts.setdefault(number, []).append(end + 1 - length - offset)
        for number, found in starts.items():
            length, slack = len(self.notices[number].text), self.notices[number].errors
            found.sort()
            first = last = found[0]
            for at in [*found[1:], None]:
                if at is None or at - first > length:
                    # One character more on either side, for the spaces that a match stands between.
                    yield number, max(0, first - slack - 1), min(len(text), last + length + 2 * slack + 1)
                    first = at
                last = at

    def spans(self, text: str) -> list[Span]:
        """Matches in a normal form. Of two that overlap under different labels, the one with more errors goes."""
        found = set()
        for number, start, end in self.windows(text):
            notice = self.notices[number]
            for match in self.patterns[number].finditer(text, start, end):
                edits = sum(match.fuzzy_counts)
                found.add(Span(notice.label, match.start(), match.end(), edits, 1.0 - edits / len(notice.text)))
        return clear(found)


def clear(found: set[Span]) -> list[Span]:
    """Without those that overlap a span of another label with fewer errors."""
    kept, by_start = [], sorted(found, key=lambda s: (s.start, s.end, s.label, s.edits))
    reach = max((s.end - s.start for s in by_start), default=0)
    low = 0
    for span in by_start:
        while by_start[low].start < span.start - reach:
            low += 1
        rival = False
        for other in by_start[low:]:
            if other.start >= span.end:
                break
            rival |= other.end > span.start and other.label != span.label and other.edits < span.edits
        if not rival:
            kept.append(span)
    return kept


def places(text: str) -> list[tuple[int, int, str]]:
    """(character, word, label) of each place in a normal form where the words of a fixed phrase follow each other."""
    found = []
    for phrase, label in PHRASES.items():
        at = text.find(f" {phrase} ")
        while at >= 0:
            found.append((at + 1, text.count(" ", 0, at), label))
            at = text.find(f" {phrase} ", at + 1)
    return sorted(found)


def original(text: str, spans: list[Span]) -> list[tuple[str, int, int, int]]:
    """(label, start, end, edits) with the code points of the text itself instead of its normal form."""
    if not spans:
        return []
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    starts, ends, at = {}, {}, 1
    for m in WORD.finditer(lower):
        starts[at], ends[at + m.end() - m.start()] = m.start(), m.end()
        at += m.end() - m.start() + 1
    return [(s.label, starts[s.start], ends[s.end], s.edits) for s in spans]


SCHEMA = """doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,
score double, spans array<struct<label string, start long, end long, edits int>>"""


def scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) per row of `docs`, over whole texts.

    The fixed phrases are found as they are, notices with up to their number of errors. Spans are code points of the
    text, end exclusive. The score is that of the best match: 1 without errors (and for a fixed phrase), less the share of
    wrong characters otherwise, 0 without a match. A missing or empty text has no words, no labels and score 0. Each row is
    scanned by itself: repeated rows, ties and an empty table need no rule, and other columns are not read. Work and memory
    are in proportion to a text's length, however often a notice stands in it.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(notices)
        for frame in frames:
            out = []
            for text in frame["text"]:
                form = normal(text)
                base, spans = places(form), finder.spans(form)
                words = [word for _, word, _ in base]
                labels = {label for _, _, label in base}
                score = 1.0 if base else max((s.score for s in spans), default=0.0)
                more = labels | {s.label for s in spans}
                counts = (len(form.split()), len(base), min(words, default=None), max(words, default=None))
                out.append((*counts, ",".join(sorted(labels)), ",".join(sorted(more)), score, original(text, spans)))
            found = pd.DataFrame(out, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
            for name in ("first_word", "last_word"):
                found[name] = found[name].astype("Int64")
            found["spans"] = [[dict(zip(("label", "start", "end", "edits"), span)) for span in spans] for spans in found["spans"]]
            found.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield found

    return texts(docs, id_col, text_col).mapInPandas(run, SCHEMA)
