"""Personal data: fixed patterns, and what a conditional random field over word shapes finds beside them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm import crf
from lanewise.llm.common import WORDS_SQL, texts

#: Kinds of the contract, in its order; fixed values. Kinds of the field follow.
KINDS = ("email", "ip", "card", "phone")
FOUND_KINDS = ("crf_card", "crf_email", "crf_id", "crf_phone")
ORDER = {kind: i for i, kind in enumerate((*KINDS, *FOUND_KINDS))}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number before the first dot begins where its digits begin, so no later start can match what an earlier one cannot.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(WORDS_SQL)
#: What stands for @ in obfuscated addresses.
_AT = re.compile(r"[(\[{<]at[)\]}>]", re.IGNORECASE | re.ASCII)
#: Words on each side of a word with a digit or @ (or what stands for it) that belong to its sequence.
WINDOW = 4
#: Parts that are decoded together; words of a part, and words on each side that are decoded with it for their context.
BATCH = 2000
PART, MARGIN = 64, 16

#: The labelled table: texts with <kind|value> around personal data.
LABELLED = """
call me at <phone|555-123-4567> tomorrow morning
my phone is <phone|(555) 123-4567> and I am home
phone: <phone|030 1234567> or write
tel <phone|555.867.5309> after six
telephone <phone|0171 2345678> please
mobile <phone|07700 900123> any time
reach her on <phone|(212) 555-0187> at work
fax <phone|212-555-0199> in the office
please ring <phone|020 7946 0018> for the booking
number is <phone|415-555-2671> thanks
cell: <phone|650 555 1234> today
Tel.: <phone|089/123456> and
contact <phone|1-800-555-0100> for help
dial <phone|555-0134> now
appelez le <phone|06 12 34 56 78> demain
telefon <phone|0049 30 123456> oder
ssn <id|123-45-6789> on file
my ssn is <id|078-05-1120> and
social security number <id|219-09-9999> was
SSN: <id|457-55-5462> please
tax id <id|12-3456789> for
passport <id|C01X00T47> issued
passport number <id|X1234567> expires
iban <id|DE89 3704 0044 0532 0130 00> bank
IBAN: <id|GB29NWBK60161331926819> account
account iban <id|FR1420041010050500013M02606> is
card <card|4111 1111 1111 1112> expires
credit card <card|5500-0000-0000-0005> used
visa <card|4012888888881882> was charged
card number <card|3782 822463 10006> today
mail me <email|john@localhost> now
email <email|anna[at]example.com> for
write to <email|max(at)mail.de> please
contact <email|info@intranet> or
in 2019 the house was sold
since 1998 and until 2004 they lived
on 2023-01-15 the meeting
on 12/05/2021 at noon
at 10:30 or 11:45 we
about 3 of 10 people said
it costs $19.99 or 25 euros
page 123 of 456 in the book
chapter 7 section 3.2 says
version 2.0 of the License
Licensed under the Apache License, Version 2.0.
Copyright 2021 the authors. All rights reserved.
Copyright (c) 2010-2020 Example Corp.
ISBN 978-3-16-148410-0 was printed
room 101 on floor 12
order 4711 was shipped
order number 100234567 was shipped
12,345 people and 1,000,000 more
the 2nd and 3rd of 4 runs
score 3-2 and 21-14 after
between 1914-1918 and 1939-1945 there
temperature -5 to 12 degrees
build 20230115 of main at 12
commit 3f2a9c1 fixed it
token = "11acdfb36bb72224148e6160f674b4be45601bff" in the
key 6df57b16f87eabefefcab67b433efd90636bb6bd here
item 5501234567 in stock
see line 1234 in file2 of lib64
3.14159 is near 22/7 and
grew by 12.5% in q3 of
@user said hello to @other and
width 1920x1080 at 60 hz
id 8646308210557563 of the record
route 66 and highway 101 are
windows 10 and mp3 files on usb3
a 100 b 200 c 300 d 400
""".strip().split("\n")


def _shape(word: str) -> str:
    """Digits by their number, letters by case, anything else as it is."""
    out = re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", lambda m: f"{min(len(m[0]), 9)}", "".join("a" if c.isalpha() and not c.isupper() else "A" if c.isalpha() else c for c in word)))
    return re.sub(r"a+", "a", out)[:24]


def _features(words: list[str]) -> list[list[str]]:
    """Features of each word: its shape, its digits, and shapes and words around it."""
    shapes = [_shape(word) for word in words]
    plain = [re.sub(r"[^a-z]", "", word.lower()) if not _DIGIT.search(word) else "#" for word in words]
    out = []
    for i, word in enumerate(words):
        digits = sum("0" <= c <= "9" for c in word)
        marks = "".join(sorted({c for c in word if not c.isalnum()}))
        place = ["bias", f"shape={shapes[i]}", f"digits={min(digits, 20)}", f"marks={marks}", f"some={bool(digits)}", f"word={plain[i]}"]
        for step in (-2, -1, 1, 2):
            if 0 <= i + step < len(words):
                place += [f"{step}:{plain[i + step]}", f"{step}:{shapes[i + step]}" if abs(step) == 1 else f"{step}:some={'#' == plain[i + step]}"]
            else:
                place.append(f"{step}:none")
        out.append(place)
    return out


def _part_features(words: list[str], first: int, stop: int) -> list[list[str]]:
    """The features of words[first:stop] as they are in the whole run; features reach two words to each side."""
    low = max(0, first - 2)
    return _features(words[low : stop + 2])[first - low : stop - low]


@lru_cache(maxsize=1)
def model() -> crf.Crf:
    """The field, trained on the labelled table."""
    sequences, labels = [], []
    for line in LABELLED:
        words, kinds = [], []
        for value in re.findall(r"<[^>]*>|[^<]+", line):
            kind, _, value = value[1:-1].partition("|") if value[0] == "<" else ("none", "", value)
            words += value.split()
            kinds += [kind] * len(value.split())
        sequences.append(_features(words))
        labels.append(kinds)
    return crf.train(sequences, labels)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns: leftmost, without overlaps within a kind, by start and then kind."""
    found = []
    if "@" in text:
        end = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                end = m.end()
                found.append((start, "email", end))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                found.append((m.start(), "ip", m.end()))
        for m in _CARD.finditer(text):
            if 14 <= len(m[0]):
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda x: (x[0], ORDER[x[1]]))


def _sequences(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of words, as (start, end), around the words with a digit or @, or what stands for it."""
    if not (_DIGIT.search(text) or "@" in text or _AT.search(text)):
        return
    words = [m.span() for m in _WORD.finditer(text)]
    run, last = [], -1
    for i, (start, end) in enumerate(words):
        word = text[start:end]
        if "@" in word or _DIGIT.search(word) or _AT.search(word):
            first = max(0, i - WINDOW)
            if run and first > last:
                yield run
                run = []
            run += words[max(first, last) : i + WINDOW + 1]
            last = min(len(words), i + WINDOW + 1)
    if run:
        yield run


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while end > start and (text[end - 1] in ".,;:!?\"'" or text[end - 1].isspace()):
        end -= 1
    while start < end and (text[start] in "\"'" or text[start].isspace()):
        start += 1
    return start, end


def _outside(text: str, start: int, end: int, base: list[tuple[int, str, int]]) -> Iterator[tuple[int, int]]:
    """What base spans (ascending) leave of a span."""
    for a, _, b in base:
        if a < end and start < b:
            if start < a:
                yield start, a
            start = max(start, b)
            while start < end and text[start] in ".,;:!?":
                start += 1
    if start < end:
        yield start, end


def found_spans(items: list[tuple[str, list[tuple[int, str, int]]]], field: crf.Crf) -> list[list[tuple[int, str, int]]]:
    """Per (text, base spans), the spans that the field adds: runs of one kind, less the base spans, that hold a digit or @.

    An email may hold what stands for @ instead.
    """
    out: list[list] = [[] for _ in items]
    waiting: list[tuple[int, list]] = []

    def settle():
        words = [[items[i][0][a:b] for a, b in run] for i, run in waiting]
        parts = [(k, first) for k, (_, run) in enumerate(waiting) for first in range(0, len(run), PART)]
        decided: list[list[str]] = [[] for _ in waiting]
        for low in range(0, len(parts), BATCH):
            some = parts[low : low + BATCH]
            decoded = field.decode([_part_features(words[k], max(0, first - MARGIN), first + PART + MARGIN) for k, first in some])
            for (k, first), labels in zip(some, decoded):
                skip = first - max(0, first - MARGIN)
                decided[k] += labels[skip : skip + PART]
        for (i, run), labels in zip(waiting, decided):
            text, base = items[i]
            at = 0
            while at < len(run):
                stop = at + 1
                while stop < len(run) and labels[stop] == labels[at]:
                    stop += 1
                if labels[at] != "none":
                    for start, end in _outside(text, run[at][0], run[stop - 1][1], base):
                        start, end = _trimmed(text, start, end)
                        value = text[start:end]
                        if _DIGIT.search(value) or "@" in value or labels[at] == "email" and _AT.search(value):
                            out[i].append((start, f"crf_{labels[at]}", end))
                at = stop
        waiting.clear()

    for i, (text, _) in enumerate(items):
        for run in _sequences(text):
            waiting.append((i, run))
            if len(waiting) >= BATCH:
                settle()
    settle()
    return out


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def _frame_spans(values: list[str], field: crf.Crf) -> Iterator[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    items = [(text, base_spans(text)) for text in values]
    for (_, base), more in zip(items, found_spans(items, field)):
        yield base, sorted(base + more, key=lambda x: (x[0], ORDER[x[1]]))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of `docs`, over whole texts.

    Counts and digest are those of the fixed patterns; `spans` also has those of the field (kinds crf_...). A missing or
    empty text has none. Each row is searched by itself, so repeated rows, ties and empty tables need no rule.
    """
    field = model()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for base, spans in _frame_spans(frame["text"].tolist(), field):
                counts = [sum(kind == k for _, k, _ in base) for kind in KINDS]
                out.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            found = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
            found.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield found

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return texts(docs, id_col, text_col).mapInPandas(run, schema)


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with every span replaced by its kind, as in [email]; overlapping spans become one, named after the first.

    Other columns stay, and `n_chars`, where it exists, follows the text. A missing text stays missing.
    """
    field = model()

    @F.pandas_udf("string")
    def clean(values: pd.Series) -> pd.Series:
        given = [x if isinstance(x, str) else "" for x in values]
        out = []
        for text, (_, spans) in zip(given, _frame_spans(given, field)):
            parts, at = [], 0
            for start, kind, end in spans:
                if start >= at:
                    parts += [text[at:start], f"[{kind.removeprefix('crf_')}]"]
                at = max(at, end)
            out.append("".join([*parts, text[at:]]))
        return pd.Series([x if isinstance(v, str) else None for x, v in zip(out, values)], dtype=object)

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
