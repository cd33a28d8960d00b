"""License notices against a search of whole texts without pieces, and against the texts they are found in."""

import random
import re
from collections import Counter

import regex

from lanewise.llm import licenses
from lanewise.llm.licenses import NOTICES, Finder, Notice
from lanewise.llm.queries import QUERIES
from tests.conftest import SF_DIR

SCHEMA = "doc_id long, text string, lang string, labels string, score string, spans string"
FINDER = Finder()


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def base(text):
    found = words(text)
    places = []
    for phrase, label in {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}.items():
        part = phrase.split()
        places += [(i, label) for i in range(len(found)) if found[i : i + len(part)] == part]
    at = sorted(i for i, _ in places)
    return len(found), len(at), at[0] if at else None, at[-1] if at else None, ",".join(sorted({label for _, label in places}))


def whole(text):
    """Notices that a search of the whole text finds, as (label, edits), without those a better one overlaps."""
    form = f" {' '.join(words(text))} "
    found = []
    for notice in NOTICES:
        pattern = regex.compile(rf"(?e)(?<= )(?:{regex.escape(notice.text, literal_spaces=True)}){{e<={notice.errors}}}(?= )")
        found += [(notice.label, m.start(), m.end(), sum(m.fuzzy_counts)) for m in pattern.finditer(form)]
    return {x for x in found if not any(y[1] < x[2] and x[1] < y[2] and y[0] != x[0] and y[3] < x[3] for y in found)}


def spans(text):
    return {(s.label, s.start, s.end, s.edits) for s in FINDER.spans(licenses.normal(text))}


def broken(rng, text, errors):
    """The text with so many characters dropped, put in or changed."""
    for _ in range(errors):
        at, new = rng.randrange(1, len(text) - 1), rng.choice("abcxyz")
        text = text[:at] + rng.choice([text[at + 1 :], new + text[at:], new + text[at + 1 :]])
    return text


def test_notices_with_errors_are_found_as_in_a_whole_search():
    rng = random.Random(1)
    fill = ["the", "of", "license", "under", "public", "copy", "and", "software", "été", "x1"]
    hits = 0
    for _ in range(250):
        parts = [rng.choice(fill) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            notice = rng.choice(NOTICES)
            parts.insert(rng.randint(0, len(parts)), broken(rng, notice.text, rng.randint(0, notice.errors + 1)).title())
        text = " # ".join(parts)
        assert spans(text) == whole(text), text
        hits += len(whole(text))
    assert hits > 150


def test_a_short_name_is_not_taken_for_another():
    for text, label in {"under the MPL license": None, "Under the BSD license": "bsd", "under the bit license": "mit", "emit licenses": None}.items():
        assert {s[0] for s in spans(text)} == ({label} if label else set()), text
    assert {s[0] for s in spans("GNU Lesser General Public License")} == {"lgpl"}


def test_pieces_cover_the_notice():
    for notice in (*NOTICES, Notice("x", "abcdefg", 0), Notice("x", "abcdefg", 6)):
        parts = licenses.pieces(notice)
        assert "".join(piece for _, piece in parts) == notice.text and len(parts) == notice.errors + 1
        assert all(notice.text.startswith(piece, at) and piece for at, piece in parts)


HARD = [
    None, "", " \n", "MIT License", "mit  license, mit-license\nMIT\tLICENSE mit license", "smit license", "the Apache\n# License; General Public License",
    "Licenced under the Apachee License, Version 2.0. ALL RIGTS RESERVED.", "Ünder the mit license É under the MİT license",
    "word " * 60_000 + "released under the MIT Licence", "under the mit license " * 5_000, "ABC\x00\x1cDEF mit\x7flicense",
]


def test_rows(spark):
    rows = [(i, text, "en", "l", "s", "x") for i, text in enumerate(HARD)] + [(None, "MIT license", None, None, None, None)] + [(3, "MIT License", "en", "l", "s", "x")]
    found = licenses.scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert Counter((r.doc_id, *r[1:6]) for r in found) == Counter((r[0], *base(r[1])) for r in rows)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].labels for i in (0, 1, 2, 5, 6, 7)] == ["", "", "", "", "apache,gpl", "apache,reserved"]
    assert by_id[0].score == 0 and by_id[3].score == 1 and 0.9 < by_id[7].score < 1 and by_id[9].labels == "mit"
    for row in found:
        text = dict(enumerate(HARD)).get(row.doc_id) or ""
        for span in row.spans:
            part = text[span.start : span.end]
            assert words(part) and span.edits <= 3 and words(part[0]) and words(part[-1])
            assert spans(part) & {(span.label, 1, len(" ".join(words(part))) + 1, span.edits)}
    assert len(by_id[10].spans) == 5_000
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    """Over the whole table: fixed phrases word by word, and labels from a search without pieces."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = QUERIES["op13_license_scan"](spark, SF_DIR).collect()
    assert len(found) == len(texts) and sum(r.n_base > 0 for r in found) > 0
    for row in found:
        assert tuple(row)[1:6] == base(texts[row.doc_id])
        labels = {x for x in row.base_labels.split(",") if x} | {x[0] for x in whole(texts[row.doc_id])}
        assert row.labels == ",".join(sorted(labels)) and 0 <= row.score <= 1 and (row.score > 0) == bool(labels)
