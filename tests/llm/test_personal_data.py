"""Spans of the field: obfuscated addresses, and what fixed patterns leave of a run of words."""

from lanewise.llm import personal_data


class Alike:
    """A field that gives every word one label."""

    def __init__(self, label):
        self.label = label

    def decode(self, sequences):
        return [[self.label] * len(x) for x in sequences]


def spans(text, field=None):
    return personal_data.found_spans([(text, personal_data.base_spans(text))], field or personal_data.model())[0]


def test_obfuscated_addresses_are_found():
    for text, value in (("email anna[at]example.com for", "anna[at]example.com"), ("write to max(at)mail.de, please", "max(at)mail.de")):
        start = text.index(value)
        assert spans(text) == [(start, "crf_email", start + len(value))], text
    assert spans("we met (at) noon in the") == []


def test_base_spans_are_taken_out_of_a_run():
    text = "john@example.com max@localhost"
    assert personal_data.base_spans(text) == [(0, "email", 16)] and spans(text, Alike("email")) == [(17, "crf_email", 30)]
    text = "a@b.com x@y p@q.org z@w"
    assert spans(text, Alike("email")) == [(8, "crf_email", 11), (20, "crf_email", 23)]
    assert spans("4111 1111 1111 1111", Alike("card")) == []  # all of it is a base span
    text = "4111 1111 1111 1111, 4111 1111 1111 1112"
    assert spans(text, Alike("card")) == [(21, "crf_card", 40)]
    text = "4111 1111 1111 1111 4111 1111 1111 1112"  # too many digits for the fixed pattern
    assert spans(text) == [(0, "crf_card", len(text))]


def test_redaction_leaves_none_of_it(spark):
    texts = ["write to max(at)mail.de please", "card 4111 1111 1111 1111, 4111 1111 1111 1112 expires"]
    frame = spark.createDataFrame([(x,) for x in texts], "text string")
    found = [r.text for r in personal_data.redacted(frame).collect()]
    assert found == ["write to [email] please", "card [card], [card] expires"]


def test_long_runs_keep_context_across_parts():
    """A number with its cue on each side of every place near word 64, against one decoding of the whole run."""
    field = personal_data.model()
    for before in range(52, 76):
        for cue, value in (("my ssn is", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00"), ("call me at", "(555) 123-4567")):
            words = [x for i in range(40) for x in ("page", str(i + 10), "of")][:before] + cue.split() + value.split() + ["and", "page", "7", "of"] * 12
            text = " ".join(words)
            run = list(personal_data._sequences(text))
            assert len(run) == 1 and len(run[0]) > 64
            labels = field.decode([personal_data._features([text[a:b] for a, b in run[0]])])[0]
            found = spans(text)
            if cue != "iban":  # the field itself leaves the IBAN's last two digits in such a run
                start = text.index(f" {value} ") + 1
                assert (start, start + len(value)) in {(a, b) for a, _, b in found}, (before, value)
            marked = {i for i, (a, _) in enumerate(run[0]) if any(x <= a < y for x, _, y in found)}
            assert marked == {i for i, x in enumerate(labels) if x != "none"}, (before, value)
