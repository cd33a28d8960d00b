"""Secrets that stand twice, and secrets over several lines."""

import base64

import numpy as np

from lanewise.llm import secrets

KEY = "q8Zt3LmX0vR7pKd2WbYc5HsJ"


def novel(text):
    return [text[a:b] for a, _, b in secrets.novel_spans(text, secrets.base_spans(text))]


def test_repeated_keys_are_found():
    for gap in ("", "and then " * 10, "x " * 250):
        text = f"the bearer {KEY} was sent, {gap} the bearer {KEY} was sent again"
        assert novel(text) == [KEY, KEY], gap
    assert novel("\n".join(f"retry {i}: bearer {KEY}" for i in range(5))) == [KEY] * 5
    name = "UsernamePasswordAuthenticationToken1"
    assert novel(f"bearer {name} or bearer {name}") == []


def test_all_lines_of_a_pem_key_are_found():
    body = base64.b64encode(np.random.default_rng(3).bytes(48 * 12)).decode()
    lines = [body[i : i + 64] for i in range(0, len(body), 64)]
    for join in ("\n", "\r\n", "\\n"):
        text = join.join(["-----BEGIN RSA PRIVATE KEY-----", *lines, "-----END RSA PRIVATE KEY-----"])
        assert novel(text) == lines or join == "\\n" and len(novel(text)) >= 11, join
    text = "\n".join(["-----BEGIN CERTIFICATE-----", *lines, "-----END CERTIFICATE-----", "token list"])
    assert novel(text) == []
    assert novel(f"bearer {lines[0]}\n\nsome other words stand here in between and go on for long\n{lines[1]}") == [lines[0]]
