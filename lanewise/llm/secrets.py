"""Secrets: fixed patterns, and strings next to sensitive words that a primed compressor finds nothing familiar in."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame

from lanewise.llm.common import texts

#: Kinds and patterns of the contract; fixed values.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Words that make a string beside them worth measuring.
SENSITIVE = ("secret", "token", "password", "passwd", "apikey", "api_key", "api-key", "access_key", "private_key", "private key", "credential", "bearer", "authorization", "client_secret", "auth")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
SENSITIVE_RE = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
#: Characters around a candidate: in which a sensitive word must stand before it, and which prime the compressor.
NEAR, AROUND = 48, 512
#: What may stand between the lines of one secret: a line break, or the backslash of one written as \\n, is among it.
BETWEEN = re.compile(r"""(?=[^\n]*[\n\\])(?:[\s"'+,]|\\[nr]?){1,40}""")
#: A string is novel if the frame grows by at least this share of its length. Random base64 needs 0.75, random hex 0.5.
NOVELTY = 0.45
#: The dictionary of the compressor: identifiers and code as they stand beside secrets without being one.
DICTIONARY = """
authorization_header access_token_url refresh_token_expiry client_secret_name private_key_path public_key_path
token_type_bearer password_reset_link password_confirmation secret_manager_client credentials_provider_chain
example_password_placeholder your_api_key_here insert_token_here changeme_please replace_with_secret
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 1111111111111111 xxxxxxxxxxxxxxxx
XXXXXXXXXXXXXXXX ---------------- ================ ________________ application/x-www-form-urlencoded
https://www.example.com/index.html?query=value&page=1 /usr/local/share/applications/ /home/user/documents/
def __init__(self, config): return self.configuration.get(key, default) import from class function const let var public
static final String getAuthorizationToken() setClientCredentials() System.getenv("SECRET_KEY") os.environ["API_TOKEN"]
createAuthenticationManager AbstractAuthenticationProcessingFilter UsernamePasswordAuthenticationToken
internationalization characteristics responsibilities configuration implementation authentication
""".strip()


def _compressor(around: bytes) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(DICTIONARY.encode() + b"\n" + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)


def novelty(text: str, start: int, end: int) -> float:
    """Bytes that the candidate adds to the compressed line around it, per character of its own.

    The compressor is primed with the dictionary and with the text on both sides, so what a candidate shares with other
    words there costs next to nothing. Copies of the whole candidate are blanked, as a secret may stand there twice.
    """
    value, blank = text[start:end], "\n" * (end - start)
    reach = AROUND + end - start
    before = text[max(0, start - reach) : start].replace(value, blank)[-AROUND:].encode()
    after = text[end : end + reach].replace(value, blank)[:AROUND].encode()
    compress = _compressor(before + after).compress
    frame = before[-64:]
    return (len(compress(frame + text[start:end].encode())) - len(compress(frame))) / (end - start)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, each kind leftmost and without overlaps."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def novel_spans(text: str, taken: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Candidates beside a sensitive word, or on lines that go on from such a one, outside the fixed patterns' spans, that the primed compressor cannot shorten."""
    lower = text.lower()
    if not any(word in lower for word in SENSITIVE):
        return []
    found, beside, last = [], False, 0
    for m in CANDIDATE.finditer(text):
        value, start, end = m[0], m.start(), m.end()
        carried = beside and start - last <= 40 and BETWEEN.fullmatch(text, last, start)
        beside, last = bool(carried or SENSITIVE_RE.search(text, max(0, start - NEAR), start)), end
        if not beside or not (any(map(str.isdigit, value)) and any(map(str.isalpha, value))):
            continue
        if any(a < end and start < b for a, _, b in taken):
            continue
        if novelty(text, start, end) >= NOVELTY:
            found.append((start, "novel", end))
    return found


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of `docs`, over whole texts.

    Spans count code points, end exclusive, by start and then kind; `novel` ones come from the compressor. A missing or
    empty text has none. Each row is scanned by itself, so repeated rows, ties and empty tables need no rule.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text in frame["text"]:
                base = base_spans(text)
                spans = sorted(base + novel_spans(text, base), key=lambda x: (x[0], KINDS.index(x[1])))
                counts = [sum(kind == k for _, k, _ in base) for kind in KINDS[:3]]
                out.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            found = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            found.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield found

    return texts(docs, id_col, text_col).mapInPandas(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
