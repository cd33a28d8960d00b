"""Token ids of texts with added tokens' text, against the library as it comes."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lanewise.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|> x <|ENDOFTEXT|> y", "no | marker < here >", "\u00e9<|endoftext|>\u00e9  z", "<|endoftext|><|endoftext|>"]


def test_markers_equal_the_library():
    library, ours = Tokenizer.from_file(PATH), token_files.WordIds(PATH)
    for text in TEXTS:
        assert np.frombuffer(ours(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_words_are_forgotten_by_halves(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 8)
    library, ours = Tokenizer.from_file(PATH), token_files.WordIds(PATH)
    for text in ["a b c", "a d e f", "a g", "one text of many more words than are kept", "a b", "", *TEXTS]:
        assert np.frombuffer(ours(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert len(ours.known) <= max(4, len(set(text.split())))


def test_rows_of_one_id_are_shared_out(spark):
    rows = spark.createDataFrame([(7, f"text {i}") for i in range(400)], "doc_id long, text string")
    written = token_files.write_tokens(rows, PATH)
    assert written.select("part").distinct().count() > 1
    found = token_files.read_tokens(written).orderBy("start").collect()
    assert len(found) == 400 and found[-1].start + found[-1].n_tokens == sum(r.n_tokens for r in found)


def test_files_with_markers(spark):
    library, at = Tokenizer.from_file(PATH), 0
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = {r.doc_id: r for r in token_files.read_tokens(token_files.write_tokens(docs, PATH)).collect()}
    for i, text in enumerate(TEXTS):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)


def test_pieces_are_tokenized_once(monkeypatch):
    """New words of known pieces cost no call of the model; the ids are those of the tokenizer."""
    path = public_tokenizers.path("word_bpe_49k.json")
    words, calls = token_files.WordIds(path), []
    tokenizer = words.tokenizer

    class Counting:
        model = type("Model", (), {"tokenize": staticmethod(lambda piece: calls.append(piece) or tokenizer.model.tokenize(piece))})()
        encode_batch_fast = staticmethod(tokenizer.encode_batch_fast)

    words.tokenizer = Counting()
    texts = ["shipping, costs.", "(shipping costs)", "SHIPPING; costs!", "costs, shipping. caf\u00e9"]
    for text in texts:
        assert list(np.frombuffer(words(text), dtype="<u4")) == tokenizer.encode(text, add_special_tokens=False).ids
    assert calls.count("shipping") == calls.count("costs") == 1


def test_plain_latin_words_go_straight_to_the_model():
    """No word of signs, digits and Latin letters costs the tokenizer's whole way; the ids are the tokenizer's all the same."""
    words, whole = token_files.WordIds(PATH), []
    tokenizer = words.tokenizer

    class Counting:
        model = tokenizer.model
        encode_batch_fast = staticmethod(lambda texts, **kwargs: whole.extend(texts) or tokenizer.encode_batch_fast(texts, **kwargs))

    words.tokenizer = Counting()
    plain = [x for x in [*range(0x21, 0x7F), *range(0xA1, 0x180)] if x not in (0xAD, 0x130)]
    texts = ["Stra\u00dfe, \u00d1and\u00fa's (caf\u00e9)", *[f"{chr(x)} a{chr(x)}b {chr(x)}'s" for x in plain], "", " \t\x0b\x0c\n", "\u00b2x\u00bd7\u00aa"]
    assert [list(np.frombuffer(x, dtype="<u4")) for x in words.many(texts)] == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert whole == []
    odd = ["\u0130x", "a\u00adb", "e\u0301a", "a\u00a0b", "a\x1cb", "a\u0085b", "\u03a3\u03a3 \u4e2d", "\u1e9e"]
    assert [list(np.frombuffer(x, dtype="<u4")) for x in words.many(odd)] == [tokenizer.encode(x, add_special_tokens=False).ids for x in odd]
    assert len(whole) == 9
