"""The pipeline's stages on hard rows, their effects, and the whole of it on the small tables."""

import hashlib
from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
from lanewise.llm import personal_data, simhash
from lanewise.llm.common import table
from lanewise.sources import stage
from tests.conftest import SF_DIR
from tests.helpers import plan


def test_stages_take_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, SF_DIR))
        seen[name] = docs
        assert name == "tokens" or docs.columns == columns
        assert docs.count() > 0 and before.count() > 0
    assert seen["quality"].count() < table(spark, SF_DIR, "documents").count()
    groups = simhash.groups(seen["quality"]).select("component_id").distinct().count()
    assert seen["near_duplicates"].count() == groups
    assert personal_data.find(seen["private"]).where("base_sha256 != sha2('', 256)").count() == 0
    assert seen["mix"].select("doc_id").distinct().count() <= seen["private"].count()
    assert seen["tokens"].count() == seen["mix"].count()
    # The bytes of the ids are those of the texts that the mix gave.
    texts = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in seen["mix"].collect())
    assert Counter((r.doc_id, r.decoded_sha256) for r in seen["tokens"].select("doc_id", "decoded_sha256").collect()) == texts


def test_run_and_contract(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0
    names = contract.queries()
    assert "pipeline" in names and len([x for x in names if x.startswith("op")]) == 13
    assert set(contract.oracle_sql()) <= set(names)


def test_stages_on_hard_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, "x"), (None, "some text without an id", "en", None, 23, "x"), (4, "again " * 50, "de", "b", 300, "x")]
    docs = spark.createDataFrame(rows + rows[3:], schema)
    for frame in (docs, docs.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            frame = stage(step(spark, frame, SF_DIR))
            assert name == "tokens" or frame.columns == docs.columns


def test_only_rows_of_repeated_ids_are_fingerprinted_twice(spark):
    """The rows that stay are picked by id; no Python runs over the documents again."""
    docs = spark.createDataFrame([(i, f"some words and number {i // 2} and more of them") for i in range(40)], "doc_id long, text string")
    out = simhash.keep_one(docs)
    assert "Python" not in plan(out) and out.count() == 20
    again = simhash.keep_one(docs.unionByName(docs.limit(4)))
    assert again.count() == 20


def test_tokens_take_smaller_blocks(monkeypatch):
    """Beside the ids and what earlier stages left in memory, a task holds blocks a third as large as the operator's own."""
    from lanewise.llm import bpe

    seen = []
    monkeypatch.setattr(bpe, "digests", lambda docs, path, pattern, max_chars, with_ids: seen.append((max_chars, with_ids)))
    corpus_pipeline.tokens(None, None, "")
    assert seen == [(bpe.BLOCK_CHARS // 3, True)]


def test_quality_takes_smaller_blocks(monkeypatch, spark):
    """Beside what earlier stages left in memory, a task holds blocks a quarter as large as the operator's own; the rows are the same."""
    from lanewise.llm import kneser_ney, quality_model
    from lanewise.llm.common import BLOCK_CHARS
    from lanewise.llm.queries import trusted

    docs, seen, blocks = table(spark, SF_DIR, "documents"), [], kneser_ney.blocks
    monkeypatch.setattr(kneser_ney, "blocks", lambda rows, train, max_chars, *rest: seen.append(max_chars) or blocks(rows, train, 20_000, *rest))
    kept = corpus_pipeline.quality(spark, docs, SF_DIR)
    assert seen == [BLOCK_CHARS // 4]
    monkeypatch.undo()
    whole = quality_model.keep_good(docs, trusted(spark, SF_DIR))
    assert kept.exceptAll(whole).isEmpty() and whole.exceptAll(kept).isEmpty()
