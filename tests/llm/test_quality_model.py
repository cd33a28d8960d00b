"""Thresholds of the quality model: bad texts go, and a language with hardly any trusted rows is not judged by those alone."""

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanewise.llm import kneser_ney, quality_model
from lanewise.llm.queries import QUERIES
from lanewise.session import shared_dir
from tests.llm.test_operators import plain_lm

SF_DIR = "/root/testdata/sf0.01"


def test_labelled_bad_texts_go(spark):
    found = QUERIES["op3_quality_model"](spark, SF_DIR).select("doc_id", "kept")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality")
    both = labels.join(found, "doc_id").toPandas()
    assert both[both.quality == 0].kept.mean() < 0.08
    assert both[both.quality == 1].kept.mean() > 0.98


def test_languages_with_one_and_two_trusted_rows(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(200)]
    weight = 1 / np.arange(1, 201)
    text = lambda: " ".join(rng.choice(words, 120, p=weight / weight.sum()))
    many = [(i, text(), "en") for i in range(300)]
    few = [(1000 + i, text(), lang) for i, lang in enumerate(["aa"] * 60 + ["bb"] * 60)]
    docs = spark.createDataFrame(many + few, "doc_id long, text string, lang string")
    for first in range(0, 60, 6):  # one row of aa and two of bb; some of them calibrate
        trusted = spark.createDataFrame([(i,) for i in [*range(200), 1000 + first, 1060 + first, 1061 + first]], "doc_id long")
        found = quality_model.classify(docs, trusted).toPandas()
        limits = found.groupby("lang").threshold.first()
        assert limits["aa"] == limits["bb"] and found[found.lang != "en"].kept.mean() > 0.95
        if first == 12:
            break


def quantile(values, share):
    return sorted(values)[math.ceil(share * len(values)) - 1]


def test_classify_equals_brute_force(spark):
    """Every column from dictionaries and sorted lists; only the draw of the rows to learn from is Spark's hash."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    weight = 1 / np.arange(1, 61)
    langs = ["en"] * 5 + ["de", "xx"] + [None]
    rows = []
    for i in range(160):
        pick = rng.choice(words, int(rng.integers(0, 60)), p=weight / weight.sum()) if i % 9 else [f"u{x}" for x in rng.integers(0, 500, 30)]
        rows.append((i, " ".join(pick), langs[i % 8]))
    trusted = [i for i in range(120) if i % 9 and i % 8 != 6]
    o = quality_model.Options()
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    draw = {r[0]: r[1] for r in ids.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) / 1_000_000).collect()}
    learn = [i in draw and draw[i] < 1 - o.calibration for i, _, _ in rows]
    check = {i for i in draw if draw[i] >= 1 - o.calibration}
    assert 40 < sum(learn) and 15 < len(check)

    scored, _ = plain_lm([row[:2] for row in rows], learn)
    n, mean = {}, {}
    for (i, _, _), (tokens, _, _, _, score) in zip(rows, scored):
        n[i], mean[i] = tokens, -score / tokens
    lang = {i: x for i, _, x in rows}
    used = [i for i in check if n[i] > 1]
    pooled = quantile([mean[i] for i in used], 0.5)
    middle = {None: pooled}
    for x in {lang[i] for i in used} - {None}:
        own = [mean[i] for i in used if lang[i] == x]
        middle[x] = (len(own) * quantile(own, 0.5) + o.prior * pooled) / (len(own) + o.prior)
    excess = {i: (mean[i] - middle.get(lang[i], pooled)) * n[i] / (n[i] + o.weight) for i in n}
    limit = o.spread * quantile([excess[i] for i in used], o.upper)

    found = quality_model.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), ids, max_chars=900).collect()
    assert sorted(r.doc_id for r in found) == sorted(n)
    for r in found:
        i = r.doc_id
        assert (r.lang, r.n_tokens, r.kept) == (lang[i], n[i], n[i] > 1 and excess[i] <= limit)
        assert (r.log_perplexity, r.middle, r.excess, r.threshold) == pytest.approx((mean[i], middle.get(lang[i], pooled), excess[i], limit))
    assert 0 < sum(r.kept for r in found) < len(found)


def test_filter_keeps_every_known_key():
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, 1 << 43, 50_000, dtype=np.uint64))  # three bits of shard, 40 of key
    shard = keys >> np.uint64(40)
    rows = [(0, int(k), kneser_ney.KeyFilter.of(keys[shard == k])) for k in np.unique(shard) if k != 5]
    found = kneser_ney.KeyFilter(rows, 8)
    assert found(0, keys, 40)[shard != 5].all() and not found(0, keys[shard == 5], 40).any()
    assert not found(1, keys, 40).any() and not kneser_ney.KeyFilter([], 8)(0, keys, 40).any()
    other = rng.integers(0, 1 << 43, 50_000, dtype=np.uint64)
    assert found(0, other, 40).mean() < 0.01


def test_filtered_scores_equal_all_lookups(spark):
    rng = np.random.default_rng(9)
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 40 + 40 * (i % 3), 25))) for i in range(60)] + [(99, None)], "doc_id long, text string")
    model = kneser_ney.train(kneser_ney.blocks(docs, F.col("doc_id") % 3 == 0))
    held = kneser_ney.blocks(docs, None, 500)
    plain, filtered = (sorted(tuple(r) for r in kneser_ney.scores(held, model, keys).collect()) for keys in (None, kneser_ney.key_filter(model)))
    assert plain == filtered and len(plain) == 61


def test_every_trusted_row_trains_or_calibrates(spark):
    """A word that stands in one row alone is more likely there if the model learned from that row."""
    n = 40_000
    docs = spark.range(0, n, 1, 4).selectExpr("id AS doc_id", "concat('a w', id, ' b') AS text", "'en' AS lang")
    found = quality_model.classify(docs, docs.select("doc_id")).select("log_perplexity").toPandas()["log_perplexity"]
    learned = int((found < found.min() + 0.01).sum())
    assert abs(learned - 0.7 * n) < 0.01 * n


def test_own_scores_equal_those_of_a_trained_model(spark):
    rng = np.random.default_rng(10)
    docs = spark.createDataFrame([(i if i % 7 else None, " ".join(f"w{x}" for x in rng.integers(0, 40 + 40 * (i % 3), 25))) for i in range(60)] + [(99, None)], "doc_id long, text string")
    flagged = kneser_ney.blocks(docs, F.col("doc_id") % 3 == 0, 500)
    plain = sorted(map(repr, kneser_ney.scores(flagged, kneser_ney.train(flagged)).collect()))
    assert sorted(map(repr, kneser_ney.own_scores(flagged).collect())) == plain
    ids = docs.where("doc_id % 3 = 0").select("doc_id").distinct()
    joined = kneser_ney.with_training(kneser_ney.blocks(docs, None, 500), ids)
    assert sorted(map(repr, kneser_ney.own_scores(joined).collect())) == plain


def test_shards_take_turns_with_the_same_scores(spark, monkeypatch):
    """In turns each key travels once, a turn may have none of a block's, and scores are those of a trained model."""
    texts = ["", "one", None, *(" ".join(f"w{(i * j) % 23}" for j in range(40)) for i in range(30))]
    docs = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "doc_id long, text string")
    held = kneser_ney.blocks(docs, F.col("doc_id") % 3 != 0, 400)
    plain = sorted(map(repr, kneser_ney.scores(held, kneser_ney.train(held)).collect()))
    monkeypatch.setattr(kneser_ney, "TURN_TOKENS", 100)
    staged, stage = [], kneser_ney.stage_bucketed
    monkeypatch.setattr(kneser_ney, "stage_bucketed", lambda df, column, buckets, name: staged.append(name) or stage(df, column, buckets, name))
    assert sorted(map(repr, kneser_ney.own_scores(held).collect())) == plain
    assert staged == ["lm_own_bigrams"] * 4 + ["lm_own_words"] * 2


def test_blocks_and_bigrams_are_removed(spark):
    """Only what later steps read stays of a classification: no blocks, no bigrams, no shuffles."""
    kept = Path(shared_dir(spark).removeprefix("file:")) / "staged"
    before, option = set(kept.glob("*")), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    docs = spark.createDataFrame([(i, f"a b w{i % 5} c", "en") for i in range(40)], "doc_id long, text string, lang string")
    found = quality_model.classify(docs, docs.where("doc_id < 30").select("doc_id"))
    names = {path.name.rsplit("-", 1)[0] for path in set(kept.glob("*")) - before}
    assert names == {"roles", "scored", "with_lang", "medians"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == option
    assert found.count() == 40
