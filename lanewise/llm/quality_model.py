"""Quality by perplexity: a Kneser-Ney model of trusted text, and thresholds from quantiles of each language."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm import kneser_ney
from lanewise.llm.common import BLOCK_CHARS
from lanewise.session import scratch, shuffles_removed, staging_path
from lanewise.sources import stage


@dataclass(frozen=True)
class Options:
    """calibration: share of the trusted rows that the model does not learn from and whose perplexities set the thresholds.

    It learns from all others, however many they are.
    prior: rows that the median over all languages counts for in each language's own, so that a language with few
    calibration rows is not judged by those alone. spread: a text is rejected if it lies further above its language's median
    than `spread` times the `upper` quantile of what calibration rows lie above theirs. weight: words of a language's median
    that are added to each text, so that a few rare words do not reject a short text; calibration rows are treated alike
    before their quantile is taken. key_bits: width of hash keys within a shard.
    """

    calibration: float = 0.3
    upper: float = 0.95
    spread: float = 1.5
    weight: int = 20
    prior: float = 5.0
    key_bits: int = 40


def classify(
    docs: DataFrame, trusted: DataFrame, options: Options = Options(), max_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(doc_id, lang, n_tokens, log_perplexity, middle, excess, threshold, kept) per row of `docs`.

    `trusted` has the ids of trusted rows in `doc_id`, repeated ones counting once; ids that `docs` lacks are ignored.
    Upper and lower case differ, as text in capitals is no prose. log_perplexity is the negative log10 probability per
    token, `middle` the median of the row's language, and `excess` what lies between them, less where a text has few words; a
    row is kept up to `threshold`. A text without words, so a missing one too, is not kept. A missing language, and one
    without calibration rows, has the median over all languages; without any calibration rows, everything with words is kept.
    Rows of one id share their trust. Repeated rows are judged each, long texts as a whole; an empty table gives an empty one.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("__id")).where("__id IS NOT NULL").distinct()
    ids = ids.join(docs.select(F.col(id_col).cast("long").alias("__id")).distinct(), "__id")
    draw = F.pmod(F.xxhash64("__id", F.lit(3)), F.lit(1_000_000)) / 1_000_000
    learns = (draw < 1.0 - options.calibration).alias("__learn")
    roles = stage(ids.select("__id", learns), name="roles")

    text = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    spark = docs.sparkSession
    path = staging_path(spark, "scored")
    # Blocks, bigrams and their shuffles are many times the scores, and nothing reads them afterwards.
    with scratch(spark, f"quality-{uuid.uuid4().hex}"), shuffles_removed(spark):
        held = kneser_ney.blocks(text, None, max_chars, options.key_bits, False, "__id", "__text")
        held = kneser_ney.with_training(held, roles.where("__learn").select("__id"))
        marked = stage(kneser_ney.own_scores(held).select("doc_id", "n_tokens", "score"), path)

    langs = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(lang_col).cast("string").alias("lang")).groupBy("__id")
    langs = langs.agg(F.min("lang").alias("lang"))
    rows = marked.join(langs, marked["doc_id"].eqNullSafe(langs["__id"])).drop("__id")
    rows = stage(rows.withColumn("mean", -F.col("score") / F.col("n_tokens")), name="with_lang")
    checks = roles.where("NOT __learn").select(F.col("__id").alias("doc_id"))
    sample = rows.where("n_tokens > 1").join(checks, "doc_id", "left_semi")
    pooled = sample.agg(F.percentile_approx("mean", 0.5, 10_000)).first()[0]
    rows = rows.join(_medians(sample, pooled, options), F.col("lang") == F.col("of"), "left").drop("of")
    rows = rows.withColumn("middle", F.coalesce("own", F.lit(pooled).cast("double"))).drop("own")
    excess = (F.col("mean") - F.col("middle")) * F.col("n_tokens") / (F.col("n_tokens") + options.weight)
    rows = rows.withColumn("excess", excess)
    sample = rows.where("n_tokens > 1").join(checks, "doc_id", "left_semi")
    upper = sample.agg(F.percentile_approx("excess", options.upper, 10_000)).first()[0]
    limit = F.lit(None if upper is None else options.spread * upper).cast("double")
    kept = (F.col("n_tokens") > 1) & (F.coalesce("excess", F.lit(0.0)) <= F.coalesce(limit, F.lit(float("inf"))))
    rows = rows.withColumnsRenamed({"mean": "log_perplexity"}).withColumns({"threshold": limit, "kept": kept})
    return rows.select("doc_id", "lang", "n_tokens", "log_perplexity", "middle", "excess", "threshold", "kept")


def _medians(sample: DataFrame, pooled: float | None, options: Options) -> DataFrame:
    """(of, own): per language the median of its calibration rows, drawn towards the one over all by `options.prior` rows."""
    median = F.percentile_approx("mean", 0.5, 10_000)
    found = sample.where("lang IS NOT NULL").groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n"), median.alias("median"))
    own = (F.col("n") * F.col("median") + options.prior * F.lit(pooled)) / (F.col("n") + options.prior)
    return stage(found.select("of", own.alias("own")), name="medians")


def keep_good(docs: DataFrame, trusted: DataFrame, options: Options = Options(), max_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs` that the classifier keeps, with all their columns. Rows without doc_id are judged together by id."""
    verdict = classify(docs, trusted, options, max_chars)
    # Rows of one id but different texts are judged one by one: an id goes only if all its rows go.
    good = stage(verdict.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("kept").select(F.col("doc_id").alias("__llm_id")), name="good")
    good = good.hint("merge")  # as many as there are documents: never broadcast, at any size
    return docs.join(good, docs["doc_id"].cast("long").eqNullSafe(F.col("__llm_id")), "left_semi").select(*docs.columns)
