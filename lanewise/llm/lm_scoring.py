"""Language-model scores of whole texts by a model of the same corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm import kneser_ney
from lanewise.llm.common import BLOCK_CHARS


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text is divisible by 10; a missing id counts as empty text, which is."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score(docs: DataFrame, max_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of `docs`.

    Learns from all rows that are not held out, whole texts, and scores all rows; a text's end is its last token. A
    missing or empty text is the end token alone. Repeated rows are counted and scored each; an empty table gives an
    empty one; where nothing is left to learn from, every token has probability 1.
    """
    chosen = ~held_out(F.col(id_col).cast("long"))
    held = kneser_ney.blocks(docs, chosen, max_chars, id_col=id_col, text_col=text_col)
    model = kneser_ney.train(held)
    found = kneser_ney.scores(held, model)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
