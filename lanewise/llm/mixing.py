"""Mixing sources to target weights by a low-discrepancy schedule over shuffled equal-token blocks. DataFrame functions only.

The documents of a source, in an order shuffled by a hash of their ids, form a stream of words that is cut into blocks of
equal length. The points frac(i * golden ratio) are mapped through the cumulative shares of the sources, so that every
stretch of the schedule holds the sources in their proportions; the k-th slot of a source takes block k of its stream,
starting anew when the stream ends.

Nothing here gathers a source in one task: positions in a stream and ranks of slots are sums within chunks plus the sums of
the chunks before. What stands in one task is one row per source, or one row per chunk of a source.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.llm.common import WORDS_SQL
from lanewise.sources import stage

#: Weights of the sources in code-point order, repeating; fixed by the contract of the query.
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_WORDS = 256
GOLDEN = (math.sqrt(5) - 1) / 2
#: Rows of a chunk of a stream, and slots of a chunk of the schedule.
CHUNK_ROWS, CHUNK_SLOTS = 5_000_000, 4096
#: Cells through which points find their source.
CELLS = 1024


def word_count(text: Column | str) -> Column:
    """Words of a text; a missing text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS_SQL)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(rank, source, source_size, target): what each source gives, in words.

    `sizes` has one row per (source, source_size). All sources together give the sum of all sizes, in proportion to the
    weights; no source gives more than `max_passes` times its size, and what it cannot give the others share by weight.
    Sources count in code-point order, the missing source last. With sources ordered by capacity per weight, the common
    level rises while sources are used up and falls afterwards, so its maximum is the level that holds.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select("source", "source_size", F.row_number().over(order).alias("rank"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, len(weights)) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * max_passes)
    before = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    used, passed = F.coalesce(F.sum("most").over(before), F.lit(0)), F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) - used) / (F.sum("weight").over(everything) - passed)
    ranked = ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.col("level"))
    return ranked.select("rank", "source", "source_size", target.alias("target"))


def _blocks(sources: DataFrame, block_words: int) -> DataFrame:
    """With the whole words to take, the number of equal blocks of the stream, and the slots that takes."""
    words = F.floor(F.col("target") + 0.5).cast("long")
    blocks = F.greatest(F.lit(1), F.round(F.col("source_size") / block_words)).cast("long")
    found = sources.where("source_size > 0").withColumn("words", words).withColumn("blocks", blocks)
    passes, rest = F.expr("words div source_size"), F.expr("words % source_size")
    # Block j starts at j * size div blocks; the last slot begins before the last word that is taken.
    last = F.when(rest > 0, F.expr("((words % source_size) * blocks - 1) div source_size + 1")).otherwise(F.lit(0))
    return found.withColumn("slots", passes * F.col("blocks") + last)


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, rank, turn): the slots in order, each with its source's rank and its number among that source's slots.

    `sources` has rank and slots; a source gets exactly that many turns. Points beyond a source's last turn are unused;
    turns that the points leave open, a few at most, come after all others.
    """
    spark = sources.sparkSession
    total, n = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    low = F.coalesce(F.sum("slots").over(before), F.lit(0)) / F.lit(max(total, 1))
    spans = sources.where("slots > 0").withColumn("low", low)
    high = F.when(F.lead("rank").over(Window.orderBy("rank")).isNull(), F.lit(2.0)).otherwise(F.lead("low").over(Window.orderBy("rank")))
    spans = spans.withColumn("high", high)
    cells = F.sequence(F.floor(F.col("low") * CELLS).cast("int"), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)).cast("int"))
    spans = stage(spans.select("rank", "slots", "low", "high", F.explode(cells).alias("cell")), name="spans")
    points = spark.range(int(total) + 8 * int(n)).withColumnRenamed("id", "slot")
    points = points.withColumn("point", F.pmod((F.col("slot") + 1) * F.lit(GOLDEN), F.lit(1.0)))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    placed = points.join(spans, "cell").where("point >= low AND point < high")
    placed = placed.select("slot", "rank", "slots", F.floor(F.col("slot") / CHUNK_SLOTS).alias("chunk"))
    counts = placed.groupBy("rank", "slots", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))), name="turns")
    within = Window.partitionBy("chunk", "rank").orderBy("slot")
    placed = placed.withColumn("turn", F.row_number().over(within) - 1)
    placed = placed.join(counts.select("rank", "chunk", "first"), ["rank", "chunk"]).withColumn("turn", F.col("turn") + F.col("first"))
    placed = placed.where("turn < slots").select("slot", "rank", "turn")
    had = counts.groupBy("rank").agg(F.sum("n").alias("had"))
    late = sources.where("slots > 0").join(had, "rank", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < slots")
    late = late.select("rank", F.explode(F.sequence(F.col("had"), F.col("slots") - 1)).alias("turn"))
    late = late.select((F.lit(int(total) + 8 * int(n)) + F.col("turn")).alias("slot"), "rank", "turn")
    return placed.unionByName(late)


def streams(items: DataFrame) -> DataFrame:
    """Items with `start`, their place in the stream of their source: the sizes before them in shuffled order."""
    rows = items.count()
    digits = max(2, math.ceil(math.log(max(rows, 1) / CHUNK_ROWS, 16))) if rows else 2
    keyed = items.withColumn("place", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    keyed = keyed.withColumn("chunk", F.substring("place", 1, digits))
    totals = keyed.groupBy("rank", "chunk").agg(F.sum("words_here").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = stage(totals.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))), name="chunks")
    within = Window.partitionBy("rank", "chunk").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    keyed = keyed.withColumn("before", F.coalesce(F.sum("words_here").over(within), F.lit(0)))
    keyed = keyed.join(totals.select("rank", "chunk", "first"), ["rank", "chunk"])
    return keyed.withColumn("start", F.col("first") + F.col("before")).drop("place", "chunk", "first", "before")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    block_words: int = BLOCK_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The mix as pieces, and all items with their sources.

    Pieces: (slot, doc_id, rank, size, first, words): in slot `slot` stand `words` words of the document from word
    `first` on. Items: (doc_id, rank, source, size, n, source_size, target), n equal rows in each. Rows that agree in
    doc_id, source and size form one item, whose words are split evenly over them. A missing text has size 0 and no
    pieces, a missing source is a source of its own, a missing doc_id is an id like any other. An empty table, or one
    without words, gives no pieces and targets of 0. Reruns give the same pieces.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    items = stage(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), name="items")
    sizes = stage(items.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), name="sizes")
    sources = stage(_blocks_all(targets(sizes, weights, max_passes), block_words), name="sources")
    known = sources.select("rank", "source", "source_size", "target")
    items = items.withColumnRenamed("source", "given").join(known, F.col("given").eqNullSafe(F.col("source"))).drop("given")
    items = stage(items, name="ranked")
    live = sources.where("slots > 0")
    order = streams(items.where("size > 0").select("doc_id", "rank", "size", (F.col("size") * F.col("n")).alias("words_here")))
    order = order.join(live.select("rank", "source_size", "blocks"), "rank")
    # Word w stands in block ((w + 1) * blocks - 1) div size, as block j holds the words from j * size div blocks on.
    span = F.sequence(F.expr("((start + 1) * blocks - 1) div source_size"), F.expr("((start + words_here) * blocks - 1) div source_size"))
    cut = order.select("doc_id", "rank", "size", "start", "words_here", "source_size", "blocks", F.explode(span).alias("block"))
    slots = stage(schedule(live.select("rank", "slots")), name="slots")
    slots = slots.join(live.select("rank", "words", F.col("source_size").alias("of"), F.col("blocks").alias("parts")), "rank")
    slots = slots.withColumn("block", F.pmod("turn", "parts"))
    slots = slots.withColumn("limit", F.col("words") - F.expr("turn div parts") * F.col("of")).select("slot", "rank", "block", "limit")
    low = F.greatest("start", F.expr("block * source_size div blocks"))
    high = F.least(F.expr("start + words_here"), F.expr("(block + 1) * source_size div blocks"), "limit")
    pieces = cut.join(slots, ["rank", "block"]).withColumn("from", low).withColumn("words", high - F.col("from")).where("words > 0")
    return pieces.select("slot", "doc_id", "rank", "size", (F.col("from") - F.col("start")).alias("first"), "words"), items


def _blocks_all(sources: DataFrame, block_words: int) -> DataFrame:
    names = ["rank", "source", "source_size", "target", "words", "blocks", "slots"]
    empty = sources.where("source_size = 0").select("*", *(F.lit(0).cast("long").alias(x) for x in names[4:]))
    return _blocks(sources, block_words).select(*names).unionByName(empty.select(*names))


def taken(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, taken): per item the words of each of its n rows that the mix takes.

    Where rows share an item, the words that do not divide evenly by n (fewer than n) are left out.
    """
    pieces, items = mix(docs, **options)
    sums = pieces.groupBy("doc_id", "rank", "size").agg(F.sum("words").alias("words"))
    sums = sums.select(F.col("doc_id").alias("id"), F.col("rank").alias("of"), F.col("size").alias("long"), "words")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("rank") == F.col("of")) & (F.col("size") == F.col("long"))
    found = items.join(sums, same, "left")
    words = F.expr("coalesce(words, 0) div n").alias("taken")
    return found.select("doc_id", "source", "size", "n", "source_size", "target", words)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """`docs` as the mix takes them, with all their columns: a row for each pass through a document.

    A pass that the mix breaks off keeps the words up to there; `n_chars`, where it exists, is the length of what stays.
    Documents that the mix takes no word of are gone.
    """
    found = stage(taken(docs, **options).where("taken > 0"), name="taken")
    found = found.select(
        F.col("doc_id").alias("__llm_id"), F.col("source").alias("__llm_source"), F.col("size").alias("__llm_size"), F.col("taken").alias("__llm_taken")
    )
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col("__llm_id"))
        & F.col("source").eqNullSafe(F.col("__llm_source"))
        & (word_count("text") == F.col("__llm_size"))
    )
    passes = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(__llm_taken - 1) div __llm_size"))).alias("__llm_pass")
    rows = docs.join(found, same).select("*", passes)
    left = F.col("__llm_taken") - F.col("__llm_pass") * F.col("__llm_size")
    cut = F.when(left >= F.col("__llm_size"), F.col("text")).otherwise(first_words(F.col("text"), left))
    names = docs.columns
    rows = rows.withColumn("text", cut)
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(left < F.col("__llm_size"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*names)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word; a text of no more words as it is."""
    import re

    @F.pandas_udf("string")
    def run(values: pd.Series, counts: pd.Series) -> pd.Series:
        def cut(value, count):
            end = None
            for i, found in enumerate(re.finditer(WORDS_SQL, value or "")):
                if i == count - 1:
                    end = found.end()
                    break
            return value if end is None else value[:end]

        return pd.Series([cut(value, count) for value, count in zip(values, counts)], dtype=object)

    return run(text, n)
