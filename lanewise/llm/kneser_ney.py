"""Interpolated modified Kneser-Ney bigram models, counted in Spark, kept as sorted hash arrays.

Documents are held in staged blocks: token numbers in order, and a 64-bit hash per distinct word. A block sends its
distinct bigrams, as sorted keys with counts, to shards by the leading bits of the key; a bigram is one entry per block, so
none can be hot. A shard merges what it gets into one ascending array of keys and one of counts: the model. It also tells
each block which of its bigrams it stands for (the first block that has it), so that the numbers of different successors
and predecessors are sums over blocks. Words make the same trip with their sums.

Scoring sends keys the same way to the same shards. A task lays the array of its shard into a temporary file, maps it into
memory and answers by binary search; the answers meet their blocks, which lie in buckets and are not shuffled.

Where a model scores the very blocks that it was counted in, `own_scores` makes one trip of both: a block sends all its
bigrams with the counts of its training rows, and the shard that sums them up answers at once. No model is kept. The shards
take turns, so that only the keys of some of them lie in a shuffle at a time.

The model: with discounts D1, D2, D3+ by the usual estimates from counts of counts,
    p(w | v) = (c(vw) - D) / c(v) + g(v) p(w),   p(w) = (N(. w) - D') / N(. .) + g' / (V + 1),
where g takes up what the discounts leave. V + 1 counts a class for all unknown words; after an unseen word p(w | v) = p(w).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.common import BLOCK_CHARS, as_blocks, partitions, stage_bucketed
from lanewise.llm.packing import flat, pack, pack_sorted, unpack, unpack_sorted
from lanewise.sources import stage

END, START = 0, 1
#: Keys of a shard, summed over blocks, that a task is to hold; with 40-bit keys one lookup in a million then hits a wrong key.
SHARD_KEYS = 2_000_000
KEY_BITS = 40
#: Keys of a model up to which a filter of them goes to every task: at most four bytes a key.
FILTER_KEYS = 8_000_000
#: Turns that the shards of bigrams take in `own_scores`, half of them for words, and tokens from which there is one turn more.
TURNS = 4
TURN_TOKENS = 4_000_000
STATS = ("tokens", "contexts", "ones", "twos", "more", "before")


@dataclass(frozen=True)
class Blocks:
    """Staged blocks, their number of tokens and the bits of shard and key."""

    rows: DataFrame
    tokens: int
    key_bits: int

    @property
    def shard_bits(self) -> int:
        least = max(partitions(self.rows.sparkSession), self.tokens // SHARD_KEYS + 1)
        return max(1, (least - 1).bit_length())


@dataclass(frozen=True)
class Model:
    """Bigram and word shards, none in `own_scores`, and what is summed over all of them."""

    bigrams: DataFrame | None
    words: DataFrame | None
    shard_bits: int
    key_bits: int
    train_tokens: int
    vocabulary: int
    bigram_types: int
    discounts: tuple[float, float, float]
    lower_discounts: tuple[float, float, float]
    lower_counts: tuple[int, int, int]


def blocks(
    docs: DataFrame, train: Column | None, max_chars: int = BLOCK_CHARS, key_bits: int = KEY_BITS, lower: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> Blocks:
    """Stage `docs` as blocks. `train` says which rows a model learns from; none without it."""
    from pyspark.sql import functions as F

    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        (F.lit(False) if train is None else F.coalesce(train, F.lit(False))).alias("train"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags: list[bool] = []

        def watched():
            for frame in frames:
                flags.extend(frame["train"].tolist())
                yield frame

        for block, ids, held in as_blocks(watched(), max_chars):
            number: dict[bytes, int] = {b"\n": END, b"\t": START}  # no word is white space
            lengths, codes = np.empty(len(held), dtype=np.int64), []
            for i, text in enumerate(held):
                data = text.encode()
                words = (data.lower() if lower else data).split()
                lengths[i] = len(words) + 1
                for word in set(words).difference(number):
                    number[word] = len(number)
                codes.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                codes.append(np.array([END], dtype=np.uint32))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
            own, flags[:] = flags[: len(held)], flags[len(held) :]
            row = {
                "block": block,
                "ids": ids,
                "train": np.array(own, dtype=np.uint8).tobytes(),
                "lengths": pack(lengths),
                "codes": pack(flat(codes, np.uint32)),
                "words": hashes.tobytes(),
                "tokens": int(lengths.sum()),
            }
            yield pd.DataFrame([row])

    schema = "block long, ids array<long>, train binary, lengths binary, codes binary, words binary, tokens long"
    held = stage_bucketed(rows.mapInPandas(run, schema), "block", partitions(spark), "lm_blocks")
    return Blocks(held, held.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0], key_bits)


def with_training(held: Blocks, ids: DataFrame) -> Blocks:
    """The blocks with the documents named in `ids` (one column, no repeated ids) as training rows, beside those they have.

    Numbers of documents are joined, not texts. A document without an id is named by none.
    """
    wanted = ids.toDF("__learn_id")
    places = held.rows.select("block", F.posexplode("ids").alias("at", "__id"))
    found = places.join(wanted, F.col("__id") == F.col("__learn_id")).groupBy("block").agg(F.collect_list("at").alias("learn"))
    return replace(held, rows=held.rows.join(stage(found, name="lm_training"), "block", "left"))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _positions(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token: its number, the number before it; per document: its length, whether it is learned from."""
    lengths, codes = unpack(row.lengths).astype(np.int64), unpack(row.codes).astype(np.int64)
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[np.cumsum(lengths) - lengths] = START
    learned = np.frombuffer(row.train, dtype=np.uint8).astype(bool)
    if getattr(row, "learn", None) is not None:
        learned[np.asarray(row.learn, dtype=np.int64)] = True
    return codes, before, lengths, learned


def _pair_keys(words: np.ndarray, before: np.ndarray, codes: np.ndarray, drop: int) -> np.ndarray:
    """Leading bits of a 64-bit hash of each (previous word, word)."""
    return _mixed(words[before] * np.uint64(0x9E3779B97F4A7C15) + words[codes]) >> np.uint64(drop)


def _word_keys(words: np.ndarray, drop: int) -> np.ndarray:
    return _mixed(words) >> np.uint64(drop)


def _by_shard(block: int, keys: np.ndarray, columns: dict[str, np.ndarray], key_bits: int) -> pd.DataFrame:
    """Rows (shard, block, keys, columns...) of ascending keys, cut where the leading bits change."""
    shard = (keys >> np.uint64(key_bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shard)) + 1
    starts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(keys)]
    spans = [(a, b) for a, b in zip(starts, ends) if b > a]
    rows = {"shard": [int(shard[a]) for a, _ in spans], "block": block, "keys": [pack_sorted(keys[a:b]) for a, b in spans]}
    return pd.DataFrame(rows | {name: [pack(values[..., a:b].ravel()) for a, b in spans] for name, values in columns.items()})


def _concatenated(answers, field: str) -> list[np.ndarray]:
    """A block's answers in the order of its keys."""
    rows = sorted(answers, key=lambda x: x["shard"]) if answers is not None else []
    return [unpack(x[field]) for x in rows]


def _gathered(answers: DataFrame, name: str, *fields: str) -> DataFrame:
    return answers.groupBy("block").agg(F.collect_list(F.struct("shard", *fields)).alias(name))


def _word_stats(n: int, codes: np.ndarray, before: np.ndarray, left: np.ndarray, right: np.ndarray, told: np.ndarray) -> np.ndarray:
    """STATS per word of a block, from its training tokens and the bigrams (left, right) that it stands for."""
    stats = np.zeros((len(STATS), n), dtype=np.int64)
    stats[0] = np.bincount(codes, minlength=n)
    stats[1] = np.bincount(before, minlength=n)
    for k in (1, 2, 3):
        stats[1 + k] = np.bincount(left[told == k], minlength=n)
    stats[5] = np.bincount(right[told > 0], minlength=n)
    return stats


def _words_seen(stats: np.ndarray) -> list[int]:
    """Of a shard's words: tokens, words, those after 1, 2, 3 and 4 different words, and those after three or more."""
    known = stats[0] > 0
    return [int(stats[0].sum()), int(known.sum()), *(int((stats[5][known] == k).sum()) for k in (1, 2, 3, 4)), int((stats[5][known] > 2).sum())]


def _added(parts: list[np.ndarray], n: int, place: np.ndarray) -> np.ndarray:
    """The sums of the words' statistics in several blocks."""
    values = np.concatenate(parts, axis=1).astype(np.int64)
    stats = np.zeros((len(STATS), n), dtype=np.int64)
    for i in range(len(STATS)):
        np.add.at(stats[i], place, values[i])
    return stats


def train(held: Blocks) -> Model:
    """Count the training rows of the blocks. Without any, the model knows nothing and gives every token probability 1."""
    shard_bits, key_bits = held.shard_bits, held.key_bits
    drop = 64 - shard_bits - key_bits

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                codes, before, lengths, learned = _positions(row)
                chosen = np.repeat(learned, lengths)
                words = np.frombuffer(row.words, dtype="<u8")
                keys, counts = np.unique(_pair_keys(words, before[chosen], codes[chosen], drop), return_counts=True)
                if len(keys):
                    yield _by_shard(row.block, keys, {"counts": counts}, key_bits)

    sent = held.rows.mapInPandas(pairs, "shard long, block long, keys binary, counts binary")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        parts = [unpack_sorted(x) for x in frame["keys"]]
        everything, first, place = np.unique(flat(parts), return_index=True, return_inverse=True)
        totals = np.zeros(len(everything), dtype=np.int64)
        np.add.at(totals, place, flat([unpack(x) for x in frame["counts"]]).astype(np.int64))
        stands = np.zeros(len(place), dtype=bool)
        stands[first] = True  # the first block in which a bigram occurs stands for it
        told = np.where(stands, np.minimum(totals[place], 3), 0)
        cuts = np.cumsum([len(x) for x in parts])[:-1]
        shard = int(frame["shard"].iloc[0])
        seen = [len(everything), *(int((totals == k).sum()) for k in (1, 2, 3, 4))]
        rows = [(shard, None, pack_sorted(everything), pack(totals), None, seen)]
        rows += [(shard, block, None, None, pack(x), None) for block, x in zip(frame["block"], np.split(told, cuts))]
        return pd.DataFrame(rows, columns=["shard", "block", "keys", "counts", "told", "seen"]).astype({"block": "Int64"})

    schema = "shard long, block long, keys binary, counts binary, told binary, seen array<long>"
    merged = stage(sent.groupBy("shard").applyInPandas(merge, schema), name="lm_bigrams")
    bigrams = merged.where("block IS NULL")

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                codes, before, lengths, learned = _positions(row)
                chosen = np.repeat(learned, lengths)
                codes, before = codes[chosen], before[chosen]
                words = np.frombuffer(row.words, dtype="<u8")
                if not len(codes):
                    continue
                _, first = np.unique(_pair_keys(words, before, codes, drop), return_index=True)
                told = flat(_concatenated(row.answers, "told")).astype(np.int64)
                stats = _word_stats(len(words), codes, before, before[first], codes[first], told)
                keys = _word_keys(words, drop)
                order = np.argsort(keys, kind="stable")
                order = order[(stats[:2, order] > 0).any(axis=0)]
                yield _by_shard(row.block, keys[order], {"stats": stats[:, order]}, key_bits)

    told = _gathered(merged.where("block IS NOT NULL"), "answers", "told")
    rows = held.rows.join(told, "block", "left")
    sent = rows.mapInPandas(sums, "shard long, block long, keys binary, stats binary")

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        everything, place = np.unique(flat([unpack_sorted(x) for x in frame["keys"]]), return_inverse=True)
        stats = _added([unpack(x).reshape(len(STATS), -1) for x in frame["stats"]], len(everything), place)
        seen = _words_seen(stats)
        return pd.DataFrame({"shard": frame["shard"].iloc[:1], "keys": [pack_sorted(everything)], "stats": [pack(stats.ravel())], "seen": [seen]})

    words = stage(sent.groupBy("shard").applyInPandas(add, "shard long, keys binary, stats binary, seen array<long>"), name="lm_words")
    total = lambda df, n: [x or 0 for x in df.agg(*(F.sum(F.col("seen")[i]) for i in range(n))).first()]
    types, *counts = total(bigrams, 5)
    tokens, vocabulary, one, two, three, four, more = total(words, 7)
    return Model(
        bigrams.select("shard", "keys", "counts"),
        words.select("shard", "keys", "stats"),
        shard_bits,
        key_bits,
        tokens,
        vocabulary,
        types,
        _discounts(counts),
        _discounts([one, two, three, four]),
        (one, two, more),
    )


def _discounts(counts: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams seen 1, 2, 3 and 4 times; where one is missing, 1/2, 1 and 3/2."""
    if min(counts) == 0:
        return 0.5, 1.0, 1.5
    share = counts[0] / (counts[0] + 2 * counts[1])
    found = [k - (k + 1) * share * counts[k] / counts[k - 1] for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found))


class KeyFilter:
    """Which keys a model may hold: a Bloom filter per kind of key and shard. It errs for about one key in 200, to yes."""

    def __init__(self, rows: list, shards: int):
        """`rows` has (kind, shard, bits), at most one per kind and shard; bits of a power of two."""
        self.first, self.size = np.zeros((2, shards), np.uint64), np.zeros((2, shards), np.uint64)
        parts, at = [np.zeros(1, dtype=np.uint8)], 8  # shards without keys look here
        for kind, shard, bits in rows:
            self.first[kind, shard], self.size[kind, shard] = at, 8 * len(bits)
            parts.append(np.frombuffer(bits, dtype=np.uint8))
            at += 8 * len(bits)
        self.bits = np.concatenate(parts)

    @staticmethod
    def places(keys: np.ndarray, size: np.ndarray | np.uint64) -> list[np.ndarray]:
        one = _mixed(keys ^ np.uint64(0x9E3779B97F4A7C15))
        step = _mixed(one) | np.uint64(1)
        return [(one + np.uint64(i) * step) & (size - np.uint64(1)) for i in range(3)]

    @classmethod
    def of(cls, keys: np.ndarray) -> bytes:
        """The bits of a shard's keys, 16 to 32 for each."""
        size = max(64, 1 << (16 * len(keys) - 1).bit_length())
        bits = np.zeros(size, dtype=bool)
        for place in cls.places(keys, np.uint64(size)):
            bits[place] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def __call__(self, kind: int, keys: np.ndarray, key_bits: int) -> np.ndarray:
        shard = (keys >> np.uint64(key_bits)).astype(np.int64)
        size, first = self.size[kind][shard], self.first[kind][shard]
        there = size > 0
        for place in self.places(keys, np.maximum(size, np.uint64(1))):
            at = np.where(there, first + place, np.uint64(0))
            there &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return there


def key_filter(model: Model) -> KeyFilter | None:
    """The filter of a model small enough for every task to hold its bits; None for one of more keys than FILTER_KEYS."""
    if model.bigram_types + model.vocabulary > FILTER_KEYS:
        return None

    def bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["kind", "shard"]].assign(bits=[KeyFilter.of(unpack_sorted(x)) for x in frame["keys"]])

    keys = model.bigrams.select(F.lit(0).alias("kind"), "shard", "keys").unionByName(model.words.select(F.lit(1).alias("kind"), "shard", "keys"))
    rows = keys.mapInPandas(bits, "kind int, shard long, bits binary").collect()  # at most four bytes for each of FILTER_KEYS
    return KeyFilter([(x.kind, x.shard, bytes(x.bits)) for x in rows], 1 << model.shard_bits)


def _mapped(keys: np.ndarray):
    """The array in a file of no name, mapped into memory: pages come and go as lookups need them."""
    if not len(keys):
        return keys
    file = tempfile.TemporaryFile()
    file.write(keys.tobytes())
    file.flush()
    return np.memmap(file, dtype=np.uint64, mode="r")


def _looked_up(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the asked keys among ascending keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=bool)
    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return place, keys[place] == asked


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _probabilities(model: Model):
    """A function from a block's tokens, with the model's counts of its bigrams and statistics of its words, to rows of SCORES."""
    tokens, size, types = model.train_tokens, model.vocabulary, max(model.bigram_types, 1)
    d, e, lower = np.array([0, *model.discounts]), np.array([0, *model.lower_discounts]), model.lower_counts
    rest = (sum(x * n for x, n in zip(model.lower_discounts, lower)) / model.bigram_types) if model.bigram_types else 1.0

    def found(ids, codes: np.ndarray, before: np.ndarray, lengths: np.ndarray, count: np.ndarray, stats: np.ndarray) -> pd.DataFrame:
        seen = stats[0]
        base = np.log10((seen + 0.1) / (tokens + 0.1 * (size + 1)))
        alone = rest / (size + 1) + (stats[5] - e[np.minimum(stats[5], 3)]) / types
        context = np.maximum(stats[1], 1)
        back = np.where(stats[1] > 0, (d[1] * stats[2] + d[2] * stats[3] + d[3] * stats[4]) / context, 1.0)
        p = np.where(stats[1][before] > 0, (count - d[np.minimum(count, 3)]) / context[before], 0.0) + back[before] * alone[codes]
        starts = np.cumsum(lengths) - lengths
        add = lambda values: np.add.reduceat(values, starts)
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if x is None or x != x else int(x) for x in ids], dtype="Int64"),
                "n_tokens": lengths,
                "n_known": add((seen[codes] > 0).astype(np.int64)),
                "base_score": add(base[codes]),
                "score": add(np.log10(p)),
            }
        )

    return found


def scores(held: Blocks, model: Model, known_keys: KeyFilter | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) per row: log10 probabilities of the text with its end.

    base_score is the unigram model with 0.1 added to every count. The blocks' key width must be the model's. With
    `known_keys`, words and bigrams that the model surely lacks ask no shard; the scores are the same, as all others do.
    """
    shard_bits, key_bits = model.shard_bits, model.key_bits
    drop = 64 - shard_bits - key_bits
    sent = None if known_keys is None else held.rows.sparkSession.sparkContext.broadcast(known_keys)

    def lookups(row, codes: np.ndarray, before: np.ndarray):
        """Keys of a block's tokens with the one before, and of its words; which of either ask, and a block's ascending bigrams."""
        words = np.frombuffer(row.words, dtype="<u8")
        pair, single = _pair_keys(words, before, codes, drop), _word_keys(words, drop)
        if sent is None:
            return pair, single, np.ones(len(pair), dtype=bool), np.ones(len(single), dtype=bool), np.unique(pair)
        word = sent.value(1, single, key_bits)
        asks = word[before] & word[codes]
        asks[asks] = sent.value(0, pair[asks], key_bits)
        return pair, single, asks, word, np.unique(pair[asks])

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                codes, before, _, _ = _positions(row)
                _, single, _, word, pairs = lookups(row, codes, before)
                for kind, keys in ((0, pairs), (1, np.sort(single[word]))):
                    if len(keys):
                        yield _by_shard(row.block, keys, {}, key_bits).assign(kind=kind)

    asked = held.rows.mapInPandas(ask, "shard long, block long, keys binary, kind int")

    def answer(known: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, field in ((0, "counts"), (1, "stats")):
            of, mine = rows[rows["kind"] == kind], known[known["kind"] == kind]
            keys = _mapped(unpack_sorted(mine["keys"].iloc[0]) if len(mine) else np.empty(0, dtype=np.uint64))
            values = unpack(mine["counts"].iloc[0]).reshape(-1, len(keys)) if len(mine) else np.empty((1, 0))
            for shard, block, data in zip(of["shard"], of["block"], of["keys"]):
                place, there = _looked_up(keys, unpack_sorted(data))
                found = np.where(there, values[:, place], 0) if len(keys) else np.zeros((len(STATS) if kind else 1, len(place)))
                out.append((shard, block, kind, pack(found.ravel())))
        return pd.DataFrame(out, columns=["shard", "block", "kind", "counts"])

    known = model.bigrams.select("shard", "keys", "counts", F.lit(0).alias("kind"))
    known = known.unionByName(model.words.select("shard", "keys", F.col("stats").alias("counts"), F.lit(1).alias("kind")))
    answers = known.groupBy("shard").cogroup(asked.groupBy("shard"))
    answers = answers.applyInPandas(answer, "shard long, block long, kind int, counts binary")
    gathered = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "kind", "counts")).alias("answers"))

    probabilities = _probabilities(model)

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                codes, before, lengths, _ = _positions(row)
                kinds = [[x for x in row.answers if x["kind"] == kind] if row.answers is not None else [] for kind in (0, 1)]
                pair, single, asks, word, pairs = lookups(row, codes, before)
                count = np.zeros(len(pair), dtype=np.int64)
                count[asks] = flat(_concatenated(kinds[0], "counts")).astype(np.int64)[np.searchsorted(pairs, pair[asks])]
                order = np.flatnonzero(word)[np.argsort(single[word], kind="stable")]
                stats = np.zeros((len(STATS), len(single)), dtype=np.int64)
                if len(order):
                    stats[:, order] = np.concatenate([x.reshape(len(STATS), -1) for x in _concatenated(kinds[1], "counts")], axis=1).astype(np.int64)
                yield probabilities(row.ids, codes, before, lengths, count, stats)

    rows = held.rows.join(gathered, "block", "left")
    return rows.mapInPandas(finish, SCORES)


def own_scores(held: Blocks) -> DataFrame:
    """The rows of `scores` by a model of the blocks' own training rows: the same as `scores(held, train(held))`.

    Bigrams go to their shards once, each with its count in the block's training rows, zero for the others; the shard sums
    them up, tells who stands for which bigram as `train` does, and answers with the sums. Words follow likewise. What
    travels and is written is in proportion to the blocks' distinct bigrams, whatever part of the rows trains. Shards take
    turns: keys of one turn are gone when the next begins, if finished shuffles are removed (`shuffles_removed`).
    """
    shard_bits, key_bits, buckets = held.shard_bits, held.key_bits, partitions(held.rows.sparkSession)
    drop = 64 - shard_bits - key_bits
    turns = min(TURNS, 1 + held.tokens // TURN_TOKENS)
    word_turns = max(1, turns // 2)

    def due(keys: np.ndarray, turn: int, of: int) -> np.ndarray:
        return (keys >> np.uint64(key_bits)) % np.uint64(of) == np.uint64(turn)

    def pairs(frames: Iterator[pd.DataFrame], turn: int) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                codes, before, lengths, learned = _positions(row)
                keys = _pair_keys(np.frombuffer(row.words, dtype="<u8"), before, codes, drop)
                mine = due(keys, turn, turns)
                keys, place = np.unique(keys[mine], return_inverse=True)
                counts = np.bincount(place[np.repeat(learned, lengths)[mine]], minlength=len(keys))
                if len(keys):
                    yield _by_shard(row.block, keys, {"counts": counts}, key_bits)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        parts = [unpack_sorted(x) for x in frame["keys"]]
        everything, place = np.unique(flat(parts), return_inverse=True)
        counts = flat([unpack(x) for x in frame["counts"]]).astype(np.int64)
        totals = np.zeros(len(everything), dtype=np.int64)
        np.add.at(totals, place, counts)
        learned = np.flatnonzero(counts)
        stands = learned[np.unique(place[learned], return_index=True)[1]]  # the first block that trains with a bigram
        told = np.zeros(len(place), dtype=np.int64)
        told[stands] = np.minimum(totals[place[stands]], 3)
        cuts, shard = np.cumsum([len(x) for x in parts])[:-1], int(frame["shard"].iloc[0])
        seen = [int((totals > 0).sum()), *(int((totals == k).sum()) for k in (1, 2, 3, 4))]
        rows = [(shard, None, None, None, seen)]
        rows += [(shard, block, pack(x), pack(y), None) for block, x, y in zip(frame["block"], np.split(told, cuts), np.split(totals[place], cuts))]
        return pd.DataFrame(rows, columns=["shard", "block", "told", "counts", "seen"]).astype({"block": "Int64"})

    bigrams = []
    for turn in range(turns):
        sent = held.rows.drop("ids").mapInPandas(partial(pairs, turn=turn), "shard long, block long, keys binary, counts binary")
        answers = sent.groupBy("shard").applyInPandas(merge, "shard long, block long, told binary, counts binary, seen array<long>")
        bigrams.append(stage_bucketed(_gathered(answers, "answers", "told", "counts", "seen"), "block", buckets, "lm_own_bigrams"))

    def sums(frames: Iterator[pd.DataFrame], turn: int) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                codes, before, lengths, learned = _positions(row)
                chosen, words = np.repeat(learned, lengths), np.frombuffer(row.words, dtype="<u8")
                _, first = np.unique(_pair_keys(words, before, codes, drop), return_index=True)
                told = flat(_concatenated(row.answers, "told")).astype(np.int64)
                stats = _word_stats(len(words), codes[chosen], before[chosen], before[first], codes[first], told)
                keys = _word_keys(words, drop)
                order = np.argsort(keys, kind="stable")
                order = order[due(keys[order], turn, word_turns)]
                if len(order):
                    yield _by_shard(row.block, keys[order], {"stats": stats[:, order]}, key_bits)

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_sorted(x) for x in frame["keys"]]
        everything, place = np.unique(flat(parts), return_inverse=True)
        stats = _added([unpack(x).reshape(len(STATS), -1) for x in frame["stats"]], len(everything), place)
        shard, cuts = int(frame["shard"].iloc[0]), np.cumsum([len(x) for x in parts])[:-1]
        rows = [(shard, None, None, _words_seen(stats))]
        rows += [(shard, block, pack(stats[:, x].ravel()), None) for block, x in zip(frame["block"], np.split(place, cuts))]
        return pd.DataFrame(rows, columns=["shard", "block", "stats", "seen"]).astype({"block": "Int64"})

    told = held.rows.drop("ids").join(_from_turns(held.rows, bigrams, "answers", "shard", "told"), "block", "left")
    words = []
    for turn in range(word_turns):
        sent = told.mapInPandas(partial(sums, turn=turn), "shard long, block long, keys binary, stats binary")
        answers = sent.groupBy("shard").applyInPandas(add, "shard long, block long, stats binary, seen array<long>")
        words.append(stage_bucketed(_gathered(answers, "known", "stats", "seen"), "block", buckets, "lm_own_words"))

    def total(parts: list[DataFrame], column: str, n: int) -> list[int]:
        seen = reduce(DataFrame.unionByName, [df.where("block IS NULL").select(F.explode(f"{column}.seen").alias("seen")) for df in parts])
        return [x or 0 for x in seen.agg(*(F.sum(F.col("seen")[i]) for i in range(n))).first()]

    types, *counts = total(bigrams, "answers", 5)
    tokens, vocabulary, one, two, three, four, more = total(words, "known", 7)
    model = Model(None, None, shard_bits, key_bits, tokens, vocabulary, types, _discounts(counts), _discounts([one, two, three, four]), (one, two, more))
    probabilities = _probabilities(model)

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                codes, before, lengths, _ = _positions(row)
                words = np.frombuffer(row.words, dtype="<u8")
                _, place = np.unique(_pair_keys(words, before, codes, drop), return_inverse=True)
                count = flat(_concatenated(row.answers, "counts")).astype(np.int64)[place]
                stats = np.zeros((len(STATS), len(words)), dtype=np.int64)
                order = np.argsort(_word_keys(words, drop), kind="stable")
                stats[:, order] = np.concatenate([x.reshape(len(STATS), -1) for x in _concatenated(row.known, "stats")], axis=1)
                yield probabilities(row.ids, codes, before, lengths, count, stats)

    found = _from_turns(held.rows, bigrams, "answers", "shard", "counts")
    found = found.join(_from_turns(held.rows, words, "known", "shard", "stats"), "block", "left")
    return held.rows.join(found, "block", "left").mapInPandas(finish, SCORES)


def _from_turns(rows: DataFrame, parts: list[DataFrame], name: str, *fields: str) -> DataFrame:
    """(block, `name`): the answers to a block from all turns, as one array of these fields.

    Parts lie in the blocks' buckets. They meet each other here, so that the blocks themselves, which are long rows, are joined once.
    """
    found, names = rows.select("block"), [f"__{name}_{i}" for i in range(len(parts))]
    for df, own in zip(parts, names):
        taken = F.transform(name, lambda x: F.struct(*(x[field].alias(field) for field in fields)))
        found = found.join(df.select("block", taken.alias(own)), "block", "left")
    return found.select("block", F.concat(*(F.coalesce(own, F.array().cast(found.schema[own].dataType)) for own in names)).alias(name))
