"""Byte-level BPE: each distinct word of the whole corpus is encoded once, and decoding joins the token-byte table.

Blocks of documents are split into pre-tokens. A block keeps the positions, as one number per pre-token, and the distinct
pre-tokens with their numbers. The distinct pre-tokens go to shards by a hash of their bytes: that is the global shuffle,
reduced beforehand to one entry per word and block, so that no word can be hot. A shard encodes each of its words once and
answers every block. The ids are joined with the token-byte table, the answers meet their block again, and the block's
numbers put ids and bytes back in order. Blocks and answers lie in buckets of the shared folder: positions are never
shuffled, answers once, and a lost executor repeats its tasks only.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.llm.common import as_blocks, partitions, stage_bucketed, texts
from lanewise.llm.packing import flat, pack, pack_strings, ranges, unpack, unpack_strings
from lanewise.sources import stage

#: Distinct words of a shard, summed over blocks, that a task is to hold.
SHARD_WORDS = 500_000
#: Characters of a block: the larger, the fewer entries the distinct words of all blocks are.
BLOCK_CHARS = 12_000_000


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """The token-byte table of a rank file: bounded by the tokenizer's vocabulary, whatever the corpus."""
    with open(path, "rb") as lines:
        return [(base64.b64decode(token), int(rank)) for token, rank in (line.split() for line in lines if line.strip())]


def token_table(spark: SparkSession, ranks: list[tuple[bytes, int]]) -> DataFrame:
    """(id, bytes) of every token."""
    return spark.createDataFrame([(rank, bytearray(token)) for token, rank in ranks], "id long, bytes binary")


def _encoder(ranks: list[tuple[bytes, int]]):
    import tiktoken

    # A word is a match of the real pattern already, so here one match is the whole of what is given.
    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=dict(ranks), special_tokens={})


def blocks(docs: DataFrame, pattern: str, max_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block, staged: its document ids, their numbers of pre-tokens, the pre-tokens as numbers, the distinct ones."""
    spark = docs.sparkSession

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex

        find = regex.compile(pattern).findall
        for block, ids, held in as_blocks(frames, max_chars):
            number: dict[str, int] = defaultdict(itertools.count().__next__)
            lengths, codes = np.empty(len(held), dtype=np.int64), []
            for i, text in enumerate(held):
                found = find(text)
                lengths[i] = len(found)
                codes.append(np.fromiter(map(number.__getitem__, found), np.uint32, len(found)))
            row = {
                "block": block,
                "ids": ids,
                "lengths": pack(lengths),
                "codes": pack(flat(codes, np.uint32)),
                "words": pack_strings([word.encode() for word in number]),
                "n_words": len(number),
            }
            yield pd.DataFrame([row])

    schema = "block long, ids array<long>, lengths binary, codes binary, words binary, n_words long"
    return stage_bucketed(texts(docs, id_col, text_col).mapInPandas(run, schema), "block", partitions(spark), "bpe_blocks")


def _by_shard(words: list[bytes], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each of a block's words, and the numbers of the words in the order of their shards.

    Both follow from the words alone, so neither the shards nor the answers have to carry the numbers.
    """
    import xxhash

    shard = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) % np.uint64(shards)
    return shard, np.argsort(shard, kind="stable")


def encoded_words(held: DataFrame, ranks: list[tuple[bytes, int]]) -> tuple[DataFrame, int]:
    """(block, answers) per block, staged, and the number of shards: per shard the words' numbers of ids, and the ids.

    A shard answers in the order in which it was asked, see `_by_shard`. The answers lie in buckets like the blocks, so both
    joins with them move nothing but the bytes of tokens.
    """
    n_words = held.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    shards = max(partitions(held.sparkSession), n_words // SHARD_WORDS + 1)

    def scatter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, data in zip(frame["block"], frame["words"]):
                words = unpack_strings(data)
                shard, order = _by_shard(words, shards)
                cuts = np.flatnonzero(np.diff(shard[order])) + 1
                rows = [part for part in np.split(order, cuts) if len(part)]
                yield pd.DataFrame(
                    {
                        "shard": [int(shard[part[0]]) for part in rows],
                        "block": block,
                        "words": [pack_strings([words[i] for i in part.tolist()]) for part in rows],
                    }
                )

    spread = held.select("block", "words").mapInPandas(scatter, "shard long, block long, words binary")

    def encode(frame: pd.DataFrame) -> pd.DataFrame:
        encoder, known = _encoder(ranks), {}
        lengths, ids = [], []
        for data in frame["words"]:
            found = []
            for word in unpack_strings(data):
                value = known.get(word)
                if value is None:
                    value = known[word] = np.array(encoder.encode_ordinary(word.decode()), dtype=np.uint32)
                found.append(value)
            lengths.append(pack(np.fromiter(map(len, found), np.int64, len(found))))
            ids.append(pack(flat(found, np.uint32)))
        return pd.DataFrame({"shard": frame["shard"], "block": frame["block"], "lengths": lengths, "ids": ids})

    answers = spread.groupBy("shard").applyInPandas(encode, "shard long, block long, lengths binary, ids binary")
    fields = F.struct("shard", "lengths", "ids").alias("answer")
    gathered = answers.groupBy("block").agg(F.collect_list(fields).alias("answers"))
    return stage_bucketed(gathered, "block", partitions(held.sparkSession), "bpe_words"), shards


def _word_ids(row, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a block's words, and by word number where they start and how many they are."""
    answers = sorted(row.answers if row.answers is not None else [], key=lambda x: x["shard"])
    codes = _by_shard(unpack_strings(row.words), shards)[1]
    lengths = flat([unpack(x["lengths"]) for x in answers]).astype(np.int64)
    ids = flat([unpack(x["ids"]) for x in answers]).astype(np.uint32)
    starts, counts = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes), dtype=np.int64)
    starts[codes], counts[codes] = np.cumsum(lengths) - lengths, lengths
    return ids, starts, counts


def _documents(row, shards: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, token ids) of a block with its answers."""
    ids, starts, counts = _word_ids(row, shards)
    lengths, codes, at = unpack(row.lengths).astype(np.int64), unpack(row.codes).astype(np.int64), 0
    for doc_id, n in zip(row.ids, lengths.tolist()):
        own = codes[at : at + n]
        at += n
        yield doc_id, ids[ranges(starts[own], counts[own])]


def _id(value) -> int | None:
    return None if value is None or value != value else int(value)


def encode(
    docs: DataFrame, path: str, pattern: str, max_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids): the token ids of each row, as an array of numbers.

    `path` names the rank file, `pattern` the pre-token pattern; special tokens are ordinary text. A missing or empty
    text has no ids; repeated rows and a missing doc_id are kept as they are; an empty table gives an empty one.
    """
    ranks = read_ranks(path)
    held = blocks(docs, pattern, max_chars, id_col, text_col)
    answers, shards = encoded_words(held, ranks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                for chunk in _chunks(_documents(row, shards)):
                    yield pd.DataFrame(
                        {"doc_id": pd.array([_id(x) for x, _ in chunk], dtype="Int64"), "n_tokens": [len(x) for _, x in chunk], "ids": [x.astype(np.int32) for _, x in chunk]}
                    )

    rows = held.join(answers, "block", "left")
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, bytes) for rows (doc_id, ids), by a join of the ids with the token-byte table.

    A row's distinct ids are joined, once each, and put back at their places. An id that the table lacks gives no
    bytes. Rows are told apart by their content, so equal rows give equal results, as many as there were.
    """
    rows = stage(encoded.select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids"), name="encoded")
    asked = rows.select("row", F.explode(F.array_distinct("ids")).alias("id"))
    found = asked.join(table, "id").groupBy("row").agg(F.collect_list(F.struct("id", "bytes")).alias("known"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for ids, known in zip(frame["ids"], frame["known"]):
                of = {x["id"]: bytes(x["bytes"]) for x in known} if known is not None else {}
                out.append(b"".join(of.get(x, b"") for x in (ids if ids is not None else [])))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "bytes": out})

    return rows.join(found, "row", "left").mapInPandas(run, "doc_id long, bytes binary")


def _chunks(pairs: Iterator, most: int = 500_000) -> Iterator[list]:
    """Lists of (doc_id, array, ...) of up to about `most` array elements."""
    held, size = [], 0
    for item in pairs:
        held.append(item)
        size += len(item[1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def digests(
    docs: DataFrame, path: str, pattern: str, max_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): `encode` and `decode` in one pass over the blocks; `with_ids`, also ids.

    The ids of a block's words are joined with the token-byte table before they return to their block, so ids and bytes
    are put in order together. Nulls, repeated rows and empty tables as in `encode`.
    """
    spark = docs.sparkSession
    ranks = read_ranks(path)
    held = blocks(docs, pattern, max_chars, id_col, text_col)
    answers, shards = encoded_words(held, ranks)

    def distinct(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, parts in zip(frame["block"], frame["answers"]):
                ids = np.unique(flat([unpack(x["ids"]) for x in parts]))
                yield pd.DataFrame({"block": block, "id": ids.astype(np.int64)})

    asked = answers.mapInPandas(distinct, "block long, id long")
    # A token reaches its block as one string, its id's four bytes before its own: a struct would be a dictionary in Python.
    entry = F.concat(F.unhex(F.lpad(F.hex("id"), 8, "0")), F.col("bytes"))
    known = asked.join(token_table(spark, ranks), "id").groupBy("block").agg(F.collect_list(entry).alias("known"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                table = row.known if row.known is not None else []
                keys = np.frombuffer(b"".join(x[:4] for x in table), dtype=">u4").astype(np.int64)
                of = [bytes(x[4:]) for x in table]
                place = np.full(int(keys.max()) + 1 if len(keys) else 0, len(of), dtype=np.int64)
                place[keys] = np.arange(len(keys))
                for chunk in _chunks(_documents(row, shards)):
                    out = []
                    for doc_id, ids in chunk:
                        body = hashlib.sha256()
                        for first in range(0, len(ids), 65536):
                            body.update(b"".join(map(of.__getitem__, place[ids[first : first + 65536]].tolist())))
                        out.append((_id(doc_id), len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), body.hexdigest()))
                    done = pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})
                    yield done.assign(ids=[x.astype(np.int32) for _, x in chunk]) if with_ids else done

    rows = held.join(answers, "block", "left").join(known, "block", "left")
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
