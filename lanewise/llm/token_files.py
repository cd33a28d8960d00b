"""Token ids in directly addressable codes: files from which any token is read without decoding what stands before it.

A file is a table of segments of consecutive documents. A segment's ids are split into chunks of eight bits. Level 0 has the
lowest chunk of every id; a bitmap says which ids go on; the next level has the next chunk of those only, and so on. A rank
directory counts the bits set before every 64th position, so the place of an id's next chunk is found in constant time.
Segments lie in ascending order of doc_id, and each knows how many ids precede it among those of its partition.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.llm.common import as_blocks, partitions, texts
from lanewise.llm.packing import ranges
from lanewise.sources import stage

#: Ids after which a segment ends; a longer document is a segment of its own.
SEGMENT_IDS = 1_000_000
#: Words whose ids a Python worker remembers, from one task to the next.
CACHE_WORDS = 1_000_000
#: Characters of the texts that are encoded together; a longer text is by itself.
TURN_CHARS = 4_000_000
WORD_BITS = 64
#: Words of signs, digits and Latin letters that are composed already and whose lower case is one character.
_PLAIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f]*").fullmatch
#: How byte-level tokenizers write the bytes that are no printable Latin-1 character.
_HIDDEN = [x for x in range(256) if not (0x21 <= x <= 0x7E or 0xA1 <= x <= 0xAC or 0xAE <= x)]
_SHOWN = {x: 256 + i for i, x in enumerate(_HIDDEN)}


def _bits(mask: np.ndarray) -> bytes:
    return np.packbits(np.pad(mask, (0, -len(mask) % WORD_BITS)), bitorder="little").tobytes()


def encode_levels(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """(chunks, bitmaps, directories) per level."""
    chunks, bitmaps, directories, rest = [], [], [], ids if ids.dtype == np.uint32 else ids.astype(np.uint64)
    while len(rest):
        chunks.append(rest.astype(np.uint8).tobytes())  # the lowest eight bits
        rest = rest >> 8
        more = rest > 0
        bitmaps.append(_bits(more))
        ones = np.bitwise_count(np.frombuffer(bitmaps[-1], dtype="<u8")).astype(np.uint32)
        directories.append((np.cumsum(ones) - ones).astype("<u4").tobytes())
        rest = rest[more]
    return chunks, bitmaps, directories


def read_at(segment, places: np.ndarray) -> np.ndarray:
    """The ids at the given places of a segment, each found by itself."""
    value, at = np.zeros(len(places), dtype=np.uint64), np.asarray(places, dtype=np.int64)
    alive = np.arange(len(places))
    for level, (chunk, bitmap, directory) in enumerate(zip(segment["chunks"], segment["bitmaps"], segment["directories"])):
        if not len(alive):
            break
        value[alive] |= np.frombuffer(chunk, dtype=np.uint8)[at].astype(np.uint64) << np.uint64(8 * level)
        words, ranks = np.frombuffer(bitmap, dtype="<u8"), np.frombuffer(directory, dtype="<u4")
        word, bit = words[at // WORD_BITS], (at % WORD_BITS).astype(np.uint64)
        more = (word >> bit) & np.uint64(1) == 1
        below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        at = (ranks[at // WORD_BITS].astype(np.int64) + below)[more]
        alive = alive[more]
    return value


def _vocabulary(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Ids of texts by the ids of their space-separated parts, remembered within bounds.

    Exact for tokenizers that drop white space before they cut words, as no token then spans a space. Words of printable
    ASCII and Latin letters, for a tokenizer that only composes, lowers case and splits by a pattern, go straight to its
    model; for those the other steps change nothing. All other words, and words that hold the text of an added token such
    as <|endoftext|>, take the tokenizer's whole way, which gives the added token's id.
    """

    def __init__(self, path: str):
        import regex

        self.tokenizer, self.known, self.old, self.pieces, self.find = _vocabulary(path), {}, {}, {}, None
        steps = json.loads(self.tokenizer.to_str())
        added = [re.escape(x["content"].lower()) for x in steps["added_tokens"] or []]
        self.marked = re.compile("|".join(added) if added else "(?!)").search
        normal = [x["type"] for x in (steps["normalizer"] or {}).get("normalizers", [])]
        cuts = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
        if normal == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"] and "Regex" in cuts[0]["pattern"]:
            self.find = regex.compile(cuts[0]["pattern"]["Regex"]).findall

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_SHOWN)
        ids = [token.id for token in self.tokenizer.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[str]) -> None:
        """Pieces of plain words are remembered too: new words are mostly known ones with other signs around them."""
        rest, pieces, find, marked = [], self.pieces, self.find, self.marked
        for word in words:
            lower = word.lower()
            if find is not None and _PLAIN(word) and not marked(lower):
                cut = [lower] if lower.isalpha() else find(lower)
                for piece in cut:
                    if piece not in pieces:
                        pieces[piece] = self._piece(piece)
                self.known[word] = pieces[cut[0]] if len(cut) == 1 else b"".join([pieces[x] for x in cut])
            else:
                rest.append(word)
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        for word, x in zip(rest, found):
            ids = x.ids
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
        if len(pieces) > CACHE_WORDS // 2:
            pieces.clear()

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Words are told apart in Arrow, so each is looked up once in all the texts."""
        parts = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        words = parts.flatten().dictionary_encode()
        codes, words = words.indices.to_numpy(), words.dictionary.to_pylist()
        new = [word for word in words if word not in self.known]
        if new:
            if len(self.known) + len(new) > CACHE_WORDS // 2:  # words not met since the last turn are forgotten
                self.old, self.known, new = self.known, {}, words
            again = [word for word in new if word in self.old]
            self.known.update((word, self.old[word]) for word in again)
            self._learn([word for word in new if word not in self.known])
        ids = [self.known[word] for word in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ids = np.frombuffer(b"".join(ids), dtype="<u4")
        data = ids[ranges((np.cumsum(sizes) - sizes)[codes], sizes[codes])].tobytes()
        ends = 4 * np.concatenate([[0], np.cumsum(sizes[codes])])[parts.offsets.to_numpy()]
        return [data[a:b] for a, b in pairwise(ends.tolist())]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


@lru_cache(maxsize=2)
def worker_words(path: str) -> WordIds:
    """The tokenizer and the words met so far, kept in a Python worker for its next tasks; a new worker starts empty."""
    return WordIds(path)


_FILE = (
    "part int, segment int, before long, doc_ids array<long>, lengths array<long>, "
    "chunks array<binary>, bitmaps array<binary>, directories array<binary>"
)


def write_tokens(docs: DataFrame, path: str, end_id: int = 1, segment_ids: int = SEGMENT_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append `end_id`, write segments in ascending order of doc_id (missing first), and read them back.

    A missing or empty text is the end id alone. Repeated rows stand next to each other. An empty table gives no segments.
    Documents are dealt by ranges of doc_id and a hash of the text before they are encoded, so each is encoded once, and the
    rows of one id, or of a missing one, are shared out unless they are equal too.
    """
    rows = texts(docs, id_col, text_col)
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        from lanewise.llm.token_files import worker_words

        part, words, end = TaskContext.get().partitionId(), worker_words(path), np.array([end_id], dtype="<u4").tobytes()
        number, before, held, bodies, size = 0, 0, [], [], 0

        def encoded(frames):
            for _, doc_ids, some in as_blocks(frames, TURN_CHARS):
                yield from zip(doc_ids, words.many(some))

        def segment():
            chunks, bitmaps, directories = encode_levels(np.frombuffer(b"".join(bodies), dtype="<u4"))
            row = (part, number, before, [x for x, _ in held], [n for _, n in held], chunks, bitmaps, directories)
            return pd.DataFrame([row], columns=[x.split()[0] for x in _FILE.split(", ")])

        for doc_id, ids in encoded(frames):
            body = ids + end
            if held and size + len(body) // 4 > segment_ids:
                yield segment()
                number, before, held, bodies, size = number + 1, before + size, [], [], 0
            held.append((doc_id, len(body) // 4))
            bodies.append(body)
            size += len(body) // 4
        if held:
            yield segment()

    return stage(rows.mapInPandas(run, _FILE), name="tokens")


def read_tokens(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the segments alone: `start` counts all ids before it.

    Every id is looked up by its place. The ids before a partition are summed over one row per partition.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                lengths = np.asarray(row["lengths"], dtype=np.int64)
                starts, sums = np.cumsum(lengths) - lengths, []
                ids = np.concatenate([read_at(row, np.arange(a, min(a + 65536, lengths.sum()))) for a in range(0, int(lengths.sum()), 65536)]).astype("<u4")
                for a, n in zip(starts.tolist(), lengths.tolist()):
                    sums.append(zlib.crc32(ids[a : a + n].tobytes()))
                doc_ids = pd.array([None if x is None or x != x else int(x) for x in row["doc_ids"]], dtype="Int64")
                yield pd.DataFrame({"part": row["part"], "doc_id": doc_ids, "place": row["before"] + starts, "n_tokens": lengths, "ids_crc32": sums})

    totals = segments.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = stage(totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")), name="parts")
    found = segments.mapInPandas(run, "part int, doc_id long, place long, n_tokens long, ids_crc32 long")
    found = found.join(totals, "part")
    return found.select("doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(segments: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, place, token) for rows (doc_id, place): single tokens of documents, read by address."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                yield pd.DataFrame({"doc_id": [row["doc_id"]], "place": [row["place"]], "token": read_at(row, np.array([row["offset"] + row["place"]])).astype(np.int64)})

    index = F.posexplode("doc_ids").alias("at", "doc_id")
    where = segments.select("*", index).withColumn("offset", F.expr("aggregate(slice(lengths, 1, at), 0L, (a, x) -> a + x)"))
    where = where.withColumn("size", F.element_at("lengths", F.col("at") + 1)).join(wanted.select("doc_id", "place"), "doc_id")
    where = where.where("place >= 0 AND place < size").select("doc_id", "place", "offset", "chunks", "bitmaps", "directories")
    return where.mapInPandas(run, "doc_id long, place long, token long")
