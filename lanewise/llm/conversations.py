"""Repair of conversations whose rows were lost, emptied, cut, repeated or given to the wrong speaker.

A conversation becomes a string of symbols, one per row: its role and its fault. Edits of a string are walks through the
states of `(s?(ua)+)?`, so the cheapest ones are a product of min-plus matrices, one per symbol, whose entries hold a cost and
the edits that give it, as a rope. The strings are compressed by Re-Pair: each rule stands for two symbols that often follow
each other, in whatever conversation, and has one matrix, the product of its parts' matrices. A string is then the product of
the few symbols that are left of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.common import partitions
from lanewise.sources import stage

#: Rows of a conversation that one string holds at most; the matrices of a longer one's pieces are multiplied.
PIECE_BITS = 14

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Symbols: the role's initial (s, u, a, any other) times the fault of the row.
ROLES, FAULTS = "sua", ("none", "truncated", "blank", "duplicate")
SYMBOLS = "abcdefghijklmnop"
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: States: nothing yet, after s, after u, after a (the pattern may end at the first and the last).
STATES = range(4)
EXPECTED = {0: "user", 1: "user", 2: "assistant", 3: "user"}


# --- ropes -----------------------------------------------------------------------------------------------------

_BASE, _PRIME, _FLAT = 911_382_323, (1 << 61) - 1, 32


class Rope:
    """Text made of parts that other ropes share; its length and hash are known, so equal parts are compared at once."""

    __slots__ = ("size", "hash", "power", "text", "left", "right")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.size, self.hash, self.power = len(text), 0, pow(_BASE, len(text), _PRIME)
            for char in text:
                self.hash = (self.hash * _BASE + ord(char)) % _PRIME
        else:
            self.size, self.power = left.size + right.size, left.power * right.power % _PRIME
            self.hash = (left.hash * right.power + right.hash) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        if self.size + other.size <= _FLAT:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.text is not None:
                out.append(rope.text)
            else:
                todo += [rope.right, rope.left]
        return "".join(out)

    def before(self, other: Rope) -> bool:
        """Whether this text comes first in ASCII order."""
        mine, theirs = [self], [other]
        while mine and theirs:
            x, y = mine.pop(), theirs.pop()
            if x.size == y.size and x.hash == y.hash:
                continue
            if x.text is not None and y.text is not None:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                mine += [Rope(x.text[n:])] if x.size > n else []
                theirs += [Rope(y.text[n:])] if y.size > n else []
            elif y.text is not None or x.text is None and x.size >= y.size:
                mine += [x.right, x.left]
                theirs.append(y)
            else:
                theirs += [y.right, y.left]
                mine.append(x)
        return bool(theirs)


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def better(a: Entry, b: Entry) -> Entry:
    """The cheaper one, and of two that cost the same the one whose edits come first."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1].before(a[1]) else a


def product(left: Matrix, right: Matrix) -> Matrix:
    out: Matrix = []
    for row in left:
        line: list[Entry] = [None] * 4
        for k, first in enumerate(row):
            if first is not None:
                for j, second in enumerate(right[k]):
                    cost = None if second is None else first[0] + second[0]
                    if cost is not None and (line[j] is None or cost <= line[j][0]):
                        line[j] = better(line[j], (cost, first[1] + second[1]))
        out.append(line)
    return out


def _of(entries: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return [[(entries[i, j][0], Rope(entries[i, j][1])) if (i, j) in entries else None for j in STATES] for i in STATES]


#: Rows put in before a given one: none, or as many as lead to another state; going round costs more and leads nowhere.
BEFORE = _of({(i, i): (0, "") for i in STATES} | {(0, 2): (INSERT, "I"), (1, 2): (INSERT, "I"), (2, 3): (INSERT, "I"), (3, 2): (INSERT, "I"), (0, 3): (2 * INSERT, "II"), (1, 3): (2 * INSERT, "II")})


def symbol_matrix(symbol: int) -> Matrix:
    """Edits of one row, and of rows put in before it, from each state to each."""
    role, fault = divmod(symbol, 4)
    edits = {(i, i): (DELETE, "D") for i in STATES}
    if fault < 2:
        more = CUT if fault else 0
        edits |= {(0, 2): (REROLE + more, "R"), (1, 2): (REROLE + more, "R"), (3, 2): (REROLE + more, "R"), (2, 3): (REROLE + more, "R")}
        for i, j in {0: [(0, 1)], 1: [(0, 2), (1, 2), (3, 2)], 2: [(2, 3)], 3: []}[role]:
            edits[i, j] = (KEEP + more, "K")
    return product(BEFORE, _of(edits))


def ending(line: list[Entry]) -> tuple[int, Rope]:
    """The best end of the walks that a line holds: at the first or last state, with rows put in at the end if need be."""
    best = better(line[0], line[3])
    for state, rows in ((2, "I"), (1, "II")):
        if line[state] is not None:
            best = better(best, (line[state][0] + INSERT * len(rows), line[state][1] + Rope(rows)))
    return best


# --- grammar ---------------------------------------------------------------------------------------------------


def re_pair(strings: list[np.ndarray], first: int = len(SYMBOLS)) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Rules (left, right), numbered from `first` on, and what is left of the strings once no pair occurs twice.

    A round replaces the most frequent pairs that have no symbol in common, so their places cannot overlap.
    """
    rules: list[tuple[int, int]] = []
    ends = np.cumsum([len(s) + 1 for s in strings])
    flat = np.full(ends[-1] if len(ends) else 0, -1, dtype=np.int64)
    for string, end in zip(strings, ends):
        flat[end - 1 - len(string) : end - 1] = string
    while len(flat) > 1:
        left, right = flat[:-1], flat[1:]
        count = first + len(rules)
        whole = np.flatnonzero((left >= 0) & (right >= 0))
        pairs, times = np.unique(left[whole] * count + right[whole], return_counts=True)
        used, chosen = set(), {}
        for at in np.lexsort((pairs, -times)):
            if times[at] < 2:
                break
            pair = divmod(int(pairs[at]), count)
            if not used.intersection(pair):
                used.update(pair)
                chosen[int(pairs[at])] = first + len(rules)
                rules.append(pair)
        if not chosen:
            break
        keys = np.array(sorted(chosen))
        made = np.array([chosen[key] for key in keys])
        found = np.searchsorted(keys, left * count + right).clip(max=len(keys) - 1)
        hit = (left >= 0) & (right >= 0) & (keys[found] == left * count + right)
        # Only a pair of one symbol can overlap itself: of a run of hits every other one counts.
        start = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
        at = np.flatnonzero(hit)
        at = at[(at - start[np.searchsorted(start, at, side="right") - 1]) % 2 == 0]
        flat[at] = made[found[at]]
        flat = np.delete(flat, at + 1)
    cuts = np.flatnonzero(flat < 0)
    return rules, [flat[a:b] for a, b in zip(np.concatenate([[0], cuts + 1]), cuts)]


def evaluate(strings: list[str]) -> list[Matrix]:
    """The matrix of each string, by way of the rules that all of them share."""
    codes = [np.frombuffer(s.encode(), dtype=np.uint8).astype(np.int64) - ord(SYMBOLS[0]) for s in strings]
    rules, rest = re_pair(codes)
    matrices = [symbol_matrix(symbol) for symbol in range(len(SYMBOLS))]
    for left, right in rules:  # a rule's parts have smaller numbers
        matrices.append(product(matrices[left], matrices[right]))
    out = []
    for string in rest:
        found = None
        for symbol in string.tolist():
            found = matrices[symbol] if found is None else product(found, matrices[symbol])
        out.append(found)
    return out


# --- Spark -----------------------------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text) with the faults that the operator is tried on, drawn by conversation and turn."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    named = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    draw = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text)
    out = rows.select("conv_id", "turn", F.when(draw == 4, "user").otherwise(role).alias("role"), text.alias("text"), draw.alias("__draw"))
    copies = F.when(F.col("__draw") == 0, 0).when(F.col("__draw") == 3, 2).otherwise(1)
    out = out.withColumn("__copies", F.array_repeat(F.lit(0), copies)).withColumn("__copy", F.explode("__copies"))
    return out.drop("__draw", "__copies", "__copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """(key, turn, role, text) with the conversation as text, so that no number loses digits where others are null."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text"))
    return rows.select(F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("long").alias("turn"), role, text)


def symbols(keyed: DataFrame) -> DataFrame:
    """(key, pos, symbol) per row: its place among all rows by conversation and turn, and its role and fault.

    Rows are dealt out by ranges of conversation, turn, role and text, and equal rows by a number of their own, so that a
    conversation may hold any share of them.
    """
    spark = keyed.sparkSession
    order = [F.col("key").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    even = F.xxhash64(F.monotonically_increasing_id())
    dealt = keyed.withColumn("__even", even).repartitionByRange(partitions(spark), *order, F.col("__even")).sortWithinPartitions(*order)
    body = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    initial = F.substring("role", 1, 1)
    group = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    same = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary"), 256)
    columns = {"pos": F.monotonically_increasing_id(), "group": group, "last": F.right(body, F.lit(1)), "blank": body == "", "same": F.unhex(same)}
    rows = dealt.select("key", *[column.alias(name) for name, column in columns.items()])
    rows = stage(rows, name="turns")
    firsts = rows.where("NOT blank").groupBy("key", "same").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = stage(firsts.select(F.col("key").alias("__key"), F.col("same").alias("__same"), "first"), name="firsts")
    rows = rows.join(firsts, F.col("key").eqNullSafe(F.col("__key")) & (F.col("same") == F.col("__same")) & ~F.col("blank"), "left")
    fault = F.when(F.col("blank"), 2).when(F.col("pos") > F.col("first"), 3).when(F.col("last").isin(".", "!", "?"), 0).otherwise(1)
    return rows.select("key", "pos", F.substring(F.lit(SYMBOLS), F.col("group") * 4 + fault + 1, F.lit(1)).alias("symbol"))


_MATRIX = "costs array<int>, audits array<string>"


def _evaluated(strings: DataFrame) -> DataFrame:
    """(symbols, costs, audits): the matrix of each distinct string, its lines one after the other."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            entries = [[entry for line in matrix for entry in line] for matrix in evaluate(frame["symbols"].tolist())]
            costs = [[None if x is None else x[0] for x in one] for one in entries]
            audits = [[None if x is None else str(x[1]) for x in one] for one in entries]
            yield pd.DataFrame({"symbols": frame["symbols"], "costs": costs, "audits": audits})

    return strings.mapInPandas(run, f"symbols string, {_MATRIX}")


def _pieces(keyed: DataFrame) -> DataFrame:
    """(key, piece, symbols, costs, audits): the strings of each conversation in order, with their matrices."""
    placed = symbols(keyed).withColumn("piece", F.shiftright("pos", PIECE_BITS))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "symbol")))
    pieces = placed.groupBy("key", "piece").agg(F.array_join(F.transform(ordered, lambda x: x["symbol"]), "").alias("symbols"))
    pieces = stage(pieces, name="pieces")
    matrices = stage(_evaluated(pieces.select("symbols").distinct()), name="matrices")
    return pieces.join(matrices, "symbols")


class Walk:
    """One conversation on its way through a task: matrices of its pieces first, then its rows."""

    def __init__(self, key: str | None):
        self.key, self.line, self.strings = key, [(0, Rope("")), None, None, None], []
        self.cost, self.audit, self.at, self.state = 0, None, 0, 0
        self.first_turn = self.last_turn = None
        self.turns = 0

    def piece(self, string: str, costs: Iterable, audits: Iterable) -> None:
        entries = [None if cost is None or cost != cost else (int(cost), audit) for cost, audit in zip(costs, audits)]
        matrix = [entries[i : i + 4] if self.line[i // 4] is not None else [None] * 4 for i in range(0, 16, 4)]
        self.line = product([self.line], [[x and (x[0], Rope(x[1])) for x in line] for line in matrix])[0]
        self.strings.append(string)

    def close(self) -> None:
        if self.audit is None:
            self.cost, rope = ending(self.line)
            self.audit = str(rope)

    def _put(self, role: str, text: str, turn: int | None, edit: str) -> tuple:
        self.state = {"s": 1, "u": 2, "a": 3}[role[0]]
        return turn, role, text, edit

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put(EXPECTED[self.state], "", None, "I")

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        """(turn, role, text, edit) of the rows that come of this one and of those put in before it."""
        self.close()
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._put(role if edit == "K" else EXPECTED[self.state], text, turn, edit)

    def report(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit."""
        self.close()
        gaps = 0 if self.last_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        faults, illegal, last = [0, 0, 0, 0], 0, None
        for string in self.strings:
            codes = np.frombuffer(string.encode(), dtype=np.uint8) - ord(SYMBOLS[0])
            faults = [n + int(m) for n, m in zip(faults, np.bincount(codes % 4, minlength=4))]
            roles = (codes // 4).tolist()
            illegal += sum(pair not in LEGAL for pair in zip([last, *roles] if last is not None else roles, roles if last is not None else roles[1:]))
            last = roles[-1]
        return gaps, faults[2], faults[3], faults[1], illegal, self.cost, self.audit


_SHAPE = f"key string, kind int, piece long, turn string, role string, text string, symbols string, {_MATRIX}"


def _walks(rows: DataFrame, ids: DataFrame | None, partly, schema: str) -> DataFrame:
    """`partly(frames)` over the conversations, each in one task and in order: an entry, its pieces, its rows.

    The edits of a conversation's start depend on its end, so they are found from the pieces beforehand; here its rows only
    pass by, one batch at a time.
    """
    spark = rows.sparkSession
    keyed = _keyed(rows)
    known = (ids if ids is not None else rows).select(F.col("conv_id").cast("string").alias("key")).distinct()
    kinds = dict(column.strip().split(" ", 1) for column in _SHAPE.split(","))
    null = {name: F.lit(None).cast(kind) for name, kind in kinds.items()}

    def part(df: DataFrame, kind: int) -> DataFrame:
        have = {"kind": F.lit(kind)} | {name: F.col(name) for name in df.columns if name in null}
        turn = have.get("turn", F.lit(None)).cast("long").alias("__turn")
        return df.select(*[have.get(name, column).cast(kinds[name]).alias(name) for name, column in null.items()], turn)

    parts = part(known, 0).unionByName(part(_pieces(keyed), 1)).unionByName(part(keyed, 2))
    order = [F.col("key").asc_nulls_first(), F.col("kind"), F.col("piece"), F.col("__turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return parts.repartition(partitions(spark), "key").sortWithinPartitions(*order).drop("__turn").mapInPandas(partly, schema)


def _steps(frames: Iterable[pd.DataFrame]) -> Iterator[tuple[Walk, Iterator[tuple] | None]]:
    """(walk, repaired rows) as rows pass by; None for the rows at the end of a conversation, which are those put in there."""
    walk = None
    for frame in frames:
        columns = [frame[name].tolist() for name in ("key", "kind", "turn", "role", "text", "symbols", "costs", "audits")]
        for key, kind, turn, role, text, string, costs, audits in zip(*columns):
            if kind == 0:
                if walk is not None:
                    yield walk, None
                walk = Walk(key)
            elif kind == 1:
                walk.piece(string, costs, audits)
            else:
                yield walk, walk.row(None if turn is None else int(turn), role, text)
    if walk is not None:
        yield walk, None


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.

    Conversations are those of `ids` (column conv_id; else of `rows`), which may have no rows: zeros, an empty audit and the
    digest of nothing. Rows stand by turn, nulls first, then by role and text; equal rows stand beside each other and all but
    the first are duplicates. A missing role or text counts as one space: no such role is legal, no such text is kept. A
    missing conv_id is a conversation of its own. Rows without a turn make no gap. Long texts count as a whole; other columns
    are not read; an empty table without `ids` gives an empty one. repaired_sha256 is over the repaired rows as role:text, one
    per line. That digest goes through a conversation from its start to its end, so a task sees all rows of one,
    but holds only a batch of them, and the audit.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, seen, any_row = [], hashlib.sha256(), False
        for walk, put in _steps(frames):
            last = put is None
            if last:
                walk.close()
                put = walk.inserted()
            for _, role, text, _ in put:
                seen.update(f"{chr(10) * any_row}{role}:{text}".encode())
                any_row = True
            if last:
                out.append((walk.key, *walk.report(), seen.hexdigest()))
                seen, any_row = hashlib.sha256(), False
            if len(out) == 1000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    names = ["conv_id", *REPORT, "repaired_sha256"]
    kinds = {"conv_id": "string", "audit": "string", "repaired_sha256": "string"}
    found = _walks(rows, ids, run, ", ".join(f"{name} {kinds.get(name, 'long')}" for name in names))
    return found.withColumn("conv_id", F.col("conv_id").cast(rows.schema["conv_id"].dataType))


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, edit): the rows of the repaired conversations, counted from 0 in each.

    edit is K or R, and I for rows put in, which have no turn; deleted rows are left out. Order and special cases as in `report`.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, place = [], 0
        for walk, put in _steps(frames):
            last = put is None
            if last:
                walk.close()
                put = walk.inserted()
            for turn, role, text, edit in put:
                out.append((walk.key, place, None if turn is None else str(turn), role, text, edit))
                place += 1
            if last:
                place = 0
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    names = ["conv_id", "place", "turn", "role", "text", "edit"]
    found = _walks(rows, None, run, "conv_id string, place long, turn string, role string, text string, edit string")
    return found.withColumns({"conv_id": F.col("conv_id").cast(rows.schema["conv_id"].dataType), "turn": F.col("turn").cast("long")})
