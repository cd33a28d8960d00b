"""Repairs against a plain search over all states, row by row, and the parts they are made of."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lanewise.llm import conversations
from lanewise.llm.conversations import Rope
from lanewise.llm.queries import QUERIES
from tests.conftest import SF_DIR

SCHEMA = "conv_id long, turn long, role string, text string, key string, symbols string, pos string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """The contract's damage; rows are (conv_id, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return out


def cheapest(rows):
    """(cost, edits, repaired rows) of (role initial or other, fault) rows: the least by cost, then by edits, of all walks."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {0: (0, "", ())}

    def inserts(best):
        for _ in range(4):
            for state, (cost, edits, kept) in list(best.items()):
                role = {0: "user", 1: "user", 2: "assistant", 3: "user"}[state]
                to = step[state, role[0]]
                best[to] = min(best.get(to, (10**9, "")), (cost + 5, edits + "I", (*kept, (role, ""))), key=lambda x: x[:2])
        return best

    for role, text, fault in rows:
        after = {}

        def offer(state, *what):
            after[state] = min(after.get(state, (10**9, "")), what, key=lambda x: x[:2])

        for state, (cost, edits, kept) in inserts(best).items():
            offer(state, cost + 2, edits + "D", kept)
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                if (state, role[:1]) in step:
                    offer(step[state, role[:1]], cost + more, edits + "K", (*kept, (role, text)))
                for other in ("user", "assistant"):
                    if (state, other[0]) in step:
                        offer(step[state, other[0]], cost + 1 + more, edits + "R", (*kept, (other, text)))
        best = after
    best = inserts(best)
    return min((best[state] for state in (0, 3) if state in best), key=lambda x: x[:2])


def brute(rows, ids):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = []
    for conv in ids:
        seen, marked, counts = set(), [], defaultdict(int)
        found = sorted(groups.get(conv, []))
        for _, _, role, text in found:
            body, fault = text.strip(SPACE), None
            if not body:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif body[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        turns = {turn for known, turn, _, _ in found if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, edits, kept = cheapest(marked)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, edits, digest))
    return sorted(out, key=repr)


def made(rng, n, conv):
    """A conversation with all kinds of faults and roles."""
    rows = []
    for i in range(n):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
        text = rng.choice(["Yes.", "No", "Why?  ", "", " \t", None, "Go!\n", f"line {i}.", f"line {i}", "é.", "a\x85"])
        rows.append((conv, rng.choice([i, i, i + 2, None]), role, text))
    return rows


@pytest.fixture(scope="module")
def hard():
    rng = random.Random(4)
    rows = [row for conv in range(150) for row in made(rng, rng.randint(1, 9), conv)]
    rows += made(rng, 60, None) + [(500, 1, "user", "x" * 400_000 + "."), (500, 2, "assistant", "ok.")] * 2
    return rows + [(501 + i, turn, "s" if turn == 0 else "ua"[turn % 2], "a.") for i in range(3) for turn in range(4)]


@pytest.mark.parametrize("bits", [14, 2])
def test_equals_a_plain_search(spark, hard, monkeypatch, bits):
    """Also with pieces of four rows, so that most conversations are put together from several matrices."""
    monkeypatch.setattr(conversations, "PIECE_BITS", bits)
    rows = spark.createDataFrame([(*row, "k", "s", "p") for row in hard], SCHEMA).repartition(3)
    ids = sorted({row[0] for row in hard}, key=repr)
    for given, wanted in ((rows, hard), (conversations.damage(rows), damaged(hard))):
        found = sorted(map(tuple, conversations.report(given, rows).collect()), key=repr)
        assert found == brute(wanted, ids)


def test_query(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    found = sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, SF_DIR).collect()), key=repr)
    assert found == brute(damaged(rows), {row[0] for row in rows})


def test_repaired_rows_are_legal_and_give_the_digest(spark, hard):
    rows = spark.createDataFrame([(*row, "k", "s", "p") for row in hard], SCHEMA)
    texts = defaultdict(list)
    for row in sorted(conversations.repaired(rows).collect(), key=lambda r: r.place):
        assert row.place == len(texts[row.conv_id])
        texts[row.conv_id].append(row)
    for row in conversations.report(rows).collect():
        kept = texts[row.conv_id]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))
        assert "".join(r.edit for r in kept) == row.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == row.repaired_sha256


def test_no_rows(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert conversations.report(nothing).collect() == [] and conversations.repaired(nothing).collect() == []
    ids = spark.createDataFrame([(3,), (None,), (3,)], "conv_id long")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, conversations.report(nothing, ids).collect()), key=repr) == [(x, 0, 0, 0, 0, 0, 0, "", empty) for x in (3, None)]


def test_large_conversation(spark):
    """A third of all rows in one conversation, many of them equal."""
    long = [(1, i, "ua"[i % 2], "yes." if i % 5 else f"number {i}.") for i in range(40_000)]
    rest = [(2 + i // 4, i % 4, ["user", "assistant"][i % 2], f"t {i}.") for i in range(80_000)]
    rows = spark.createDataFrame(long + rest, "conv_id long, turn long, role string, text string").repartition(4)
    found = {row.conv_id: tuple(row) for row in conversations.report(rows).collect()}
    assert len(found) == 20_001 and found[1] == brute(long, [1])[0]
    assert {row[6:8] for key, row in found.items() if key != 1} == {(0, "KKKK")}


def test_symbols_are_dealt_evenly(spark):
    rows = spark.range(0, 30_000, 1, 4).selectExpr("if(id % 3 = 0, '7', cast(id as string)) as key", "1L as turn", "'user' as role", "'same.' as text")
    found = conversations.symbols(rows)
    assert found.groupBy("symbol").count().orderBy("symbol").collect() == [("e", 20_000), ("h", 10_000)]
    sizes = found.groupBy((found.pos / 2**33).cast("int")).count().collect()
    assert len(sizes) == 4 and max(n for _, n in sizes) < 15_000


def test_re_pair_keeps_the_strings():
    rng = random.Random(5)
    strings = [[rng.choice([0, 0, 0, 1, 2]) for _ in range(rng.randint(1, 40))] for _ in range(80)] + [[1] * 33]
    rules, rest = conversations.re_pair([np.array(s) for s in strings])
    full = {i: [i] for i in range(16)}
    for number, (left, right) in enumerate(rules, 16):
        full[number] = full[left] + full[right]
    assert [sum((full[x] for x in r.tolist()), []) for r in rest] == strings
    pairs = defaultdict(int)
    for r in rest:
        for pair in set(zip(r.tolist(), r.tolist()[1:])):
            pairs[pair] += 1
    assert max(pairs.values(), default=0) < 2 and sum(map(len, rest)) < sum(map(len, strings)) / 3
    assert conversations.re_pair([]) == ([], [])


def test_ropes_compare_as_their_texts():
    rng = random.Random(6)
    ropes = [Rope(x) for x in ("", "D", "DK", "K", "R", "DD")]
    for _ in range(300):
        ropes.append(rng.choice(ropes[-40:]) + rng.choice(ropes[-40:]))
    for _ in range(3000):
        a, b = rng.choice(ropes), rng.choice(ropes)
        if a.size + b.size < 100_000:
            assert a.before(b) == (str(a) < str(b))
