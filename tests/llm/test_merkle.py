"""The manifest against a tree built in plain Python, on tables of many sizes and with hard rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lanewise.llm import merkle
from lanewise.llm.queries import ORACLE, QUERIES
from shipment_checks.compare import connect, difference
from tests.conftest import SF_DIR

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, n string, pos string, g string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(row, text=None):
    values = [row.doc_id, row.source, row.lang, row.n_chars, row.text if text is None else text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """(root, proof of each leaf as (left, right) pairs)."""
    proofs, level, place = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, at in enumerate(place):
            run = level[at // 8 * 8 : at // 8 * 8 + 8]
            proofs[i].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        level = [digest("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        place = [at // 8 for at in place]
    return level[0], proofs


def brute(rows):
    """(doc_id, leaf, subroot, root, proof) of each row, as a bag."""
    groups = defaultdict(list)
    for row in rows:
        groups[row.lang].append(((row.doc_id is not None, row.doc_id or 0, row_digest(row)), row.doc_id, row_digest(row)))
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    below = {name: tree([leaf for _, _, leaf in sorted(groups[name])]) for name in names}
    root, above = tree([below[name][0] for name in names])
    out = []
    for name, more in zip(names, above):
        subroot, proofs = below[name]
        out += [(key, leaf, subroot, root, tuple(proof + more)) for (_, key, leaf), proof in zip(sorted(groups[name]), proofs)]
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, f"Text {i} é", "en" if i % 3 else "de", "a", i, "x", "x", "x", "x") for i in range(150)]
    rows += [(7, "Again", "en", None, 5, *"xxxx"), (7, "Again", "en", None, 5, *"xxxx"), (None, "no id", "en", "a", 5, *"xxxx")]
    rows += [(900, None, None, None, None, *"xxxx"), (901, "", "", "", 0, *"xxxx"), (902, "Z" * 300_000, "zz", "a", 300_000, *"xxxx")]
    rows += [(2**62 + i, "far", "én", "a", 3, *"xxxx") for i in range(9)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_equals_a_plain_tree(hard):
    assert found(merkle.manifest(hard)) == brute(hard.collect())


@pytest.mark.parametrize("fanout_levels", [1, 2])
def test_several_rounds_of_blocks(hard, monkeypatch, fanout_levels):
    """Small blocks make the sweeps pass through storage at each level or two."""
    monkeypatch.setattr(merkle, "LEVELS", fanout_levels)
    monkeypatch.setattr(merkle, "BLOCK", merkle.FANOUT**fanout_levels)
    assert found(merkle.manifest(hard)) == brute(hard.collect())


def test_every_size_of_a_group(spark):
    rows = [(i, "t", f"lang{size:02}", "a", 1, *"xxxx") for size in (1, 2, 7, 8, 9, 63, 64, 65, 66) for i in range(size)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(merkle.manifest(docs)) == brute(docs.collect())


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_claims_that_differ_do_not_lead_to_the_root(hard):
    claim = F.when(F.col("doc_id") == 5, F.sha2(F.lit("other").cast("binary"), 256))
    rows = merkle.manifest(hard, claim=claim).withColumn("to", merkle.folded(F.col("claim"), F.col("proof"))).collect()
    assert {r.doc_id for r in rows if r.to != r.root} == {5} and {r.doc_id for r in rows if r.claim != r.leaf} == {5}


def test_query(spark):
    """Brute force over the whole table, with what was tampered with."""
    docs = {row.doc_id: row for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    proofs = {key: (leaf, subroot, root, proof) for key, leaf, subroot, root, proof in brute(docs.values())}
    for row in QUERIES["op11_merkle_manifest"](spark, SF_DIR).collect():
        leaf, subroot, root, proof = proofs.pop(row.doc_id)
        value = leaf
        if zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
            text = docs[row.doc_id].text
            value = row_digest(docs[row.doc_id], text if text is None else text.encode().lower().decode())
        for left, right in proof:
            value = digest(left + value + right)
        wanted = (leaf, subroot, root, digest("".join(a + b for a, b in proof)), value, value == root)
        assert tuple(row)[1:] == wanted
    assert not proofs


def test_query_equals_sql(spark):
    sql = connect(SF_DIR).execute(ORACLE["op11_merkle_manifest"]).df()
    assert difference(QUERIES["op11_merkle_manifest"](spark, SF_DIR).toPandas(), sql) is None


def test_no_task_holds_a_group(hard, spark, conf):
    """One group with all rows but a few is dealt out by ranges and blocks."""
    rows = spark.range(0, 20_000, 1, 4).select("id", F.lit("en").alias("g"))
    out = merkle.numbered(rows, "g", ["id"])
    sizes = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert out.where("pos = id AND n = 20000").count() == 20_000 and sizes < 10_000
    same = merkle.numbered(rows.withColumn("id", F.lit(1)), "g", ["id"])
    assert same.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 10_000
    assert same.select("pos").distinct().count() == 20_000
