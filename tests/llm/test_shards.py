"""Sharding against the generator in plain integers, its SQL, and awkward tables."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folioscope.llm import shards
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables
from tools.compare import connect, difference


def plain_shard(key, n):
    state = int(hashlib.md5(key.encode()).hexdigest()[:16], 16)
    at, jump = -1, 0
    while jump < n:
        at = jump
        state = (state * 2862933555777941757 + 1) % 2**64
        jump = int((at + 1) * (float(1 << 31) / ((state >> 33) + 1)))
    return at


def test_query_matches_sql(spark):
    got = QUERIES["op12_sharding"](spark, SMALL).toPandas()
    want = connect(SMALL).execute(entry.oracle_sql()["op12_sharding"]).df()
    assert difference(got, want) is None


@pytest.mark.parametrize("n", [1, 2, 8, 100, 5000])
def test_shards_follow_the_generator(spark, n):
    rows = spark.range(3000).select("id", shards.jump_hash(F.col("id"), n).alias("s")).collect()
    assert all(r.s.shard == plain_shard(str(r.id), n) for r in rows)
    assert all(r.s.grown == plain_shard(str(r.id), n + 1) for r in rows)
    # only the necessary fraction moves, and only into the new shard
    moved = [r for r in rows if r.s.grown != r.s.shard]
    assert all(r.s.grown == n for r in moved)
    assert abs(len(moved) - 3000 / (n + 1)) < 5 * (3000 / (n + 1)) ** 0.5


def test_a_key_that_jumps_often_ends_in_the_second_fold(spark, monkeypatch):
    monkeypatch.setattr(shards.math, "ceil", lambda x: -3)  # four first steps, then the rest
    rows = spark.range(500).select("id", shards.jump_hash(F.col("id"), 60).alias("s")).collect()
    assert [r.s.shard for r in rows] == [plain_shard(str(r.id), 60) for r in rows]
    assert [r.s.grown for r in rows] == [plain_shard(str(r.id), 61) for r in rows]
    with pytest.raises(ValueError):
        shards.jump_hash(F.lit("a"), 0)


def test_slots_have_no_gaps_and_reruns_agree(spark, tmp_path):
    texts = [None, "", "a", "é" * 40_000, "same", "same"] + ["hot"] * 3000
    ids = [0, 1, 2, 3, 4, 5] + [None] * 2000 + [7] * 1000
    docs = documents(spark, texts, ids=ids)
    docs = docs.selectExpr("*", "1 AS shard", "2 AS slot", "'x' AS size", "3 AS key", "4 AS draw")
    folder = tables(tmp_path, documents=docs)
    rows = QUERIES["op12_sharding"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert (r.law, r.shard, r.grown_shard) == ("key", plain_shard(key, 8), plain_shard(key, 9))
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    known = {r.doc_id: (r["size"], r.text_crc32) for r in rows if r.doc_id is not None and r.doc_id < 6}
    assert known == {
        i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in enumerate(texts[:6])
    }
    assert sorted(map(str, rows)) == sorted(map(str, QUERIES["op12_sharding"](spark, folder).collect()))
    few = shards.number(spark.read.parquet(f"{folder}/documents.parquet"), rows_per_slice=7).collect()
    assert {(r.key, r.slot, r.shard) for r in few} == {(r.doc_id, r.slot, r.shard) for r in rows}


def test_empty_table(spark, tmp_path):
    assert QUERIES["op12_sharding"](spark, tables(tmp_path, documents=documents(spark, []))).count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = documents(spark, [f"text {i}" for i in range(50)])
    shards.write_shards(docs, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.doc_id, r.text, r.shard) for r in back} == {
        (i, f"text {i}", plain_shard(str(i), 3)) for i in range(50)
    }
    with pytest.raises(ValueError):
        shards.assign(docs.withColumn("shard", F.lit(1)))
