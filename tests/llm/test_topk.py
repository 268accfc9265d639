"""Top-k against its SQL and against a plain loop on awkward vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folioscope.llm import topk
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, tables
from tools.compare import connect, difference

SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, k=20):
    usable = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q % 20:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], start=1)]
    return sorted(out)


def test_query_matches_sql(spark):
    got = QUERIES["op4_topk"](spark, SMALL).toPandas()
    assert difference(got, connect(SMALL).execute(entry.oracle_sql()["op4_topk"]).df()) is None


@pytest.mark.parametrize("candidate_rows, query_rows", [(1, 1), (7, 3), (8192, 4096)])
def test_blocks_of_any_size(spark, candidate_rows, query_rows):
    draw = random.Random(candidate_rows)
    rows = [(i, [draw.choice([0.0, 0.0, draw.uniform(-1, 1), 0.5]) for _ in range(6)]) for i in range(90)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(100, 140)]  # ties at the edge
    frame = spark.createDataFrame(rows, SCHEMA)
    found = topk.top_k(
        frame, F.col("vec_id") % 20 == 0, k=5, candidate_rows=candidate_rows, query_rows=query_rows
    )
    assert sorted(map(tuple, found.collect())) == plain(rows, 5)


def test_queries_fill_as_few_blocks_as_they_need(spark, monkeypatch):
    made = []
    written = topk.stable

    def watched(frame):
        out = written(frame)
        if "block" in out.columns and "id" not in out.columns:
            made.append(out.count())
        return out

    monkeypatch.setattr(topk, "stable", watched)
    rows = spark.range(4000).repartition(40).selectExpr("id AS vec_id", "array(1D, id / 7D) AS embedding")
    found = topk.top_k(rows, F.col("vec_id") % 20 == 0, k=2, query_rows=50)
    assert found.count() == 400
    # 200 queries over 40 partitions: four blocks of 50
    assert made[1] == 4


def test_nulls_lengths_repeats_and_large_values(spark, tmp_path):
    rows = [
        (0, [1.0, -1.0]),
        (1, None),
        (2, [1.0, None]),
        (3, [float("nan"), 1.0]),
        (4, [float("inf")]),
        (5, []),
        (6, [0.5]),
        (7, [1e7, 1e7, 1e7]),
        (7, [1e7, 1e7, 1e7]),
        (None, [1.0]),
        (20, [1e8, 1e8]),
        (40, []),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS id", "3 AS v")
    got = QUERIES["op4_topk"](spark, tables(tmp_path, embeddings=frame)).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_empty_table_and_no_query(spark, tmp_path):
    empty = tables(tmp_path / "a", embeddings=spark.createDataFrame([], SCHEMA))
    none = tables(tmp_path / "b", embeddings=spark.createDataFrame([(1, [1.0])], SCHEMA))
    assert QUERIES["op4_topk"](spark, empty).count() == 0
    assert QUERIES["op4_topk"](spark, none).count() == 0
