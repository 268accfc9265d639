"""The mix against its SQL, a plain loop for the targets, and awkward tables."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folioscope.llm import mixing
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables
from tools.compare import connect, difference


def plain_targets(sizes):
    """Shares by weight; what a source cannot take goes to the others by weight, until none can't."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in stopped]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return stopped | share
        for s in over:
            stopped[s] = 2.0 * sizes[s]
            left -= stopped[s]


def test_query_matches_sql(spark):
    got = QUERIES["op3_mixing"](spark, SMALL).toPandas()
    want = connect(SMALL).execute(entry.oracle_sql()["op3_mixing"]).df()
    assert difference(got, want) is None


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i}": draw.choice([0, 3, 50, 1000, 40_000]) for i in range(draw.randint(1, 11))}
    sizes[None] = 77
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_taken_words_come_near_the_target(spark, tmp_path):
    draw = random.Random(1)
    texts = ["w " * draw.randint(0, 60) for _ in range(900)]
    sources = [draw.choice(["hot", "hot", "hot", "a", "é", "z", None]) for _ in texts]
    docs = documents(spark, texts, sources=sources)
    folder = tables(tmp_path, documents=docs.selectExpr("*", "1 AS mix_slice", "2 AS plan_source"))
    got = QUERIES["op3_mixing"](spark, folder).withColumn("source", F.lit(None)).collect()
    again = QUERIES["op3_mixing"](spark, folder).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    taken, target = {}, {}
    for r in got:
        source = sources[r.doc_id]
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r.taken
        target[source] = r.target
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)


def test_columns_of_the_input_are_kept_whatever_their_names(spark):
    docs = documents(spark, ["a b", "c", "d e f"]).selectExpr(
        "*", "1 AS mix_key", "2 AS plan_source", "3 AS mix_size", "4 AS doc", "5 AS mix_slice", "6 AS rest"
    )
    got = mixing.mix(docs)
    assert sorted(got.columns) == sorted({*docs.columns, "mix_source_size", "mix_target", "mix_copies"})
    for r in got.collect():
        assert (r.mix_key, r.plan_source, r.doc, r.mix_slice, r.rest) == (1, 2, 4, 5, 6)
        assert r.mix_size == len(r.text.split())


def test_a_source_of_odd_signs_is_cut_where_its_keys_are(spark):
    """Texts of the lowest quality crowd into the last slice; the order must still be by key."""
    texts = [" ".join(["1" * 40] * (1 + i % 5)) for i in range(3000)]
    docs = documents(spark, texts)
    found = mixing.mix(docs, slices=16).select("doc_id", "mix_size", "mix_copies", "mix_target").collect()
    keys = mixing.keyed(docs, "doc_id", "text", "source", 16).select("doc_id", "mix_key", "mix_slice").collect()
    in_last = sum(r.mix_slice == 15 for r in keys)
    assert in_last > 2000
    key = {r.doc_id: r.mix_key for r in keys}
    epochs = min(r.mix_copies for r in found)
    taken = [key[r.doc_id] for r in found if r.mix_copies > epochs]
    left = [key[r.doc_id] for r in found if r.mix_copies == epochs]
    assert taken and left and max(taken) < min(left)
    assert abs(sum(r.mix_size * r.mix_copies for r in found) - found[0].mix_target) <= 5


def test_nulls_empty_long_and_repeated_rows(spark, tmp_path):
    texts = [None, "", " ", "a b", "a b", "x " * 200_000, "q"]
    docs = documents(spark, texts, ids=[1, None, 2, 3, 3, 4, 5], sources=[None, "s", "s", "t", "t", "u", None])
    got = QUERIES["op3_mixing"](spark, tables(tmp_path, documents=docs)).collect()
    assert sorted(r["size"] for r in got) == [0, 0, 0, 1, 2, 2, 200_000]
    assert len({r.taken for r in got if r.doc_id == 3}) == 1


@pytest.mark.parametrize("texts", [[], ["", None]])
def test_tables_without_words(spark, tmp_path, texts):
    got = QUERIES["op3_mixing"](spark, tables(tmp_path, documents=documents(spark, texts))).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * len(texts)
