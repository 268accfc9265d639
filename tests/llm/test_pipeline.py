"""Every stage against what it must keep, on its own input; the whole run against the stages."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from folioscope.llm import simhash, toxicity
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables
from tests.llm.test_bpe import wanted
from tests.llm.test_pii import plain
from tests.llm.test_simhash import expected

STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_stages_are_the_dealt_ones_and_keep_the_columns(spark, docs):
    assert list(STAGES) == ["toxicity", "simhash", "pii", "mixing", "bpe"]
    for name in list(STAGES)[:-1]:
        assert STAGES[name](spark, docs, SMALL).dtypes == docs.dtypes


def test_toxic_documents_go(spark, docs):
    scored = QUERIES["op7_toxicity"](spark, SMALL)
    want = {r.doc_id for r in scored.filter("predicted = 0").collect()}
    assert {r.doc_id for r in STAGES["toxicity"](spark, docs, SMALL).collect()} == want


def test_one_document_of_each_group_stays(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    want = {i for i, _, c in expected([r[0] for r in rows], [r[1] for r in rows]) if i == c}
    assert {r.doc_id for r in STAGES["simhash"](spark, docs, SMALL).collect()} == want


def test_copies_with_null_and_repeated_ids(spark):
    texts = ["a b c d", "a b c d", None, "", "other words here now", "other words here now", "z z z"]
    own = documents(spark, texts, ids=[None, 7, 8, 9, 4, 4, 4])
    kept = STAGES["simhash"](spark, own.selectExpr("*", "1 AS fp", "2 AS dedup_key"), SMALL).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == [
        (4, "other words here now"), (4, "z z z"), (7, "a b c d")]
    assert [r.doc_id for r in kept if not r.text] == [8]


def test_personal_data_is_masked_and_the_rest_stays(spark, docs):
    before = {r.doc_id: r for r in docs.collect()}
    after = {r.doc_id: r for r in STAGES["pii"](spark, docs, SMALL).collect()}
    assert after.keys() == before.keys()
    for i, row in after.items():
        assert sum(plain(row.text)[0][:4]) == 0
        assert row.n_chars == len(row.text)
        if "<" not in row.text or not re.search("<(EMAIL|IP|CARD|PHONE)>", row.text):
            assert row == before[i]


def test_documents_are_repeated_as_the_mix_takes_them(spark, docs):
    taken = QUERIES["op3_mixing"](spark, SMALL).collect()
    want = {r.doc_id: r.taken // r["size"] for r in taken if r["size"] and r.taken}
    got = STAGES["mixing"](spark, docs, SMALL).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == want


def test_whole_run(spark, docs):
    got = QUERIES["pipeline"](spark, SMALL).collect()
    step = docs
    for name in list(STAGES)[:-1]:
        step = STAGES[name](spark, step, SMALL)
    texts = step.select("doc_id", "text").collect()
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((r.doc_id, wanted(r.text)[0]) for r in texts)
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_awkward_tables(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    empty = tables(tmp_path / "a", documents=documents(spark, []), labels=labels)
    assert QUERIES["pipeline"](spark, empty).count() == 0
    draw = random.Random(5)
    texts = [None, "", "x y z " * 30_000, "call +1 212 555 1234 now please"] + [
        " ".join(draw.choice(["red", "blue", "green", "grey"]) for _ in range(12)) for _ in range(8)
    ]
    odd = documents(spark, texts, ids=[None, 1, 2, 3, *range(3, 11)], sources=[None, "a"] * 6)
    folder = tables(tmp_path / "b", documents=odd, labels=labels)
    rows = QUERIES["pipeline"](spark, folder).collect()
    assert {r.doc_id for r in rows} <= {None, *range(11)} and len(rows) > 0
