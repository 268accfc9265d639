"""Samples against generalised Jaccard similarity; neighbours and digests against a plain loop."""

import hashlib
from collections import Counter

import pytest

from folioscope.llm import fingerprint
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def plain(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(text)
        changed = text[: n - n // 2] + following[: n // 2]
        yield i, n, hashlib.sha256(changed.encode()).hexdigest(), jaccard(text, changed), jaccard(text, following)


@pytest.mark.parametrize("bucket_rows", [1, 7, 1024])
def test_neighbours_over_any_buckets(spark, bucket_rows):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, fingerprint.fingerprints(docs, bucket_rows=bucket_rows).collect()))
    want = sorted(plain(rows))
    assert [r[:3] for r in got] == [w[:3] for w in want]
    for column in (5, 6):
        off = [abs(r[column] - w[column - 2]) for r, w in zip(got, want)]
        assert max(off) < 0.25 and sum(off) / len(off) < 0.05
    assert {r[5] for r, w in zip(got, want) if w[3] == 1.0} <= {1.0}


def test_query_on_hard_cases(spark, tmp_path):
    texts = ["a b c", None, "", "é😀漢 x", "a b c", " ", "w " * 50_000 + "x", "q", "a b c"]
    ids = [3, 1, None, 9, 3, -4, 7, 8, 20]
    docs = documents(spark, texts, ids=ids).selectExpr("*", "1 AS bucket", "true AS guest", "2 AS id")
    got = QUERIES["op8_fingerprints"](spark, tables(tmp_path, documents=docs)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    want = sorted(plain(zip(ids, texts)), key=key)
    got = sorted(map(tuple, got), key=key)
    assert [r[:3] for r in got] == [w[:3] for w in want]
    same = {r[3] for r in got if r[0] in (3, 20)}
    assert len(same) == 1
    assert all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in got)


@pytest.mark.parametrize("texts", [[], ["lone text"]])
def test_empty_table_and_lone_row(spark, tmp_path, texts):
    got = QUERIES["op8_fingerprints"](spark, tables(tmp_path, documents=documents(spark, texts)))
    assert [(r.n_chars, r.near_next) for r in got.collect()] == [(len(t), 1.0) for t in texts]


def test_samples_are_weighted():
    sampler = fingerprint.Sampler(512)
    a, b = "x " * 30 + "y z", "x " * 10 + "y z w"
    found = fingerprint.likeness(sampler.sample(a), sampler.sample(b))
    assert abs(found - jaccard(a, b)) < 0.08


def test_long_texts_without_common_words_are_unlike():
    sampler = fingerprint.Sampler()
    a, b = (" ".join(f"{side}{i}" for i in range(50_000)) for side in "ab")
    assert fingerprint.likeness(sampler.sample(a), sampler.sample(b)) < 0.03


def test_terms_beyond_the_memo_have_the_same_variables():
    text = " ".join(f"w{i % 700}" for i in range(1000))
    few, many = fingerprint.Sampler(memo=50), fingerprint.Sampler()
    assert (few.sample(text) == many.sample(text)).all()
    assert len(few.memo) == 50


def test_terms_that_made_room_get_the_same_values(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    whole, small, learnt = fingerprint.Sampler(), fingerprint.Sampler(memo=300), fingerprint.Sampler(memo=2000)
    for at in range(0, len(texts), 8):
        bags = [Counter(t.split()) for t in texts[at : at + 8]]
        learnt.learn(bags)
        for text, bag in zip(texts[at : at + 8], bags):
            want = fingerprint.as_text(whole.sample(text))
            assert fingerprint.as_text(small.sample(text)) == want
            assert fingerprint.as_text(learnt.sample_bag(bag)) == want
    assert len(small.memo) <= 300 and len(learnt.memo) <= 2000
