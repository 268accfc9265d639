"""Base spans against the contract's patterns run by a plain loop; votes, training and redaction."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from folioscope.llm import pii
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(
            d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1])
        )
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = [
        (m.start(), i, m.end())
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    kinds = list(PATTERNS)
    described = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found))
    counts = [sum(k == i for _, k, _ in found) for i in range(4)]
    return (*counts, hashlib.sha256(described.encode()).hexdigest()), described


HARD = [
    None,
    "",
    "a@b.c_d@e.f and x@y.z@w.v",
    "mail bob.x+1@mail-3.example.com, é@ü.de, a@b, @c.d, a@b..c",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.002.003.004 and 99999999999.1.1.1 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111111111111111 5 4111 1111 1111 1111",
    "1 2  4111111111111111 - 4111111111111111-+1 (212) 555-1234 +1 (212) 555-12345678901",
    "+12 +1() +1 2 (212) 555-1234 212-555-9876 +49(30).123-4567890",
    "name [at] host.com name (at) host (dot) org",
    "日本 x@y.jp 😀 +1 212 555 1234 😀 192.168.0.1 😀 card 4111111111111111",
    "9" * 30_000 + " " + "a" * 30_000 + "@ " + "+1" + "(" * 20_000 + " x@y.zz",
    "0.0.0.0 127.0.0.1 ip 10.20.30.40.50",
]


def test_base_spans_of_hard_cases(spark, tmp_path):
    docs = documents(spark, HARD + HARD[2:4]).selectExpr("*", "1 AS pii_spans", "2 AS s")
    got = QUERIES["op1_pii"](spark, tables(tmp_path, documents=docs)).orderBy("doc_id").collect()
    for row, text in zip(got, HARD + HARD[2:4]):
        counts, described = plain(text)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256) == counts, text
        assert set(filter(None, described.split(","))) <= set(row.spans.split(","))


def test_query_on_small_tables(spark):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op1_pii"](spark, SMALL).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: tuple(r[1:6]) for r in got} == {i: plain(t)[0] for i, t in texts.items()}
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got) > 0


def test_empty_table(spark, tmp_path):
    assert QUERIES["op1_pii"](spark, tables(tmp_path, documents=documents(spark, []))).count() == 0


def test_expectation_maximisation_trusts_the_reliable_labeler():
    # labelers one and two agree with the truth, labeler three votes at random
    patterns = [(0, v, v, r, True, 100) for v in (1, -1) for r in (1, -1)] + [(0, 1, -1, 1, True, 5)]
    _, rates = pii.reliabilities(patterns)
    assert rates[0][0, True, 1] > 0.9 > 0.6 > rates[0][2, True, 1]


def test_classifier_adds_supported_candidates(spark):
    texts = [f"please call or phone ({200 + i}) 555-{1000 + i}" for i in range(40)]
    texts += [f"please phone +1 ({200 + i}) 555-{1000 + i}" for i in range(200)]
    found = pii.find_spans(documents(spark, texts))
    weights = pii.train(found)
    settled = found.select(
        "doc_id", F.expr("size(filter(pii_spans, s -> s.base))").alias("base"),
        F.size(pii.settle(F.col("pii_spans"), weights)).alias("all"),
    ).collect()
    assert all(r["all"] == 1 for r in settled) and sum(r["base"] for r in settled) == 200


@pytest.mark.parametrize(
    "text, want",
    [
        ("x a@b.cd y", "x <EMAIL> y"),
        ("😀 10.1.2.3, +1 212 555 1234!", "😀 <IP>, <PHONE>!"),
        ("nothing", "nothing"),
    ],
)
def test_redaction(spark, text, want):
    found = pii.find_spans(documents(spark, [text]))
    assert found.select(pii.redact(F.col("text"), F.col("pii_spans"))).first()[0] == want
