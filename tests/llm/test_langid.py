"""Forward-backward against all label paths, held-out accuracy, and awkward tables."""

import random
from itertools import product

import numpy as np
import pytest

from folioscope.llm import langid
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables


def test_forward_backward_sums_all_paths():
    draw = np.random.default_rng(2)
    change = draw.normal(size=(3, 3))
    texts = [draw.normal(size=(n, 3)) for n in (5, 4, 4, 1)]
    found, pairs = langid.forward_backward(texts, change, True)
    want_pairs = np.zeros((3, 3))
    for i, scores in enumerate(texts):
        want, total, own = np.zeros_like(scores), 0.0, np.zeros((3, 3))
        for path in product(range(3), repeat=len(scores)):
            weight = np.exp(
                sum(s[y] for s, y in zip(scores, path)) + sum(change[a, b] for a, b in zip(path, path[1:]))
            )
            total += weight
            for t, y in enumerate(path):
                want[t, y] += weight
            for a, b in zip(path, path[1:]):
                own[a, b] += weight
        assert found[: len(scores), i] == pytest.approx(want / total)
        want_pairs += own / total
    assert pairs == pytest.approx(want_pairs)


def test_gradient_by_differences():
    draw = np.random.default_rng(4)
    weights = draw.normal(size=(langid.FEATURES, 2)).astype(np.float32)
    field = langid.Field(["a", "b"], weights, draw.normal(size=(2, 2)))
    odds = {"one": np.array([0.0, -2.0]), "two": np.array([-2.0, 0.0])}
    texts, owns = ["one two one", "two"], [0, 1]

    def likelihood(change):
        total = 0.0
        for text, own in zip(texts, owns):
            words = langid.words_of(text)
            gold = langid.label_words(words, own, odds, 2)
            scores = [weights[langid.features(w)].sum(axis=0).astype(float) for w in words]

            def path_score(path):
                return sum(s[y] for s, y in zip(scores, path)) + sum(change[a, b] for a, b in zip(path, path[1:]))

            paths = product(range(2), repeat=len(words))
            total += path_score(gold) - np.log(sum(np.exp(path_score(p)) for p in paths))
        return total

    _, by_pair, n = langid.gradient(texts, owns, field, odds)
    assert n == 4
    for a, b in product(range(2), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        slope = (likelihood(field.transitions + step) - likelihood(field.transitions - step)) / 2e-5
        assert by_pair[a, b] == pytest.approx(slope, abs=1e-3)


def test_held_out_documents_of_small_tables(spark):
    langs = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect())
    got = QUERIES["op5_langid"](spark, SMALL).collect()
    assert len(got) == len(langs)
    unseen = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in unseen) >= 0.9 * len(unseen)


def test_code_switched_words(spark):
    draw = random.Random(0)
    a, b = "the of and ing ther".split(), "le que de aux elle".split()
    texts, langs = [], []
    for i in range(120):
        own, other = (a, b) if i % 2 else (b, a)
        words = [draw.choice(own) for _ in range(30)]
        words[10:16] = [draw.choice(other) for _ in range(6)]
        texts.append(" ".join(words))
        langs.append("en" if i % 2 else "fr")
    field = langid.fit(documents(spark, texts, langs=langs))
    emissions = langid.Emissions(field)
    words = ["the", "of"] * 8 + ["le", "que"] * 4 + ["and", "the"] * 8
    found, _ = langid.forward_backward([emissions.rows(words)], field.transitions)
    picked = [field.languages[i] for i in found[:, 0].argmax(axis=1)]
    assert picked == ["en"] * 16 + ["fr"] * 8 + ["en"] * 16


def test_nulls_empty_long_and_repeated_rows(spark, tmp_path):
    texts = ["the of and " * 5, "le que de " * 5] * 12 + [None, "", "12 !", "the of " * 40_000, "² x", "²"]
    langs = ["en", "fr"] * 12 + [None, "en", "fr", None, None, None]
    docs = documents(spark, texts, langs=langs).selectExpr("*", "1 AS own", "2 AS lang_pred")
    got = {r.doc_id: r for r in QUERIES["op5_langid"](spark, tables(tmp_path, documents=docs)).collect()}
    assert [got[i].lang_pred for i in (24, 25, 26, 29)] == ["und"] * 4
    assert got[27].lang_pred == "en" and got[28].lang_pred in ("en", "fr")
    assert all(0 <= r.score <= 1 for r in got.values())


@pytest.mark.parametrize("texts", [[], ["a b"]])
def test_without_languages(spark, tmp_path, texts):
    docs = documents(spark, texts, langs=[None] * len(texts))
    got = QUERIES["op5_langid"](spark, tables(tmp_path, documents=docs)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(texts)


def test_long_runs_are_read_whole():
    run = "".join(chr(0x4E00 + i) for i in range(95))
    pieces = langid.words_of(f"one {run} two")
    assert pieces == ["one", run[:40], run[40:80], run[80:], "two"]
    a, b = "x" * 45 + "abc" + "y" * 10, "x" * 45 + "cba" + "y" * 10
    read = [[langid.features(w) for w in langid.words_of(t)] for t in (a, b)]
    assert read[0] != read[1]


def test_all_languages_are_learned(spark):
    texts = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(210) for _ in range(3)]
    langs = [f"l{i:03d}" for i in range(210) for _ in range(3)]
    _, languages = langid.sample_of(documents(spark, texts, langs=langs), "doc_id", "text", "lang", 5)
    assert len(languages) > 200
