"""Segments against all intervals, held-out accuracy, and awkward tables."""

import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import toxicity
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import documents, tables


def best_interval(scores):
    return max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=24))
def test_maximal_segments(scores):
    found = toxicity.maximal_segments([float(s) for s in scores])
    for start, end, score in found:
        assert score == sum(scores[start:end]) > 0
        inner = scores[start:end]
        # every beginning and every end of a maximal segment is positive
        assert all(sum(inner[:i]) > 0 and sum(inner[i:]) > 0 for i in range(1, len(inner)))
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    covered = {i for s, e, _ in found for i in range(s, e)}
    assert covered >= {i for i, s in enumerate(scores) if s > 0}
    assert max((s[2] for s in found), default=0) == max(0, best_interval(scores))


def corpus(spark, folder, n=600):
    draw = random.Random(3)
    texts, labels = [], []
    for i in range(n):
        words = [f"w{draw.randrange(26)}".translate({48 + d: 97 + d for d in range(10)}) for _ in range(draw.randint(5, 80))]
        toxic = draw.random() < 0.25
        if toxic:
            for _ in range(4):
                words.insert(draw.randrange(len(words)), draw.choice(["Vilest!", "(rotten)", "***filth***"]))
        texts.append(" ".join(words))
        labels.append((i, 1 if toxic else 0))
    docs = documents(spark, texts + [None, "", "123 !", "vilest " * 30_000], ids=[*range(n), n, None, n + 1, n + 2])
    rows = spark.createDataFrame([*labels, (5, None), (None, 1), (n, None)], "doc_id bigint, toxic int")
    folder = tables(
        folder,
        documents=docs.selectExpr("*", "0.5 AS tox_score", "1 AS y"),
        labels=rows.selectExpr("*", "1 AS quality"),
    )
    return folder, dict(labels)


def test_held_out_documents(spark, tmp_path):
    folder, labels = corpus(spark, tmp_path)
    got = QUERIES["op7_toxicity"](spark, folder).collect()
    assert len(got) == len(labels) + 4 and all(0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id in labels]
    assert len(unseen) > 50 and all(r.predicted == labels[r.doc_id] for r in unseen)
    by_id = {r.doc_id: r for r in got}
    assert by_id[602].predicted == 1 and by_id[600].predicted == by_id[None].predicted == 0


def test_no_labels_and_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = tables(tmp_path / "a", documents=documents(spark, ["a b"]), labels=none)
    assert [(r.score < 1e-9, r.predicted) for r in QUERIES["op7_toxicity"](spark, one).collect()] == [(True, 0)]
    empty = tables(tmp_path / "b", documents=documents(spark, []), labels=none)
    assert QUERIES["op7_toxicity"](spark, empty).count() == 0


def plain_segments(scores):
    """The segment of highest score, then those on either side of it."""
    spans = [(sum(scores[i:j]), i - j, -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    best, minus, first = max(spans, default=(0, 0, 0))
    if best <= 0:
        return []
    start, end = -first, -first - minus
    return plain_segments(scores[:start]) + [best] + plain_segments(scores[end:])


def plain_score(text, model):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    scores = []
    for w in words:
        stem = next((w[:n] for n in toxicity.STEMS if len(w) > n and w[:n] in model.stems), None)
        scores.append(model.words.get(w, model.stems[stem] if stem else -0.25))
    chance, total, x = model.volume * max(len(words), 1), 0.0, 0.0
    for r, s in enumerate(sorted(plain_segments(scores), reverse=True), 1):
        total += s - math.log(chance)
        if total <= 0:
            break
        tail = math.exp(-total) * total ** (r - 1) / (math.factorial(r) * math.factorial(r - 1))
        x = max(x, -math.log(tail) - r * math.log(2))
    return 1 / (1 + math.exp(-(model.offset + model.slope * min(x, 40.0))))


def test_scores_match_a_plain_version(spark):
    draw = random.Random(8)
    model = toxicity.Model(
        {"bad": 2.5, "awful": 3.1, "nice": -1.2, "so": 0.4}, {"idio": 2.9, "moro": 1.7}, 1.0, 0.02, 0.8, -3.0
    )
    texts = [None, "", "123", "nice nice"] + [
        " ".join(draw.choices("the so bad idiotic nice of x awful Moron! idio".split(), k=draw.randint(1, 14)))
        for _ in range(60)
    ]
    docs = documents(spark, texts)
    got = {r.doc_id: r.tox_score for r in toxicity.score(docs, model).collect()}
    for i, text in enumerate(texts):
        assert abs(got[i] - plain_score(text, model)) < 1e-9


def test_evidence_and_curve_of_a_hand_made_sample(spark):
    assert toxicity.evidence_bar(1_000_000) > toxicity.evidence_bar(1000) > 4
    slope, offset = toxicity._logistic([(0.0, 0, 50.0), (10.0, 1, 40.0), (0.0, 1, 1.0), (10.0, 0, 1.0)])
    curve = [1 / (1 + math.exp(-(offset + slope * x))) for x in (0, 10)]
    assert abs(curve[0] - 1 / 51) < 0.01 and abs(curve[1] - 40 / 41) < 0.01
    # separable points and points that lean the wrong way leave a finite, rising curve
    assert toxicity._logistic([(0.0, 0, 9e4), (40.0, 1, 1e4)])[0] > 0.1
    assert toxicity._logistic([(0.0, 1, 10.0), (9.0, 0, 10.0)])[0] == 0.0


def crowd(spark, folder, copies):
    """Texts of random syllables, a tenth of them toxic, and near copies of all of them."""
    draw = random.Random(11)
    syllables = ["an", "er", "th", "on", "in", "re", "st", "ou", "ha", "wh", "le", "ve"]
    insults = ["moron", "clown", "trash", "loser", "scum"]
    texts, marks = [], []
    for i in range(900):
        words = ["".join(draw.choices(syllables, k=draw.randint(1, 3))) for _ in range(draw.randint(20, 60))]
        toxic = i % 10 == 0
        for _ in range(3 * toxic):
            words.insert(draw.randrange(len(words)), draw.choice(insults))
        for c in range(copies):
            if c:
                words[draw.randrange(len(words))] = "".join(draw.choices(syllables, k=4))
            texts.append(" ".join(words))
            marks.append((len(texts) - 1, int(toxic)))
    docs = documents(spark, texts)
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    return tables(folder, documents=docs, labels=labels.selectExpr("*", "1 AS quality")), dict(marks)


@pytest.mark.parametrize("copies", [1, 20])
def test_near_copies_change_neither_recall_nor_what_is_flagged(spark, tmp_path, copies):
    folder, marks = crowd(spark, tmp_path, copies)
    rows = [r for r in QUERIES["op7_toxicity"](spark, folder).collect() if r.held_out]
    toxic = [r.predicted for r in rows if marks[r.doc_id]]
    clean = [r.predicted for r in rows if not marks[r.doc_id]]
    assert sum(toxic) >= 0.95 * len(toxic) and sum(clean) <= 0.01 * len(clean)
