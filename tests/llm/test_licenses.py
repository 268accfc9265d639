"""Phrases against a plain loop over words; templates against accepted and refused wordings."""

import re

import pytest

from folioscope.llm import licenses
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                starts.append(i)
                labels.add(label)
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(labels)),
    )


HARD = [
    None,
    "",
    "...",
    "CC BY cc-by cc by cc by MIT LICENSE, mit_license mitlicense",
    "Licensed under the Apache License, Version 2.0",
    "x" * 100_000 + " gnu General (public) license " + "apache license " * 20_000,
    "é漢 cc\x7fby 😀cc by Éapache license",
]


def test_query_on_hard_cases_and_small_tables(spark, tmp_path):
    texts = HARD + HARD[3:5]
    docs = documents(spark, texts).selectExpr("*", "1 AS lic_score", "'x' AS labels")
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    cases = [
        (tables(tmp_path, documents=docs.drop("lic_score")), dict(enumerate(texts))),
        (SMALL, dict(map(tuple, rows))),
    ]
    for folder, by_id in cases:
        got = QUERIES["op6_licenses"](spark, folder).collect()
        assert len(got) == len(by_id)
        for r in got:
            assert tuple(r[1:6]) == plain(by_id[r.doc_id]), by_id[r.doc_id]
            assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
            assert 0 <= r.score <= 1


def accepts(markup, text):
    scanner = licenses.Scanner({}, {"t": markup})
    return scanner.scan(text.encode())[5] == "t"


@pytest.mark.parametrize(
    "markup, yes, no",
    [
        ("a b c", ["x A, b-c y"], ["a b", "a x b c", "a b cc"]),
        ("a <<?b <<?c>>>> d", ["a d", "a b d", "a b c d"], ["a c d", "a b c c d"]),
        ("a <<=b c|d>> e", ["a b c e", "a d e"], ["a e", "a b e", "a b c d e"]),
        ("a <<~[0-9]+>> b", ["a 12 b"], ["a b", "a x b", "a 1 2 b"]),
        ("a <<*2>> b", ["a b", "a x b", "a x y b"], ["a x y z b"]),
        ("<<?opening words>> a b c", ["a b c", "opening words a b c"], ["opening words a b"]),
    ],
)
def test_regions(markup, yes, no):
    assert all(accepts(markup, t) for t in yes)
    assert not any(accepts(markup, t) for t in no)


def test_whole_license_text_with_a_changed_word_is_refused():
    own = re.sub(r"<<\?[^<>]*>>", "", licenses.TEMPLATES["mit-text"])
    text = re.sub(r"<<=([^|]*)\|[^>]*>>", r"\1", own)
    scanner = licenses.Scanner()
    assert "mit-text" in scanner.scan(text.encode())[5]
    changed = scanner.scan(text.replace("sublicense", "relicense").encode())
    assert "mit-text" not in changed[5] and 0.2 < changed[6] < 1


def test_empty_table(spark, tmp_path):
    folder = tables(tmp_path, documents=documents(spark, []))
    assert QUERIES["op6_licenses"](spark, folder).count() == 0


TEXTS = [n for n in licenses.TEMPLATES if n.endswith("-text")]


@pytest.mark.parametrize("name", TEXTS)
def test_whole_texts_are_accepted_and_those_without_the_disclaimer_refused(name):
    markup = licenses.TEMPLATES[name]
    for _ in range(3):  # optional regions go, of others the first wording stays
        markup = re.sub(r"<<\?[^<>]*>>", "", markup)
        markup = re.sub(r"<<=([^<>|]*)[^<>]*>>", r"\1", markup)
        markup = re.sub(r"<<\*[0-9]+>>", "the foo team", markup)
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    assert name in scanner.scan(f"Copyright A. {markup}.".encode())[5]
    place = max(markup.rfind("is provided"), markup.find("in no event"))
    cut = markup[: markup.rfind(" ", 0, place)]
    assert len(cut) < len(markup) and name not in scanner.scan(cut.encode())[5]
