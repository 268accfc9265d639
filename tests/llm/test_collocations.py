"""Collocations against plain counts, the Misra-Gries guarantee, the SQL, and awkward tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folioscope.llm import collocations
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables
from tools.compare import connect, difference


def plain(rows, per_lang=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        rows = []
        for p, a in f.items():
            if len(p) < 2 or a < 10:
                continue
            s, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            around = [b for q, b in f.items() if len(q) == 3 > len(p) and b >= 10 and p in (q[:2], q[1:])]
            if all(100 * b < 50 * a for b in around):
                rows.append((-s, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], totals[lang], s))
        for rank, (_, _, p, *rest) in enumerate(sorted(rows)[:per_lang], 1):
            out.append((lang, rank, p.decode(), *rest))
    return sorted(out)


def rows_of(frame):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


def chatter(seed, n_texts):
    draw = random.Random(seed)
    words = ["The", "of", "é", "new", "york", "city", "a-b", "Ünder", "x", "y z", "New"] + [
        f"w{i}" for i in range(300)
    ]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! "]
    weight = [1 / (i + 1) for i in range(len(words))]
    return [
        "".join(w + draw.choice(ends) for w in draw.choices(words, weight, k=draw.randint(1, 60)))
        for _ in range(n_texts)
    ]


def test_query_matches_sql(spark):
    got = QUERIES["op11_collocations"](spark, SMALL).toPandas()
    want = connect(SMALL).execute(entry.oracle_sql()["op11_collocations"]).df()
    assert len(want) > 100 and difference(got, want) is None


@pytest.mark.parametrize(
    "sizes", [{}, {"mass_per_part": 500, "chunk": 700}, {"map_bits": 8, "mass_per_part": 3000, "chunk": 999}]
)
def test_phrases_match_plain_counts(spark, tmp_path, sizes):
    texts = chatter(3, 400) + [None, "", " . ,", "end. start", "hot phrase " * 5000, "hot phrase"]
    langs = ["en"] * 250 + ["de"] * 100 + [None] * 50 + ["en", "en", None, "und", "en", "fr"]
    docs = documents(spark, texts, langs=langs).selectExpr("*", "'p' AS phrase", "1 AS words", "2 AS f", "3 AS n")
    got = rows_of(collocations.mine(docs.repartition(5), **sizes))
    assert got and got == plain(list(zip(langs, texts)))


def test_few_phrases_per_language(spark):
    texts = chatter(4, 300)
    docs = documents(spark, texts, langs=["en", "de"] * 150)
    got = rows_of(collocations.mine(docs, per_lang=7))
    assert got == plain(list(zip(["en", "de"] * 150, texts)), 7)


@pytest.mark.parametrize("seed", range(4))
def test_merged_summaries_keep_what_is_frequent(seed):
    draw = random.Random(seed)
    lists = [[int(draw.paretovariate(0.5)) % 5000 for _ in range(draw.randint(1, 2000))] for _ in range(9)]
    whole = Counter(x for items in lists for x in items)
    mass, threshold = sum(whole.values()), 10
    summaries = [
        (np.array(sorted(c), np.uint32), np.array([c[k] for k in sorted(c)], np.uint32))
        for c in map(Counter, lists)
    ]
    codes, counts, taken = collocations.merge(summaries, mass // threshold + 1)
    held = dict(zip(codes.tolist(), counts.tolist()))
    assert len(held) <= mass // threshold + 1 and taken < threshold
    assert all(held[x] + taken >= n for x, n in whole.items() if n >= threshold)
    assert all(held[x] > n - threshold for x, n in whole.items() if n >= threshold)
    assert all(n <= whole[x] for x, n in held.items())


def test_scores_are_exact_beyond_64_bits(spark):
    numbers = [(10**12, 10**12 + 1, 3 * 10**12), (9 * 10**15, 9 * 10**15, 9 * 10**15), (10, 10, 333)]
    frame = spark.createDataFrame(numbers, "a bigint, l bigint, r bigint")
    got = frame.select(collocations.exact_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r.s for r in got] == [10**6 * a * a // (b * c) for a, b, c in numbers]


def test_parts_wanted_often_are_looked_up_alike(spark):
    wanted = spark.range(1000).selectExpr("id", "'en' AS lang", "concat('w', int(sqrt(id))) AS part")
    held = spark.range(25).selectExpr("'en' AS lang", "concat('w', id) AS part", "id * 10 AS f")
    want = sorted((r.id, r.f) for r in wanted.join(held, ["lang", "part"]).collect())
    for uses in (1, 30, 10_000):
        got = collocations.look_up(wanted, held, uses).select("id", "f").collect()
        assert sorted((r.id, r.f) for r in got) == want


@pytest.mark.parametrize("texts", [[], [None, "", "one two"]])
def test_tables_without_phrases(spark, tmp_path, texts):
    folder = tables(tmp_path, documents=documents(spark, texts))
    assert QUERIES["op11_collocations"](spark, folder).count() == 0
