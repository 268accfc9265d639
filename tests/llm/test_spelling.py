"""Spelling variants against all pairs of words, the bound on affected grams, and awkward tables."""

import random
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
from folioscope.llm import spelling
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables
from tools.compare import connect


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(words):
    friends = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(friends[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(friends[w]), words.get(form[w])))
    return out


def rows_of(frame):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()]


def crowd(seed, n_words, alphabet="abé"):
    """Few letters, so that words lie close to each other; counts spread over several powers of ten."""
    draw = random.Random(seed)
    words = {}
    while len(words) < n_words:
        word = "".join(draw.choice(alphabet) for _ in range(draw.randint(7, 10)))
        words[word] = int(10 ** draw.uniform(0.31, 4))
    return words


def test_query_matches_sql(spark):
    got = rows_of(QUERIES["op13_spelling"](spark, SMALL))
    want = connect(SMALL).execute(
        f"SELECT word, form, root, n, n_near, form_n FROM ({entry.oracle_sql()['op13_spelling']})"
    ).fetchall()
    assert len(got) == len(want) > 2000 and set(got) == set(want)


@pytest.mark.parametrize("capacity, longest", [(20_000, 256), (50, 256), (50, 4), (400, 0), (3, 30)])
def test_all_pairs_are_found_whatever_the_dictionary(spark, capacity, longest):
    words = crowd(capacity, 500) | crowd(1, 200, "abcdefgh")
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = rows_of(spelling.variants(frame, capacity=capacity, longest=longest))
    assert len(got) == len(words) and set(got) == plain_variants(words)


@pytest.mark.parametrize("seed", range(3))
def test_near_words_meet_in_a_list(seed):
    draw = random.Random(seed)
    words = list(crowd(seed, 300, "ab" if seed else "abcd"))
    longest = range(2, spelling.MOST_CHARS + 1)
    counts = Counter(
        p[i : i + q] for w in words for p in [f"<{w}>"] for q in longest for i in range(len(p) - q + 1)
    )
    bar = draw.choice([5, 20, 60])
    dictionary = {g: n for g, n in counts.items() if n > bar}

    def grams(word):
        padded = f"<{word}>"
        found = spelling.decompose(padded, dictionary)
        return Counter(padded[p:q] for p, q in found), spelling.most_affected(found)

    for word in words:
        i, c = draw.randrange(len(word) + 1), draw.choice("abcd")
        for other in (word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :]):
            (own, affected), (theirs, others) = grams(word), grams(other)
            common = sum((own & theirs).values())
            assert common >= max(sum(own.values()) - affected, sum(theirs.values()) - others)
            assert set(spelling.entries(word, dictionary)) & set(spelling.entries(other, dictionary))


def test_texts_with_awkward_rows(spark, tmp_path):
    draw = random.Random(5)
    stems = ["STRASSE" + "É", "naïveté×÷", "abcdefgh", "Ünlangsam", "mathematics", "short"]
    texts = [" ".join(draw.choice(stems) for _ in range(400)) + "1word_wordword" for _ in range(30)]
    texts += [None, "", "x" * 20_000, "x" * 20_000, texts[0], texts[0]]
    ids = list(range(30)) + [None, 31, 32, 32, 0, None]
    docs = documents(spark, texts, ids=ids).selectExpr("*", "'w' AS word", "1 AS n", "2 AS run", "3 AS id")
    got = rows_of(QUERIES["op13_spelling"](spark, tables(tmp_path, documents=docs)))
    words = plain_words(zip(ids, texts))
    assert any(f for _, f, *_ in got) and len(got) == len(words)
    assert set(got) == plain_variants(words)


def test_chain_of_forms(spark):
    words = {"aaaaaaa": 100_000, "aaaaaaab": 10_000, "aaaaaabb": 1_000, "aaaaabbb": 100, "aaaabbbb": 10}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = rows_of(spelling.variants(frame))
    assert {r[2] for r in got} == {"aaaaaaa"} and set(got) == plain_variants(words)


@pytest.mark.parametrize("texts", [[], [None, "", "a b c"]])
def test_tables_without_words(spark, tmp_path, texts):
    folder = tables(tmp_path, documents=documents(spark, texts))
    assert QUERIES["op13_spelling"](spark, folder).count() == 0
