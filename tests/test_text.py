import pytest
from pyspark.sql import functions as F

from folioscope.functions import text as X


def apply(spark, function, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[1] for r in rows.select("i", function(F.col("t"))).orderBy("i").collect()]


TOKENS = {
    "We prove $x^2$ holds": ["prove", "holds"],
    "a $$x1$$ bound": ["x1", "bound"],
    "cost $ rises here": ["cost"],
    "\\alpha decay": ["decay"],
    "nan inf 1_000 +.5 3d 2020": [],
    "-- ,. ''": [],
    "": [],
    None: [],
    "State-of-the-art don't B": ["state-of-the-art"],
    "Überraschung, naïve!": ["überraschung", "naïve"],
}


def test_tokens(spark):
    assert apply(spark, X.tokenize, TOKENS) == list(TOKENS.values())


def test_tokens_survive_long_hyphen_chains(spark):
    chain = "-".join(["ab"] * 20000)
    assert apply(spark, X.tokenize, [chain]) == [[chain]]


def test_other_stop_words(spark):
    assert apply(spark, lambda t: X.tokenize(t, ["decay"]), ["the decay"]) == [["the"]]
    assert apply(spark, lambda t: X.tokenize(t, []), ["the decay"]) == [["the", "decay"]]


def is_float(text):
    try:
        float(text)
        return True
    except ValueError:
        return False


def test_is_number_agrees_with_float(spark):
    cases = "nan -nan inf Infinity +inf 1_000 1__0 _1 1_ +.5 5. . 5f 1e5 1e 1e-5 1e+ ٣ ٣.٤ 0x1 1,2 --1".split()
    cases += ["", " 12 ", "\t7\n", "1 2"]
    assert apply(spark, X.is_number, cases) == [is_float(c) for c in cases]


LINES = [
    "", "\n", "a\n", "a\n\nb", "\na", "a\r\nb", "a \x0b b", "a\x1f\nb", "x  y", "\n\n",
    "a\xa0\nb", "\r\n\r\n", " a ", "a\x85b", "a\x1cb\x1dc\x1ed", "a\fb\rc", "one\n  two\n",
]


def test_strip_newlines_agrees_with_line_splitting(spark):
    want = [" ".join(line.strip() for line in t.splitlines()) for t in LINES]
    assert apply(spark, X.strip_newlines, LINES) == want


@pytest.mark.parametrize("tokens", [[], ["b"], ["b", "a", "b", "c", "a", "b"]])
def test_term_counts(spark, tokens):
    row = spark.createDataFrame([(tokens,)], "t array<string>").select(X.term_counts(F.col("t")))
    got = [(x["term"], x["tf"]) for x in row.first()[0]]
    assert got == [(t, tokens.count(t)) for t in sorted(set(tokens))]
