"""Phrase search: analysed words adjacent and in order, ranked by BM25 of the phrase."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import let
from folioscope.session import stable

K1 = 1.2
B = 0.75

ANALYSED_WORD = r"[\p{L}\p{N}_]++(?:['’][\p{L}\p{N}_]++)*+"


def analyse(text: Column) -> Column:
    """Lower-cased word positions of a text field."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(ANALYSED_WORD), F.lit(0))


def phrase_words(phrase: str) -> list[str]:
    return re.findall(r"\w+(?:['’]\w+)*", phrase.lower())


def phrase_frequency(terms: Column, phrase: list[str]) -> Column:
    """Number of positions where all words of ``phrase`` follow one another."""
    last = F.size(terms) - len(phrase)

    def starts_here(i: Column) -> Column:
        hit = F.get(terms, i) == phrase[0]
        for step, word in enumerate(phrase[1:], 1):
            hit = hit & (F.get(terms, i + step) == word)
        return hit

    places = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), starts_here)
    return F.when(last >= 0, F.size(places)).otherwise(0)


def _could_match(text: Column, phrase: list[str]) -> Column:
    """Cheap test before any text is split into words."""
    lowered = F.lower(text)
    test = F.contains(lowered, F.lit(phrase[0]))
    for word in phrase[1:]:
        test = test & F.contains(lowered, F.lit(word))
    return test


def match_phrase(docs: DataFrame, text: str, phrase: str) -> DataFrame:
    """The rows that hold the phrase, with its frequency ``freq`` and length ``n_words``."""
    wanted = phrase_words(phrase)
    if not wanted:
        no_hit = F.lit(0).cast("bigint")
        return docs.where(F.lit(False)).withColumns({"freq": no_hit, "n_words": no_hit})
    # both numbers come from one pass over the words of the row
    counted = let(
        analyse(F.col(text)),
        lambda terms: F.struct(
            phrase_frequency(terms, wanted).cast("bigint").alias("freq"),
            F.size(terms).cast("bigint").alias("n_words"),
        ),
    )
    return (
        docs.where(_could_match(F.col(text), wanted))
        .select("*", F.inline(F.array(counted)))
        .where(F.col("freq") > 0)
    )


def phrase_counts(docs: DataFrame, key: str, text: str, phrase: str) -> DataFrame:
    """``(key, n_words, freq, has)`` per document with words: one splitting of each text.

    ``has`` tells for each word of the phrase whether the document holds it. Statistics, hits and
    their total all follow from this narrow table.
    """
    wanted = phrase_words(phrase)

    def measures(terms: Column) -> Column:
        freq = phrase_frequency(terms, wanted) if wanted else F.lit(0)
        has = F.array(*[F.array_contains(terms, w) for w in wanted]).cast("array<boolean>")
        return F.struct(
            F.size(terms).cast("bigint").alias("n_words"),
            freq.cast("bigint").alias("freq"),
            has.alias("has"),
        )

    counted = F.inline_outer(F.array(let(analyse(F.col(text)), measures)))
    return stable(docs.select(key, counted)).where(F.col("n_words") > 0)


def ranked_hits(counts: DataFrame, phrase: str) -> DataFrame:
    """``phrase_counts`` rows that hold the phrase, with their BM25 ``score``."""
    size = len(phrase_words(phrase))
    stats = counts.agg(
        F.count("*").alias("n_docs"),
        F.avg("n_words").alias("avg_words"),
        *[F.count_if(F.get("has", F.lit(i))).alias(f"df{i}") for i in range(size)],
    )
    return _scored(counts.where(F.col("freq") > 0).drop("has"), _with_idf(stats, size))


def _with_idf(counts: DataFrame, size: int) -> DataFrame:
    idf = F.lit(0.0)
    for i in range(size):
        df = F.col(f"df{i}")
        idf = idf + F.log(1 + (F.col("n_docs") - df + 0.5) / (df + 0.5))
    return counts.select("n_docs", "avg_words", idf.alias("idf"))


def _scored(matches: DataFrame, stats: DataFrame) -> DataFrame:
    stat = stats.select(F.struct("avg_words", "idf").alias("s")).scalar()
    freq = F.col("freq")
    norm = K1 * (1 - B + B * F.col("n_words") / stat["avg_words"])
    return matches.withColumn("score", stat["idf"] * freq * (K1 + 1) / (freq + norm))


def corpus_statistics(docs: DataFrame, text: str, phrase: str) -> DataFrame:
    """One row: documents that hold words, their mean length, and the summed idf of the phrase.

    The document frequency of every phrase word comes from the same pass.
    """
    wanted = phrase_words(phrase)
    per_doc = let(
        analyse(F.col(text)),
        lambda terms: F.struct(
            F.size(terms).alias("n_words"),
            *[F.array_contains(terms, w).alias(f"has{i}") for i, w in enumerate(wanted)],
        ),
    )
    counts = (
        docs.select(F.inline(F.array(per_doc)))
        .where(F.col("n_words") > 0)
        .agg(
            F.count("*").alias("n_docs"),
            F.avg("n_words").alias("avg_words"),
            *[F.count_if(F.col(f"has{i}")).alias(f"df{i}") for i in range(len(wanted))],
        )
    )
    return _with_idf(counts, len(wanted))


def phrase_scores(docs: DataFrame, text: str, phrase: str) -> DataFrame:
    """``match_phrase`` rows with their BM25 ``score``; document lengths are exact, not rounded."""
    return _scored(match_phrase(docs, text, phrase), corpus_statistics(docs, text, phrase))


def top_hits(scored: DataFrame, key: str, n: int = 10) -> DataFrame:
    return scored.orderBy(F.desc("score"), key).limit(n)


def hit_total(matches: DataFrame) -> DataFrame:
    """Exact number of matches, taken before any limit."""
    return matches.agg(F.count("*").alias("total"))
