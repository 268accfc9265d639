r"""Text cleaning and tokenising as Column expressions; no Python runs per row."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.stopwords import ENGLISH_STOP_WORDS

LINE_BREAK = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85  ]"
# \x1c-\x1f count as blanks when a line is trimmed, beyond the Unicode white space property
_BLANK = r"[\s\x1c-\x1f]"

# An opening dollar runs to the next one, or to the end of the text when it has no partner.
LATEX_SPAN = r"\$[^$]*(?:\$|\z)"

# A dollar, a LaTeX command, a word with inner hyphens or apostrophes, or any other visible sign.
# Possessive repeats keep the matcher iterative on very long hyphen chains.
WORD = r"\$|\\\p{L}++|[\p{L}\p{N}]++(?:[-'][\p{L}\p{N}]++)*+|[^\s\p{L}\p{N}]"

# The signs a token may consist of to count as punctuation. Of ASCII only the
# backslash is missing.
PUNCTUATION = r"[!'\"#$%&()*+,\-./:;<=>?@\[\]^_`{|}~]+"

_DIGITS = r"\p{Nd}+(?:_\p{Nd}+)*"
NUMBER = (
    rf"(?:(?U){_BLANK}*[+-]?(?:[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN]"
    rf"|(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?){_BLANK}*)"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_newlines(text: Column) -> Column:
    """Put the trimmed lines of ``text`` on one line, one blank between them.

    A blank inner line leaves two blanks, a leading break one; a single trailing break vanishes.
    """
    body = F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", "")
    lines = F.split(body, LINE_BREAK, -1)
    trimmed = F.transform(
        lines, lambda line: F.regexp_replace(line, rf"(?U)^{_BLANK}+|{_BLANK}+\z", "")
    )
    return F.array_join(trimmed, " ")


def strip_latex(text: Column) -> Column:
    """Blank out LaTeX between dollar signs; the parity of the signs decides what is inside."""
    return F.regexp_replace(text, LATEX_SPAN, " ")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def is_number(token: Column) -> Column:
    """True for what a float parser takes: nan, inf, 1_000, +.5 and non-ASCII digits as well."""
    return token.rlike(rf"^{NUMBER}\z")


def tokenize(text: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower-cased content tokens in text order, as ``array<string>``; null text has none.

    Drops LaTeX spans and commands, single characters, stop words, numbers, tokens that start
    with a digit and tokens made of punctuation.
    """
    stop = list(stop_words)
    dropped = rf"^\\|^[0-9]|^{PUNCTUATION}\z|^{NUMBER}\z"

    def keep(token: Column) -> Column:
        # a token that starts with a basic letter is dropped only if it spells a number
        plain = (token >= "a") & (token < "{") & ~token.isin("nan", "inf", "infinity")
        kept = (F.char_length(token) > 1) & (plain | ~token.rlike(dropped))
        return kept & ~token.isin(stop) if stop else kept

    return F.filter(words(strip_latex(F.lower(F.coalesce(text, F.lit(""))))), keep)


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one token array, in term order.

    Sorting the array and measuring its runs counts the terms inside the row, so raw counts
    need no shuffle.
    """

    def runs(sorted_tokens: Column) -> Column:
        n = F.size(sorted_tokens)
        starts = F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == 1)
            | (F.get(sorted_tokens, i - 1) != F.get(sorted_tokens, i - 2)),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, k: F.struct(
                    F.get(sorted_tokens, start - 1).alias("term"),
                    (F.coalesce(F.get(s, k + 1), n + 1) - start).cast("bigint").alias("tf"),
                ),
            ),
        )

    none = F.expr("cast(array() as array<struct<term:string,tf:bigint>>)")
    return let(
        F.sort_array(tokens),
        lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none),
    )
