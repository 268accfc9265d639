"""Spelling variants by an index of variable-length grams.

Words one edit apart are found through a gram dictionary that is pruned by frequency: from each
position of a word, with a mark at either end, the gram grows as long as it is frequent and shorter than
``MOST_CHARS``. Whether a gram stops depends on its own characters alone, so an edit affects just the
grams that hold its place; the most that hold any one place bound how many of a word's grams an edit
can affect. Every word near it shares all the others.

Lists are merged under that bound. A word is entered in the lists of its rarest grams only, one more
than can be affected: the smallest gram that two near words share, in the order of rarity, is among those
of both, so they meet in its list, and the longer lists need no merging. One edit leaves everything on
one side of an untouched gram as it was, so a list is split by all that stands before the gram, and
again by all that stands behind it. Pairs that meet are verified by their edit distance.

A list of over ``LONGEST_LIST`` words is not paired. Its words take an exact way beside the lists: they
meet on the word without one of its characters, as any two words one edit apart do, and are verified
alike. So no list makes more than ``LONGEST_LIST`` pairs per entry, and no word or pair is dropped.

The dictionary holds grams that occur more than ``total / CAPACITY`` times, at most ``CAPACITY`` for each
length, so its size is bounded whatever the vocabulary; it changes how long lists are, never which pairs
are found.

Defined results: null and empty texts have no words; a null id counts as the empty string in the rule
that deletes a character; repeated rows count as often as they occur; ties of forms go to the
smallest word in code-point order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.batches import pieces
from folioscope.session import stable

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_COUNT = 2
DELETE_ONE_IN = 31
RATIO = 10
LEAST_CHARS = 2
MOST_CHARS = 5
CAPACITY = 50_000
LONGEST_LIST = 512
SHORT = 64
BEGIN, END = "<", ">"
PRIME, BASE = (1 << 61) - 1, 0x9E3779B97F4A7  # of the hashes by which strings meet before they are verified


def vocabulary(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``(word, n)`` of all runs of letters, one in ``DELETE_ONE_IN`` of them without a character.

    Runs shorter than the least length cannot become words, so they are not even extracted.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"({LETTERS}{{{least_length},}})"), F.lit(1))
    found = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    ).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    drawn = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, h % length(run) + 2)"))
    word = F.when(F.col("h") % DELETE_ONE_IN == 0, shorter).otherwise(F.col("run"))
    return (
        drawn.select(word.alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.length("word") >= least_length) & (F.col("n") >= least_count))
    )


def gram_dictionary(words: DataFrame, capacity: int = CAPACITY) -> dict[str, int]:
    """Counts of the frequent grams over distinct words, at most ``capacity`` of each length."""
    # one array of characters per word, so that cutting grams is linear in its length
    chars = F.split(F.concat(F.lit(BEGIN), "word", F.lit(END)), "")

    def grams(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.size("chars") - size + 1)
        return F.transform(starts, lambda p: F.array_join(F.slice("chars", p, F.lit(size)), ""))

    sizes = range(LEAST_CHARS, MOST_CHARS + 1)
    held = [F.when(F.size("chars") >= s, grams(s)) for s in sizes]
    padded_words = words.select(chars.alias("chars"))
    total = padded_words.agg(F.sum(F.size("chars"))).first()[0] or 0
    counts = (
        padded_words.select(F.explode(F.flatten(F.array_compact(F.array(*held)))).alias("gram"))
        .groupBy("gram")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > total / capacity)
    )
    return {r["gram"]: r["n"] for r in counts.collect()}


def decompose(word: str, dictionary: dict[str, int]) -> list[tuple[int, int]]:
    """Start and end of the variable-length gram at each position of a padded word."""
    found = []
    for p in range(len(word) - LEAST_CHARS + 1):
        q = p + LEAST_CHARS
        while q < len(word) and q - p < MOST_CHARS and word[p:q] in dictionary:
            q += 1
        found.append((p, q))
    return found


def most_affected(grams: list[tuple[int, int]]) -> int:
    """Bound on the grams that one edit can affect: the most that hold one place.

    A gram that ends before the edit, or starts behind it, is the same in the edited word; an insertion
    affects the grams that hold both places beside it.
    """
    # grams start at 0, 1, 2, ...; those that hold place i start within MOST_CHARS before it
    return max(
        sum(q > i for _, q in grams[max(0, i - MOST_CHARS + 1) : i + 1]) for i in range(len(grams) + 1)
    )


def prefix_hashes(word: str) -> list[int]:
    """Polynomial hashes of the beginnings of a word, from the empty one to the whole."""
    return list(itertools.accumulate(word, lambda h, c: (h * BASE + ord(c)) % PRIME, initial=1))


def entries(word: str, dictionary: dict[str, int]) -> list[int]:
    """The lists of a word: two for each of its rarest grams, one more than an edit can affect.

    A list is named by a hash of all that precedes the end of the gram, or of all from its start on.
    """
    padded = BEGIN + word + END
    grams = decompose(padded, dictionary)
    ahead, behind = prefix_hashes(padded), prefix_hashes(padded[::-1])[::-1]
    rare = sorted(grams, key=lambda g: (dictionary.get(padded[g[0] : g[1]], 0), padded[g[0] : g[1]], g[0]))
    kept = rare[: most_affected(grams) + 1]
    return list(dict.fromkeys(m for p, q in kept for m in (2 * ahead[q], 2 * behind[p] + 1)))


def without_one(word: str) -> list[int]:
    """Hashes of a word and of what it becomes without one of its characters."""
    ahead, power, found = prefix_hashes(word), 1, {}
    whole = ahead[-1]
    for i in reversed(range(len(word))):
        # the beginning before i, followed by what stands behind i
        found[(whole + (ahead[i] - ahead[i + 1]) * power) % PRIME] = None
        power = power * BASE % PRIME
    return [whole, *found]


def _listed(words: DataFrame, lists) -> DataFrame:
    """``(id, key, size, short)``: a row for each hash that ``lists`` makes of a word.

    ``short`` is the word itself unless it is long, so that a long word is not copied into each row.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in pieces(batches, 4096):
            keys = pa.array([lists(w) for w in batch.column(1).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=["id", "word", "keys"])

    size = F.length("word")
    return (
        words.select("id", "word")
        .mapInArrow(run, "id bigint, word string, keys array<bigint>")
        .select("id", size.alias("size"), F.when(size <= SHORT, F.col("word")).alias("short"), "keys")
    )


def _meet(rows: DataFrame) -> DataFrame:
    """``(a, b, sure)`` of rows of one key; pairs of short words are verified as they meet."""
    a, b = rows.alias("a"), rows.alias("b")
    both = F.col("a.short").isNotNull() & F.col("b.short").isNotNull()
    verified = F.when(both, F.levenshtein("a.short", "b.short", 1) == 1).otherwise(True)
    near = (F.abs(F.col("a.size") - F.col("b.size")) <= 1) & verified
    return a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & near).select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b"), both.alias("sure")
    )


def near_pairs(words: DataFrame, capacity: int = CAPACITY, longest: int = LONGEST_LIST) -> DataFrame:
    """``(a, b)``: the ids of all pairs of distinct words one edit apart, each pair once, ``a < b``.

    ``words`` has one row per ``id`` and ``word`` and gives the same rows each time.
    """
    dictionary = gram_dictionary(words, capacity)
    sent = words.sparkSession.sparkContext.broadcast(dictionary)
    index = stable(_listed(words, lambda w: entries(w, sent.value)))
    lists = index.select("id", "size", "short", F.explode("keys").alias("key"))
    sizes = stable(lists.groupBy("key").count().filter("count > 1"))
    met = _meet(lists.join(sizes.filter(F.col("count") <= longest).select("key"), "key"))
    crowded = sizes.filter(F.col("count") > longest).select("key")
    aside = index.select("id", F.explode("keys").alias("key")).join(crowded, "key").select("id").distinct()
    rest = _listed(words.join(aside, "id"), without_one)
    beside = _meet(rest.select("id", "size", "short", F.explode("keys").alias("key")))
    pairs = stable(met.unionAll(beside).distinct())
    text = words.select("id", "word")
    long = (
        pairs.filter("NOT sure")
        .join(text.select(F.col("id").alias("a"), F.col("word").alias("word_a")), "a")
        .join(text.select(F.col("id").alias("b"), F.col("word").alias("word_b")), "b")
        .filter(F.levenshtein("word_a", "word_b", 1) == 1)
    )
    return pairs.filter("sure").select("a", "b").unionAll(long.select("a", "b"))


def variants(
    words: DataFrame, ratio: int = RATIO, capacity: int = CAPACITY, longest: int = LONGEST_LIST
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for ``words`` of ``(word, n)``.

    A form is at least ``ratio`` times as frequent as its word, so the way to the root has at most
    log(greatest n) steps to that base, and doubling follows it in the log of that many joins.
    """
    words = stable(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    pairs = stable(near_pairs(words, capacity, longest))
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("near")).unionAll(
        pairs.select(F.col("b").alias("id"), F.col("a").alias("near"))
    )
    other = words.select(F.col("id").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    # the smallest word of the largest count: the least of (-n, word)
    best = (
        both.join(other, "near")
        .groupBy("id")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near_word").alias("near"))).alias("best"),
        )
    )
    kept = -F.col("best.minus") >= ratio * F.col("n")
    forms = stable(
        words.join(best, "id", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(kept, F.col("best.near")).alias("form"),
            F.when(kept, -F.col("best.minus")).alias("form_n"),
        )
    )
    ways = stable(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    greatest = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(greatest, max(ratio, 2))))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = stable(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return forms.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
