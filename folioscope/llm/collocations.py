"""Phrase collocations: frequent word sequences by mergeable Misra-Gries summaries, then exact counts.

First pass. Every sequence of one to ``LONGEST`` words within a piece of text becomes a 64-bit code of its
language and words, and the codes are dealt to hash partitions. A task counts the codes of
a chunk of its texts and sends each partition one summary row. A partition merges its summaries under
the Misra-Gries rule: when more codes are held than its capacity, the (capacity + 1)-th largest count is
taken off all of them. What is taken off a code in total stays below mass / (capacity + 1); with a
capacity over mass / threshold that is less than the threshold, so a sequence that occurs ``threshold``
times is still held, and its count with all that was taken off reaches the threshold: such codes are
the survivors. Within a partition 32 bits of a code are enough: two sequences of one code only add up,
so a collision cannot lose one either.

The survivors mark a bit map, whose share belongs to the partition that the code falls to. Its size is
fixed by ``MAP_BITS``, whatever the corpus; it is collected and broadcast. If it fills up, more infrequent
sequences pass it and are counted in the second pass, with the same result.

Second pass. The sequences that the map lets through are counted by their words: per chunk in the task,
then by a shuffled sum. Those below the threshold fall out here, so the counts are exact.

Parts of a phrase are at least as frequent as the phrase, so their counts are among the survivors too.
The parts of all phrases are looked up in one join. Looked-up parts as frequent as "of the" would all
meet in one task, so counts of parts with many phrases are broadcast, at most ``MOST_HOT`` of them, and
only the others are shuffled.

Defined results: null and empty texts have no words; a null language counts as ``und``; repeated rows
count as often as they occur; an empty table gives no rows; other columns are not read. Counts are
exact up to 9 * 10^15, where the squares leave 38 decimal digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.batches import pieces
from folioscope.session import broadcast_if_small, stable

THRESHOLD = 10
LONGEST = 3
COVERED = 50  # percent of a candidate's occurrences inside one longer candidate that drop it
PER_LANG = 2_000
UNKNOWN = "und"
SCALE = 1_000_000

CHUNK = 2_000_000  # codes counted at a time
MASS_PER_PART = 8_000_000
MOST_PARTS = 1 << 20  # at 1 << 20 partitions the bit map has 16 bytes for each
MAP_BITS = 1 << 27
MOST_WORDS = 250_000  # words a task remembers between chunks
HOT_USES = 10_000
MOST_HOT = 50_000

# fixed signs of the contract: pieces end at .,;:!? and at line ends; words at blanks and tabs
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_BREAK = b"\xff"  # no byte of UTF-8
_TABLE = bytes.maketrans(
    bytes(range(65, 91)) + _ENDS, bytes(range(97, 123)) + b"\n" * len(_ENDS)
)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def _spread(codes: np.ndarray) -> np.ndarray:
    """Codes with every bit depending on all bits."""
    codes = (codes ^ (codes >> np.uint64(31))) * _MIX[1]
    return codes ^ (codes >> np.uint64(29))


class Words(dict):
    """Number of each word; the code of number ``i`` is ``codes()[i]``. Number 0 ends a piece."""

    def __init__(self):
        super().__init__({_BREAK: 0})
        self._codes = [0]

    def __missing__(self, word: bytes) -> int:
        import xxhash

        number = self[word] = len(self._codes)
        self._codes.append(xxhash.xxh3_64_intdigest(word))
        return number

    def codes(self) -> np.ndarray:
        return np.array(self._codes, np.uint64)


def tokens(text: str) -> list[bytes]:
    """Words of a text in UTF-8, with a sign where a piece ends."""
    return text.encode().translate(_TABLE).replace(b"\n", b" \xff ").split()


class Chunk:
    """Word numbers of some texts of a task, each language apart, with a sign after each text."""

    def __init__(self):
        self.words = Words()
        self.held: dict[str, list[int]] = {}
        self.size = 0

    def add(self, lang: str | None, text: str | None) -> None:
        if text:
            numbers = self.held.setdefault(UNKNOWN if lang is None else lang, [])
            before = len(numbers)
            numbers.extend(map(self.words.__getitem__, tokens(text)))
            numbers.append(0)
            self.size += len(numbers) - before

    def sequences(self, longest: int) -> Iterator[tuple[str, int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(lang, n, numbers, starts, codes)`` of all sequences of ``n`` words."""
        import xxhash

        known = self.words.codes()
        for lang, numbers in self.held.items():
            numbers = np.array(numbers, np.int64)
            starts = np.flatnonzero(numbers)
            codes = known[numbers[starts]] ^ np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), 1))
            yield lang, 1, numbers, starts, _spread(codes)
            for n in range(2, longest + 1):
                # a sequence goes on where its next place, always within the list, holds a word
                on = numbers[starts + n - 1] != 0
                starts, codes = starts[on], codes[on]
                codes = codes * _MIX[0] + known[numbers[starts + n - 1]]
                yield lang, n, numbers, starts, _spread(codes)

    def clear(self) -> None:
        if len(self.words) > MOST_WORDS:
            self.words = Words()
        self.held, self.size = {}, 0


def _chunks(batches: Iterator, size: int, longest: int) -> Iterator[Chunk]:
    chunk = Chunk()
    for batch in pieces(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            chunk.add(lang, text)
            if chunk.size * longest >= size:
                yield chunk
                chunk.clear()
    if chunk.size:
        yield chunk


def _totals(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, with the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first)


def part_of(codes: np.ndarray, parts: int) -> np.ndarray:
    """Partition of each code by its upper 32 bits; codes in order have partitions in order."""
    return ((codes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _summaries(parts: int, longest: int, size: int):
    """Rows ``(lang, text)`` to ``(part, codes, counts)``, one row per chunk and partition."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in _chunks(batches, size, longest):
            codes = np.concatenate([s[4] for s in chunk.sequences(longest)])
            codes.sort()
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            counts = np.diff(np.append(first, len(codes))).astype(np.uint32)
            codes = codes[first]
            owner = part_of(codes, parts)
            edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
            for at in range(0, len(edges) - 1, 64):
                some = list(zip(edges[at : at + 64], edges[at + 1 : at + 65]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([owner[i] for i, _ in some], pa.int32()),
                        pa.array([codes[i:j].astype(np.uint32).tobytes() for i, j in some], pa.binary()),
                        pa.array([counts[i:j].tobytes() for i, j in some], pa.binary()),
                    ],
                    names=["part", "codes", "counts"],
                )

    return run


def merge(summaries, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One Misra-Gries summary of at most ``capacity`` codes from several ``(codes, counts)``.

    The last value is what was taken off the counts. Summaries are taken together until they hold twice the
    capacity, so that work is linear in them.
    """
    codes, counts, taken = np.empty(0, np.uint32), np.empty(0, np.int64), 0
    waiting, size = [], 0

    def reduce() -> None:
        nonlocal codes, counts, taken, waiting, size
        codes, counts = _totals(
            np.concatenate([codes, *[c for c, _ in waiting]]),
            np.concatenate([counts, *[n.astype(np.int64) for _, n in waiting]]),
        )
        if len(codes) > capacity:
            place = len(counts) - capacity - 1
            off = int(np.partition(counts, place)[place])
            codes, counts, taken = codes[counts > off], counts[counts > off] - off, taken + off
        waiting, size = [], 0

    for more in summaries:
        waiting.append(more)
        size += len(more[0])
        if size > 2 * capacity:
            reduce()
    if waiting:
        reduce()
    return codes, counts, taken


def _survivors(parts: int, bits: int, threshold: int):
    """The summaries of a partition to its share of the bit map."""

    def run(table):
        import pyarrow as pa

        counts = [np.frombuffer(c.as_buffer(), np.uint32) for c in table["counts"]]
        codes = [np.frombuffer(c.as_buffer(), np.uint32) for c in table["codes"]]
        mass = sum(int(c.sum(dtype=np.int64)) for c in counts)
        held, sums, taken = merge(zip(codes, counts), mass // threshold + 1)
        at = held[sums + taken >= threshold] & np.uint32(bits - 1)
        share = np.zeros(bits // 8, np.uint8)
        mark = np.left_shift(1, (at & np.uint32(7)).astype(np.uint8), dtype=np.uint8)
        np.bitwise_or.at(share, at >> np.uint32(3), mark)
        return pa.table(
            {
                "part": table["part"].slice(0, 1),
                "share": pa.array([share.tobytes()], pa.binary()),
            }
        )

    return run


class BitMap:
    """Shares of all partitions; a code looks at one bit of its partition's share."""

    def __init__(self, owners: np.ndarray, shares, parts: int, bits: int):
        self.parts, self.bits = parts, bits
        rows = np.zeros((parts, bits // 8), np.uint8)
        for owner, share in zip(owners, shares):
            rows[owner] = np.frombuffer(share.as_buffer(), np.uint8)
        self.map = rows.reshape(-1)

    def holds(self, codes: np.ndarray) -> np.ndarray:
        at = codes & np.uint64(self.bits - 1)
        byte = part_of(codes, self.parts) * np.uint64(self.bits // 8) + (at >> np.uint64(3))
        return (self.map[byte.astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counted(sent, longest: int, size: int):
    """Rows ``(lang, text)`` to ``(lang, phrase, words, f)`` of sequences in the map, counted per chunk.

    The row without a phrase holds the number of words of a language.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = sent.value
        for chunk in _chunks(batches, size, longest):
            names = None
            for lang, n, numbers, starts, codes in chunk.sequences(longest):
                if names is None:
                    names = list(chunk.words)
                phrases, sums = [], np.empty(0, np.int64)
                if n == 1:
                    phrases, sums = [""], np.array([len(starts)])
                inside = known.holds(codes)
                starts, codes = starts[inside], codes[inside]
                if len(codes):
                    _, first, counts = np.unique(codes, return_index=True, return_counts=True)
                    at = numbers[starts[first][:, None] + np.arange(n)].tolist()
                    phrases = phrases + [b" ".join([names[i] for i in row]).decode() for row in at]
                    sums = np.concatenate([sums, counts])
                for lo in range(0, len(phrases), 50_000):
                    some = phrases[lo : lo + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(some), pa.string()),
                            pa.array(some, pa.string()),
                            pa.array([n if p else 0 for p in some], pa.int32()),
                            pa.array(sums[lo : lo + 50_000], pa.int64()),
                        ],
                        names=["lang", "phrase", "words", "f"],
                    )

    return run


def frequent(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    mass_per_part: int = MASS_PER_PART,
    map_bits: int = MAP_BITS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(lang, phrase, words, f)``: exact counts of all sequences of at least ``threshold``.

    Rows with ``words`` 0 have the number of words of each language.
    """
    read = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    # a word and what parts it from the next take two bytes at least
    most_words = (read.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // 2 + 1
    parts = min(max(1, -(-most_words * longest // mass_per_part)), MOST_PARTS)
    bits = min(1 << 32, max(8, 1 << max(0, (map_bits // parts).bit_length() - 1)))
    shares = (
        read.mapInArrow(_summaries(parts, longest, chunk), "part int, codes binary, counts binary")
        .groupBy("part")
        .applyInArrow(_survivors(parts, bits, threshold), "part int, share binary")
        .toArrow()
    )
    sent = read.sparkSession.sparkContext.broadcast(
        BitMap(shares["part"].to_numpy(), shares["share"], parts, bits)
    )
    return (
        read.mapInArrow(_counted(sent, longest, chunk), "lang string, phrase string, words int, f bigint")
        .groupBy("lang", "phrase", "words")
        .agg(F.sum("f").alias("f"))
        .filter((F.col("f") >= threshold) | (F.col("words") == 0))
    )


def look_up(wanted: DataFrame, held: DataFrame, hot_uses: int = HOT_USES) -> DataFrame:
    """``wanted`` with ``f`` of its ``(lang, part)``; parts wanted often are broadcast.

    At most ``MOST_HOT`` parts are looked up that way, those wanted most; each other part is
    wanted by fewer rows than the last of them, or by fewer than ``hot_uses``.
    """
    uses = wanted.groupBy("lang", "part").count().filter(F.col("count") >= hot_uses)
    hot = broadcast_if_small(
        uses.orderBy(F.desc("count"), "lang", "part")
        .limit(MOST_HOT)
        .select("lang", "part")
        .join(held, ["lang", "part"])
        .withColumnRenamed("f", "hot_f")
    )
    tagged = wanted.join(hot, ["lang", "part"], "left")
    often = tagged.filter("hot_f IS NOT NULL").withColumnRenamed("hot_f", "f")
    seldom = tagged.filter("hot_f IS NULL").drop("hot_f").join(held, ["lang", "part"])
    return often.unionByName(seldom)


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """``floor(SCALE * a * a / (left * right))`` in decimals; ``a`` is at most either part."""

    def wide(c: Column, digits: int) -> Column:
        return c.cast(f"decimal({digits},0)")

    above = (wide(a, 16) * wide(a, 16)).cast("decimal(32,0)") * F.lit(SCALE).cast("decimal(7,0)")
    below = (wide(left, 18) * wide(right, 18)).cast("decimal(38,0)")
    return F.call_function("div", above.cast("decimal(38,0)"), below).cast("long")


def scored(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Candidates ``(lang, phrase, words, a, l, r, score)`` with their lowest-scoring cut."""
    phrases = counts.filter("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    parts = F.split("phrase", " ")
    cuts = phrases.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), parts.alias("w")
    )
    first = F.concat_ws(" ", F.slice("w", 1, F.col("k")))
    rest = F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")))
    sides = cuts.select(
        "lang",
        "phrase",
        "words",
        "a",
        "k",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("is_left"), first.alias("part")),
                F.struct(F.lit(False).alias("is_left"), rest.alias("part")),
            )
        ).alias("side"),
    ).select("lang", "phrase", "words", "a", "k", "side.is_left", "side.part")
    held = counts.filter(F.col("words").between(1, longest - 1)).select(
        "lang", F.col("phrase").alias("part"), "f"
    )
    found = (
        look_up(sides, held)
        .groupBy("lang", "phrase", "words", "a")
        .agg(*[
            F.max(F.when((F.col("k") == k) & (F.col("is_left") == left), F.col("f"))).alias(f"{name}{k}")
            for k in range(1, longest)
            for name, left in (("l", True), ("r", False))
        ])
    )
    cut = F.array_min(
        F.filter(
            F.array(*[
                F.struct(
                    exact_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"),
                    F.lit(k).alias("k"),
                    F.col(f"l{k}").alias("l"),
                    F.col(f"r{k}").alias("r"),
                )
                for k in range(1, longest)
            ]),
            lambda c: c["score"].isNotNull(),
        )
    )
    return found.select("lang", "phrase", "words", "a", cut.alias("cut")).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"
    )


def covered(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``(lang, phrase, longer_f)``: the largest count of a longer candidate around each phrase."""
    longer = counts.filter("words >= 3").select("lang", "words", "f", F.split("phrase", " ").alias("w"))

    def inner(n: int) -> Column:
        places = F.sequence(F.lit(1), F.col("words") - n + 1)
        held = F.transform(places, lambda at: F.concat_ws(" ", F.slice("w", at, F.lit(n))))
        return F.when(F.col("words") > n, held)

    lists = F.flatten(F.array_compact(F.array(*map(inner, range(2, longest)))))
    return (
        longer.select("lang", F.explode(lists).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer_f"))
    )


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    per_lang: int = PER_LANG,
    threshold: int = THRESHOLD,
    **sizes: int,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of each language."""
    counts = stable(frequent(docs, text, lang, threshold, LONGEST, **sizes))
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    longer = covered(counts)
    kept = (
        scored(counts)
        .join(longer, ["lang", "phrase"], "left")
        .filter(100 * F.coalesce("longer_f", F.lit(0)) < COVERED * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(
        F.col("rank") <= per_lang
    )
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
