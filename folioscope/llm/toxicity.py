"""Toxicity by maximum-scoring segments over token log-odds.

A model is fitted on a bounded sample of labelled texts: the document counts of tokens in both
classes give log-odds under a Dirichlet prior. The prior of a token is the rate of its first letters,
so a token never seen inherits what tokens with the same beginning showed. Tokens without evidence
score a small constant below zero. A linear scan then finds every maximal segment of positive score
in a text; segments are judged by extreme-value statistics (the chance that a clean text of this
length holds segments that good), and a logistic curve turns that chance into a probability.

Evidence is kept honest at any number of labels. Equal texts count once. A token enters the lexicon
only if its evidence passes a bar that rises with the number of tokens tried, if it leans at least
``LEAST_SCORE`` either way, and if two halves of the sample show it each on its own. Which half a text
belongs to is decided by its least shingle, so near copies fall into the same half and cannot vouch
for each other. The tail of chance segments and the curve are fitted on a further part of the sample,
which the lexicon has not seen.

Bounds: ``sample_rows`` labelled rows per class and ``lexicon_size`` tokens; both are model sizes,
every text is scanned whole. Labels of one document that disagree count as toxic; null labels do not
count. Where the further part lacks a class, the curve is fitted on the whole sample.

Defined results: a null or empty text, and one without letters, has no segment and gets the score of
a text without evidence; without any labelled text of both classes every score is 0; repeated rows
are scored alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.batches import pieces
from folioscope.session import stable

SAMPLE_ROWS = 20_000
LEXICON_SIZE = 20_000
STEMS = (8, 7, 6, 5, 4)
LEAST_STEM_SCORE = 2.0
LEAST_SCORE = 1.5
PRIOR_DOCS = 4.0
FALSE_TOKENS = 0.05  # expected number of tokens that pass the bar by chance
LEAST_HALF_Z = 2.0
MOST_TRIED = 200
SHINGLE = 3
PARTS = 5  # of the sample: two for each half of the evidence, the last for the curve
REST = -0.25
MOST_SURPRISE = 40.0
MEMO_SIZE = 100_000
COUNTS_AT_ONCE = 60_000
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning; a null id is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def tokens(text: str | None) -> list[str]:
    """Runs of letters, lower-cased, so that signs set around a word hide nothing."""
    return re.findall(r"[^\W\d_]+", (text or "").lower())


@dataclass
class Model:
    words: dict = field(default_factory=dict)
    stems: dict = field(default_factory=dict)
    rate: float = 1.0  # decay of the extreme-value tail per unit of score
    volume: float = 1.0  # expected chance segments per token at score zero
    slope: float = 0.0
    offset: float = -50.0

    def word_score(self, word: str) -> float:
        if word in self.words:
            return self.words[word]
        for size in STEMS:
            if len(word) > size and word[:size] in self.stems:
                return self.stems[word[:size]]
        return REST


class Memo(dict):
    """Scores of the words met so far; stops growing at a fixed size."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        score = self.model.word_score(word)
        if len(self) < MEMO_SIZE:
            self[word] = score
        return score


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` of a list, in one pass.

    Kept candidates have rising totals before them; a new positive item is merged leftwards as long
    as a candidate exists that starts lower and ends lower than the new one.
    """
    before: list[float] = []
    after: list[float] = []
    starts: list[int] = []
    ends: list[int] = []
    lower: list[int] = []  # for each candidate the nearest one on its left that starts lower
    total = 0.0
    for at, score in enumerate(scores):
        left, total = total, total + score
        if score <= 0:
            continue
        start = at
        while True:
            j = len(before) - 1
            while j >= 0 and before[j] >= left:
                j = lower[j]
            if j < 0 or after[j] >= total:
                break
            start, left = starts[j], before[j]
            del before[j:], after[j:], starts[j:], ends[j:], lower[j:]
        before.append(left)
        after.append(total)
        starts.append(start)
        ends.append(at + 1)
        lower.append(j)
    return [(s, e, a - b) for s, e, a, b in zip(starts, ends, after, before)]


def surprise(segments: list[tuple[int, int, float]], n_tokens: int, model: Model) -> float:
    """Minus the log of the chance of the best ``r`` segments together, for the best ``r``.

    Normalised scores ``t`` of chance segments follow an extreme-value law; the sum of the best
    ``r`` has the tail ``exp(-t) t^(r-1) / (r! (r-1)!)``. Halving for each further ``r`` pays for
    having looked at several.
    """
    best = total = 0.0
    base = math.log(max(model.volume * max(n_tokens, 1), 1e-12))
    for r, score in enumerate(sorted((s[2] for s in segments), reverse=True), start=1):
        total += model.rate * score - base
        if total <= 0:
            break
        value = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r)
        best = max(best, value - r * math.log(2))
    return best


def evidence(text: str | None, memo: Memo) -> tuple[list[tuple[int, int, float]], int]:
    words = tokens(text)
    scores = list(map(memo.__getitem__, words))
    if not scores or max(scores) <= 0:
        return [], len(words)
    return maximal_segments(scores), len(words)


def probability(segments, n_tokens: int, model: Model) -> float:
    x = min(surprise(segments, n_tokens, model), MOST_SURPRISE)
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, model.offset + model.slope * x))))


def labelled_sample(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled keys of each class outside the held-out fold, by a hash order."""
    known = (
        labels.filter(F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(F.when(F.col(label) == 1, 1).otherwise(0)).alias("y"))
    )
    halves = [
        known.filter(F.col("y") == y).orderBy(F.xxhash64("id", F.lit(11)), "id").limit(rows)
        for y in (0, 1)
    ]
    return halves[0].unionAll(halves[1])


def part_of(words: list[str]) -> int:
    """Which part of the sample a text belongs to: near copies mostly share their least shingle."""
    shingles = range(max(1, len(words) - SHINGLE + 1))
    least = min(zlib.crc32(" ".join(words[i : i + SHINGLE]).encode("utf-8", "replace")) for i in shingles)
    # the least of many hashes is small, so the part is taken from another hash of it
    return zlib.crc32(str(least).encode()) % PARTS


COUNTS = [f"{half}{y}" for half in "ab" for y in (0, 1)]


def _count_tokens(batches: Iterator) -> Iterator:
    """Document counts of words and of stems per half and class, added up before they leave the task."""
    import pyarrow as pa

    def out(counts: dict) -> pa.RecordBatch:
        columns = list(zip(*[(*name, *row) for name, row in counts.items()]))
        kinds = [pa.bool_(), pa.string(), *[pa.int64()] * len(COUNTS)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["stem", "name", *COUNTS]
        )

    counts: dict = {}
    for batch in pieces(batches):
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            listed = tokens(text)
            half = part_of(listed) // 2
            if half > 1:
                continue
            words = set(listed)
            stems = {w[:size] for w in words for size in STEMS if len(w) > size}
            for name in [(False, w) for w in words] + [(True, s) for s in stems] + [(True, "")]:
                counts.setdefault(name, [0] * len(COUNTS))[2 * half + y] += 1
            if len(counts) > COUNTS_AT_ONCE:
                yield out(counts)
                counts = {}
    if counts:
        yield out(counts)


def _log_odds(n0: Column, n1: Column, total0: float, total1: float) -> Column:
    """Log-odds of two document counts; the prior of a token follows its share of all texts."""
    prior = PRIOR_DOCS * (n0 + n1) / (total0 + total1) + 0.5
    odds1 = (n1 + prior) / (total1 + 2 * prior)
    odds0 = (n0 + prior) / (total0 + 2 * prior)
    return F.log(odds1 / odds0)


def _evidence(n0: Column, n1: Column, total0: float, total1: float) -> Column:
    """Signed root of the likelihood-ratio statistic, about normal for a token without leaning."""
    share = total1 / (total0 + total1)
    n = n0 + n1

    def part(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    g = 2 * (part(n1, n * share) + part(n0, n * (1 - share)))
    return F.sqrt(F.greatest(g, F.lit(0.0))) * F.signum(n1 - n * share)


def evidence_bar(tried: int) -> float:
    """A bar that at most ``FALSE_TOKENS`` of so many standard normal values are expected to pass."""
    return math.sqrt(2 * math.log(max(tried, 1) / FALSE_TOKENS))


def testable(counts: dict[int, int], share: float) -> tuple[int, float]:
    """The least number of texts a token needs to be tried, and the bar for the tokens tried.

    A token of ``n`` texts that are all toxic, ``share`` of all texts being so, has the most evidence
    ``n`` texts can give. Tokens too rare to pass the bar that way are not tried, so they do not raise it.
    ``counts`` says how many tokens stand in how many texts.
    """
    for n in range(1, max(counts, default=0) + 1):
        bar = evidence_bar(sum(c for k, c in counts.items() if k >= n))
        if math.sqrt(-2 * n * math.log(share)) >= bar:
            return n, bar
    return 1, evidence_bar(sum(counts.values()))


def _lexicon(sample: DataFrame, size: int) -> tuple[dict, dict]:
    """Scores of words and of stems with evidence in both halves of the sample."""
    counts = stable(
        sample.select("text", "y")
        .mapInArrow(_count_tokens, "stem boolean, name string, " + ", ".join(f"{c} bigint" for c in COUNTS))
        .groupBy("stem", "name")
        .agg(*[F.sum(c).cast("double").alias(c) for c in COUNTS])
    )
    # the empty stem stands in every text
    total = counts.filter("stem AND name = ''").first()
    if total is None or not all(total[c] for c in COUNTS):
        return {}, {}
    tried = counts.filter("name <> ''")
    n = {c: F.col(c) for c in COUNTS}
    texts = n["a0"] + n["a1"] + n["b0"] + n["b1"]
    toxic = total["a1"] + total["b1"]
    bars = {}
    for stem in (False, True):
        # at most MOST_TRIED rows
        held = tried.filter(F.col("stem") == stem).groupBy(F.least(texts, F.lit(MOST_TRIED)).alias("n"))
        sizes = {int(r["n"]): r["count"] for r in held.count().collect()}
        bars[stem] = testable(sizes, toxic / (toxic + total["a0"] + total["b0"]))

    def by_kind(i: int) -> Column:
        return F.when(F.col("stem"), bars[True][i]).otherwise(bars[False][i])
    both = [n["a0"] + n["b0"], n["a1"] + n["b1"], total["a0"] + total["b0"], total["a1"] + total["b1"]]
    halves = [_evidence(n[f"{h}0"], n[f"{h}1"], total[f"{h}0"], total[f"{h}1"]) for h in "ab"]
    z, score = F.col("z"), F.col("score")
    least = F.when(F.col("stem"), LEAST_STEM_SCORE).otherwise(LEAST_SCORE)
    ranked = tried.filter(texts >= by_kind(0)).select(
        "stem",
        "name",
        _log_odds(*both).alias("score"),
        _evidence(*both).alias("z"),
        F.least(*[h * F.signum(_evidence(*both)) for h in halves]).alias("half_z"),
    ).filter((F.abs(z) >= by_kind(1)) & (F.col("half_z") >= LEAST_HALF_Z) & (F.abs(score) >= least))
    words, stems = {}, {}
    # the strongest on either side; the order ends in the name, so that ties are settled
    for positive in (True, False):
        side = ranked.filter(z > 0 if positive else z < 0)
        top = side.orderBy(F.abs("z").desc(), "name", "stem").limit(size // 2)
        for row in top.collect():
            (stems if row["stem"] else words)[row["name"]] = row["score"]
    return words, stems


def _measure(model: Model, cut: float):
    """Rows ``(text, y)`` to ``(y, unseen by the lexicon, tokens, segments over the cut, surprise)``."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        memo = Memo(model)
        for batch in pieces(batches):
            rows = []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                segments, n = evidence(text, memo)
                over = sum(s[2] >= cut for s in segments)
                unseen = part_of(tokens(text)) == PARTS - 1
                rows.append((y, unseen, n, over, surprise(segments, n, model)))
            if rows:
                kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["y", "unseen", "n", "over", "x"],
                )

    return run


def _logistic(rows: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Slope and offset of a ridge logistic curve through weighted ``(x, y, weight)``.

    Newton steps, halved until they lower the loss, so that the fit never leaves the data; the slope
    of a surprise is never below zero.
    """
    ridge = 1e-3

    def loss(slope: float, offset: float) -> float:
        total = ridge * (slope * slope + offset * offset) / 2
        for x, y, w in rows:
            m = (offset + slope * x) * (1 - 2 * y)
            total += w * (max(m, 0.0) + math.log1p(math.exp(-abs(m))))
        return total

    slope, offset = 0.0, 0.0
    now = loss(slope, offset)
    for _ in range(100):
        g = [ridge * slope, ridge * offset]
        h = [ridge, 0.0, ridge]
        for x, y, w in rows:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, offset + slope * x))))
            d, v = w * (p - y), w * p * (1 - p)
            g[0] += d * x
            g[1] += d
            h[0] += v * x * x
            h[1] += v * x
            h[2] += v
        det = h[0] * h[2] - h[1] * h[1]
        step = ((h[2] * g[0] - h[1] * g[1]) / det, (h[0] * g[1] - h[1] * g[0]) / det)
        size = 1.0
        while (then := loss(slope - size * step[0], offset - size * step[1])) > now and size > 1e-9:
            size /= 2
        if then > now - 1e-10 * abs(now):
            break
        slope, offset, now = slope - size * step[0], offset - size * step[1], then
    return max(slope, 0.0), offset


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    lexicon_size: int = LEXICON_SIZE,
) -> Model:
    """Fit on the distinct texts of at most ``sample_rows`` labelled rows of each class.

    The sampled keys are at most ``2 * sample_rows`` numbers, so they are broadcast.
    """
    picked = labelled_sample(labels, key, label, sample_rows)
    sample = stable(
        docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(picked), "id")
        .groupBy("y", F.xxhash64("text").alias("same"))
        .agg(F.max("text").alias("text"))
        .select("text", "y")
    )
    words, stems = _lexicon(sample, lexicon_size)
    model = Model(words, stems)
    if not words and not stems:
        return model
    # Tail of chance segments in clean texts: the decay is one, as scores are log-odds of the two
    # classes; the volume is fitted to how many segments over a cut clean texts really hold.
    cut = 2.0
    shape = "y int, unseen boolean, n bigint, over bigint, x double"
    clean = (
        sample.mapInArrow(_measure(model, cut), shape)
        .filter("y = 0")
        .groupBy("unseen")
        .agg(F.sum("over").alias("over"), F.sum("n").alias("n"))
        .collect()
    )
    tail = next((r for r in clean if r["unseen"]), clean[0])
    model.volume = ((tail["over"] or 0) + 0.5) / ((tail["n"] or 0) + 1.0) * math.exp(cut)
    # classes were sampled on their own, so each text weighs as its class does among all labels
    shares = dict(
        labels.filter(F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.when(F.col(label) == 1, 1).otherwise(0).alias("y"))
        .count()
        .collect()
    )
    points = (
        sample.mapInArrow(_measure(model, cut), shape)
        .groupBy("y", "unseen", F.round(F.least("x", F.lit(MOST_SURPRISE)), 1).alias("x"))
        .count()
        .collect()
    )
    unseen = [p for p in points if p["unseen"]]
    if {p["y"] for p in unseen} == {0, 1}:
        points = unseen
    held = {y: sum(p["count"] for p in points if p["y"] == y) for y in (0, 1)}
    weight = {y: shares.get(y, held[y]) / held[y] for y in (0, 1)}
    model.slope, model.offset = _logistic(
        [(p["x"], p["y"], p["count"] * weight[p["y"]]) for p in points]
    )
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``tox_score`` and ``tox_segments``: start and end in tokens, and score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = sent.value
        memo = Memo(known)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in pieces(batches):
            scores, segments = [], []
            for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
                found, n = evidence(value, memo)
                scores.append(probability(found, n, known))
                segments.append([{"start": s, "end": e, "score": v} for s, e, v in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(segments, kind)],
                names=[*batch.schema.names, "tox_score", "tox_segments"],
            )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(
        run,
        f"{columns}, tox_score double, "
        "tox_segments array<struct<start: bigint, end: bigint, score: double>>",
    )

