"""Document fingerprints by consistent weighted sampling, and likeness to edited and next texts.

A text is a bag of words weighted by how often each occurs. For each of ``SAMPLES`` positions every
term draws two gamma variables and a uniform one that depend on the term and the position only;
the term of least value, with the step its weight falls on, is the sample. Two texts share a sample
with the chance of their generalised Jaccard similarity (sum of the smaller weights over sum of the
larger), so the share of equal positions estimates it. The variables are drawn from a 64-bit hash of the
term and the position, so terms share none. A worker keeps those of up to ``MEMO_TERMS`` terms; when it is
full the terms that texts used least make room. A term drawn again gets the same values.

The next document needs an order over all documents without a single task: ids are cut at quantiles
into buckets of about equal size, at most ``MOST_BUCKETS``, and the first row of each bucket is sent
to the bucket before it as a guest. Texts are shuffled once.

Defined results: a null text is empty; an empty text, or one of white space, has the empty
fingerprint, like only itself; the document after the last is the first, and a lone one is its own
next; rows with a null id come first, repeated ids follow the order of their texts and stay in one
bucket; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.batches import pieces

SAMPLES = 128
SEED = 20_240_229
BUCKET_ROWS = 1024
MOST_BUCKETS = 1 << 16
MEMO_TERMS = 1 << 16
KEPT_TERMS = 1 << 14  # the most used ones, which stay when the memo is full
TERMS_AT_ONCE = 4096
DRAWN_AT_ONCE = 512
ROWS_AT_ONCE = 64


class Sampler:
    """The random variables of every term and position, and a bounded memo of them."""

    def __init__(self, samples: int = SAMPLES, memo: int = MEMO_TERMS, seed: int = SEED):
        import numpy as np

        draw = np.random.Generator(np.random.PCG64(seed))
        self.keys = draw.integers(0, 1 << 64, (2, samples), dtype=np.uint64)
        # r, the logarithm of c, and beta of the terms kept, and their values at weight one
        self.table = [np.empty((memo, samples), dtype=np.float32) for _ in range(4)]
        self.hashes = np.empty(memo, dtype=np.uint64)
        self.used = np.zeros(memo, dtype=np.int32)
        self.samples, self.room = samples, memo
        self.memo: dict[str, int] = {}

    def variables(self, hashes):
        """r, log c, beta and the values at weight one (where the step is zero) of hashed terms."""
        import numpy as np

        mixed = []
        for key in self.keys:
            x = hashes[:, None] ^ key
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x ^= x >> np.uint64(shift)
                x *= np.uint64(factor)
            x ^= x >> np.uint64(31)
            mixed.append(x)

        def uniform(x, shift: int):
            # 23 bits and a half stand exactly in single precision, so no value is 0 or 1
            bits = (x >> np.uint64(shift)).astype(np.uint32) & np.uint32((1 << 23) - 1)
            return (bits.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-23)

        u = [uniform(x, shift) for x in mixed for shift in (41, 18)]
        # a gamma variable of shape two is the sum of two exponential ones
        r = -np.log(u[0] * u[1])
        log_c = np.log(-np.log(u[2] * u[3]))
        low = mixed[0].astype(np.uint32) & np.uint32(0xFFFF)
        beta = (low << np.uint32(7) | mixed[1].astype(np.uint32) & np.uint32(0x7F)).astype(np.float32)
        beta *= np.float32(2.0**-23)
        return r, log_c, beta, log_c + r * (beta - 1)

    def _keep(self, words: list[str], hashes) -> None:
        start = len(self.memo)
        for at in range(0, len(words), DRAWN_AT_ONCE):
            part = slice(at, at + DRAWN_AT_ONCE)
            n = len(hashes[part])
            for table, found in zip(self.table, self.variables(hashes[part])):
                table[start + at : start + at + n] = found
            self.hashes[start + at : start + at + n] = hashes[part]
        self.memo.update(zip(words, range(start, start + len(words))))

    def _make_room(self) -> None:
        """Move the most used terms to the front and forget the others; older uses count half."""
        import numpy as np

        words = list(self.memo)
        kept = np.argsort(-self.used[: len(words)], kind="stable")[: min(KEPT_TERMS, self.room // 4)]
        for table in self.table:
            table[: len(kept)] = table[kept]
        self.hashes[: len(kept)] = self.hashes[kept]
        self.used[: len(kept)] = self.used[kept] // 2
        self.used[len(kept) :] = 0
        self.memo = {words[i]: at for at, i in enumerate(kept.tolist())}

    def learn(self, bags: list[Counter]) -> None:
        """Draw for the terms of several texts at once, each term once; those beyond the room wait."""
        import numpy as np
        import xxhash

        words = set().union(*bags)
        new = [w for w in words if w not in self.memo]
        if len(self.memo) + len(new) > self.room:
            self._make_room()
            new = [w for w in words if w not in self.memo]
        new = [w for w in new if len(w) < 64][: self.room - len(self.memo)]
        if new:
            digest = xxhash.xxh64_intdigest
            hashes = [digest(w.encode("utf-8", "surrogatepass")) for w in new]
            self._keep(new, np.array(hashes, dtype=np.uint64))

    def bag(self, counts: Counter):
        """Kept rows and their weights, and hashes and weights of the other terms of a text."""
        import numpy as np
        import xxhash

        rows = list(map(self.memo.get, counts))
        if None in rows and len(self.memo) + rows.count(None) > self.room:
            self._make_room()
            rows = list(map(self.memo.get, counts))
        others: list[str] = []
        if None in rows:
            new = [w for w, row in zip(counts, rows) if row is None]
            short = [w for w in new if len(w) < 64][: self.room - len(self.memo)]
            hashes = {w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in new}
            if short:
                self._keep(short, np.array([hashes[w] for w in short], dtype=np.uint64))
            others = [w for w in new if w not in self.memo]
            rows = list(map(self.memo.get, counts))
        weights = np.fromiter(counts.values(), np.int64, len(counts))
        if others:
            held = np.array([row is not None for row in rows])
            weights = weights[held]
            rows = [row for row in rows if row is not None]
        rows = np.array(rows, dtype=np.int64)
        self.used[rows] += 1
        rest = np.array([hashes[w] for w in others], dtype=np.uint64) if others else None
        return rows, weights, rest, np.array([counts[w] for w in others], dtype=np.int64)

    def sample(self, text: str):
        """One 16-bit number per position; None for a text without words."""
        return self.sample_bag(Counter(text.split()))

    def sample_bag(self, counts: Counter):
        import numpy as np

        rows, weights, rest, rest_weights = self.bag(counts)
        if not len(rows) and rest is None:
            return None
        best = np.full(self.samples, np.inf, dtype=np.float32)
        term = np.zeros(self.samples, dtype=np.uint64)
        step = np.zeros(self.samples, dtype=np.int64)
        positions = np.arange(self.samples)

        def lowest(values, hashes, steps=None) -> None:
            least = values.argmin(axis=0)
            lower = (found := values[least, positions]) < best
            best[lower], term[lower] = found[lower], hashes[least[lower]]
            step[lower] = 0 if steps is None else steps[least[lower], positions[lower]].astype(np.int64)

        def weighted(r, log_c, beta, counts, hashes) -> None:
            steps = np.floor(np.log(counts).astype(np.float32)[:, None] / r + beta)
            lowest(log_c - r * (steps - beta + 1), hashes, steps)

        r, log_c, beta, single = self.table
        ones, more = rows[weights == 1], rows[weights > 1]
        for at in range(0, len(ones), TERMS_AT_ONCE):
            part = ones[at : at + TERMS_AT_ONCE]
            lowest(np.take(single, part, axis=0, mode="clip"), self.hashes[part])
        counts = weights[weights > 1]
        for at in range(0, len(more), TERMS_AT_ONCE):
            part = more[at : at + TERMS_AT_ONCE]
            drawn = (np.take(table, part, axis=0, mode="clip") for table in (r, log_c, beta))
            weighted(*drawn, counts[at : at + TERMS_AT_ONCE], self.hashes[part])
        for at in range(0, 0 if rest is None else len(rest), TERMS_AT_ONCE):
            part = rest[at : at + TERMS_AT_ONCE]
            weighted(*self.variables(part)[:3], rest_weights[at : at + TERMS_AT_ONCE], part)
        mixed = (term * np.uint64(0x9E3779B97F4A7C15)) ^ (
            step.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        )
        return (mixed >> np.uint64(40)).astype(">u2")


def likeness(a, b) -> float:
    """Share of equal samples; empty texts are like each other only."""
    if a is None or b is None:
        return float(a is None and b is None)
    return float((a == b).mean())


def as_text(samples) -> str:
    return "" if samples is None else samples.tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``key``, by bisection inside the row; 0 for a null."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    size = 1 << (len(bounds).bit_length() - 1)
    steps = []
    while size:
        steps.append(size)
        size //= 2
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(table, at + step - 1) <= key, at + step).otherwise(at),
    )


def _with_next(docs: DataFrame, key: str, text: str, bucket_rows: int) -> DataFrame:
    """``(bucket, guest, id, text)`` dealt by bucket and sorted, guests last in theirs."""
    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = narrow.count()
    buckets = min(MOST_BUCKETS, -(-rows // bucket_rows))
    bounds = []
    if buckets > 1:
        cuts = [i / buckets for i in range(1, buckets)]
        found = narrow.select("id").approxQuantile("id", cuts, 0.25 / buckets)
        bounds = sorted({int(x) for x in found})
    placed = narrow.withColumn("bucket", _bucket(F.col("id"), bounds))
    # one row per bucket, at most MOST_BUCKETS of them
    firsts = {
        r["bucket"]: r["first"]["id"]
        for r in placed.groupBy("bucket").agg(F.min(F.struct("id")).alias("first")).collect()
    }
    order = sorted(firsts)
    before = {b: order[i - 1] for i, b in enumerate(order)}

    def lookup(values: dict) -> Column:
        listed = ",".join(str(values.get(b, "")) for b in range(len(bounds) + 1))
        found = F.get(F.split(F.lit(listed.replace("None", "")), ","), F.col("bucket"))
        return F.when(found != "", found).cast("bigint")

    is_first = F.col("id").eqNullSafe(lookup(firsts))
    home = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(lookup(before).cast("int").alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(is_first, F.array(home, visit)).otherwise(F.array(home))
    return (
        placed.select(F.explode(places).alias("place"), "id", "text")
        .select("place.bucket", "place.guest", "id", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "guest", F.col("id").asc_nulls_first(), "text")
    )


def fingerprints(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    samples: int = SAMPLES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per row the fingerprints of its text and edited text, and the likeness to both neighbours."""
    sent = docs.sparkSession.sparkContext.broadcast({"samples": samples})

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        held = sent.value  # the tables stay beside the broadcast value of the worker process
        if "sampler" not in held:
            held["sampler"] = Sampler(held["samples"])
        sampler = held["sampler"]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()

        def measures(one: tuple, following: tuple, changed: str, changed_print) -> tuple:
            _, doc_id, value, print_ = one
            return (
                doc_id,
                len(value),
                hashlib.sha256(changed.encode()).hexdigest(),
                as_text(print_),
                as_text(changed_print),
                likeness(print_, changed_print),
                likeness(print_, following[3]),
            )

        waiting = None
        for batch in pieces(batches, ROWS_AT_ONCE):
            listed = [
                (bucket, guest, doc_id, value or "")
                for bucket, guest, doc_id, value in zip(*(c.to_pylist() for c in batch.columns))
            ]
            bags = [Counter(value.split()) for *_, value in listed]
            sampler.learn(bags)
            pairs = []
            for (bucket, guest, doc_id, value), bag in zip(listed, bags):
                if waiting is None and guest:
                    continue  # the bucket has met its guest
                row = (bucket, doc_id, value, sampler.sample_bag(bag))
                if waiting is not None:
                    pairs.append((waiting, row, edited(waiting[2], value)))
                waiting = None if guest else row
            # an edit cuts words in two, so edited texts bring terms of their own
            bags = [Counter(changed.split()) for *_, changed in pairs]
            sampler.learn(bags)
            rows = [
                measures(one, following, changed, sampler.sample_bag(bag))
                for (one, following, changed), bag in zip(pairs, bags)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )

    return _with_next(docs, key, text, bucket_rows).mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
