"""Language of code-switched texts by a linear-chain conditional random field over words.

A word's features are itself (the lexicon), its affixes and its letter trigrams, hashed to
``FEATURES`` numbers; transitions between languages are learned with them. Training uses a bounded
sample of labelled documents, about ``SAMPLE_DOCS`` of each language. Labels name whole documents, so
the words of a training document are first labelled by lexicon odds over a window, with a preference
for the document's own language: passages in another language get that language, and the field learns
how rarely it changes. Gradients are computed where the sample lies and added up on the driver, one
bounded array per partition.

A text is read whole: a run of more than ``LONGEST`` letters, as in unspaced scripts, is several
positions of the chain that together cover it, and every language of the table can be predicted, so the
model grows with their number. Forward-backward gives every word its distribution over languages, the mean
over words is the distribution of the document. Texts of similar length run side by side, one array
step per word position.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text
if no language can be learned; equal means go to the language first in code-point order; repeated
rows are predicted alike; an empty table gives no rows; other columns are not read. Rows with a null
id or a null language are never learnt from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.batches import pieces
from folioscope.llm.toxicity import held_out
from folioscope.session import stable

SAMPLE_DOCS = 150
LONGEST = 40
FEATURES = 1 << 16
ROUNDS = 14
RATE = 0.35
SHRINK = 1e-4
PARTITIONS = 6
WINDOW = 5
OWN_BIAS = 1.5
MEMO_SIZE = 200_000
TEXTS_AT_ONCE = 2048
CELLS = 200_000  # words of texts that run side by side
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Runs of letters; longer ones in consecutive pieces of ``LONGEST`` letters."""
    return re.findall(rf"[^\W\d_]{{1,{LONGEST}}}", (text or "").lower())


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def features(word: str) -> list[int]:
    """Numbers of the word, its affixes and its trigrams."""
    from zlib import crc32

    framed = f"^{word}$"
    names = [f"w{word}", f"p{word[:2]}", f"p{word[:3]}", f"s{word[-2:]}", f"s{word[-3:]}"]
    names += [framed[i : i + 3] for i in range(len(framed) - 2)]
    return [crc32(n.encode("utf-8", "surrogatepass")) % FEATURES for n in names]


@dataclass
class Field:
    """Languages, weights ``(features, languages)`` and transitions ``(languages, languages)``."""

    languages: list
    weights: object
    transitions: object


class Emissions(dict):
    """Rows of a growing table of word scores; starts anew when it has grown to a fixed size."""

    def __init__(self, field: Field):
        import numpy as np

        self.field = field
        self.table = np.zeros((1024, len(field.languages)), dtype=np.float32)

    def __missing__(self, word: str) -> int:
        import numpy as np

        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = self.field.weights[features(word)].sum(axis=0)
        self[word] = at
        return at

    def rows(self, words: list[str]):
        """Scores of the words of one text."""
        import numpy as np

        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        scores = self.table[found]
        if len(self) > MEMO_SIZE:
            self.clear()
        return scores


def side_by_side(lengths: list[int]) -> Iterator[list[int]]:
    """Indices of texts with words, longest first, in runs of at most about ``CELLS`` cells."""
    order = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: (-lengths[i], i))
    run: list[int] = []
    for i in order:
        if run and (len(run) + 1) * lengths[run[0]] > CELLS:
            yield run
            run = []
        run.append(i)
    if run:
        yield run


def forward_backward(scores: list, transitions, with_pairs: bool = False):
    """Word distributions of texts sorted by falling length.

    Returns an array ``(position, text, language)``, zero beyond a text's end, and the expected
    transition counts if asked for.
    """
    import numpy as np

    lengths = np.array([len(s) for s in scores])
    steps, texts, langs = lengths[0], len(scores), scores[0].shape[1]
    local = np.zeros((steps, texts, langs))
    for i, s in enumerate(scores):
        local[: len(s), i] = np.exp(s - s.max(axis=1, keepdims=True))
    change = np.exp(transitions - transitions.max())
    active = (lengths[None, :] > np.arange(steps)[:, None]).sum(axis=1)
    forward = np.zeros_like(local)
    now = local[0] / local[0].sum(axis=1, keepdims=True)
    forward[0] = now
    for t in range(1, steps):
        k = active[t]
        now = (now[:k] @ change) * local[t, :k]
        now /= now.sum(axis=1, keepdims=True)
        forward[t, :k] = now
    pairs = np.zeros((langs, langs))
    backward = np.full((texts, langs), 1.0 / langs)
    for t in range(steps - 2, -1, -1):
        k = active[t + 1]
        ahead = local[t + 1, :k] * backward[:k]
        if with_pairs:
            both = (forward[t, :k].T @ (ahead / _norm(forward[t, :k], change, ahead))) * change
            pairs += both
        ahead = ahead @ change.T
        backward[:k] = ahead / ahead.sum(axis=1, keepdims=True)
        forward[t, :k] *= backward[:k]
        forward[t, :k] /= forward[t, :k].sum(axis=1, keepdims=True)
    return forward, pairs


def _norm(before, change, ahead):
    return ((before @ change) * ahead).sum(axis=1, keepdims=True)


def predict_batch(texts: list, emissions: Emissions) -> list[tuple[str, float]]:
    import numpy as np

    field = emissions.field
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    if not field.languages:
        return out
    words = [words_of(t) if has_letter(t) else [] for t in texts]
    for run in side_by_side([len(w) for w in words]):
        scores = [emissions.rows(words[i]) for i in run]
        found, _ = forward_backward(scores, field.transitions)
        means = found.sum(axis=0)
        means /= means.sum(axis=1, keepdims=True)
        for i, mean in zip(run, means):
            best = int(np.argmax(mean))
            out[i] = (field.languages[best], float(min(1.0, mean[best])))
    return out


def label_words(words: list[str], own: int, odds: dict, langs: int):
    """Languages of the words of a training text: lexicon odds over a window, own language favoured."""
    import numpy as np

    flat = np.zeros(langs)
    table = np.array([odds.get(w, flat) for w in words]).reshape(len(words), langs)
    sums = np.concatenate([np.zeros((1, langs)), np.cumsum(table, axis=0)])
    ends = np.minimum(np.arange(len(words)) + WINDOW + 1, len(words))
    starts = np.maximum(np.arange(len(words)) - WINDOW, 0)
    totals = sums[ends] - sums[starts]
    totals[:, own] += OWN_BIAS
    return totals.argmax(axis=1)


def gradient(texts: list, owns: list, field: Field, odds: dict):
    """Of the log-likelihood of labelled texts: for the weights, for the transitions, and words."""
    import numpy as np

    langs = len(field.languages)
    types: dict[str, int] = {}
    words = [words_of(t) for t in texts]
    coded = [np.array([types.setdefault(w, len(types)) for w in ws], dtype=np.int64) for ws in words]
    listed = [features(w) for w in types]
    sizes = np.array([len(x) for x in listed])
    flat = np.array([f for x in listed for f in x], dtype=np.int64)
    owner = np.repeat(np.arange(len(listed)), sizes)
    scores = np.zeros((len(listed), langs))
    for lang in range(langs):
        scores[:, lang] = np.bincount(owner, field.weights[flat, lang], len(listed))
    by_type = np.zeros_like(scores)
    by_pair = np.zeros((langs, langs))
    for run in side_by_side([len(w) for w in words]):
        found, pairs = forward_backward([scores[coded[i]] for i in run], field.transitions, True)
        by_pair -= pairs
        for column, i in enumerate(run):
            gold = label_words(words[i], owns[i], odds, langs)
            error = -found[: len(gold), column]
            error[np.arange(len(gold)), gold] += 1
            np.add.at(by_type, coded[i], error)
            np.add.at(by_pair, (gold[:-1], gold[1:]), 1)
    by_weight = np.zeros((FEATURES, langs), dtype=np.float32)
    for lang in range(langs):
        by_weight[:, lang] = np.bincount(flat, by_type[owner, lang], FEATURES)
    return by_weight, by_pair, sum(map(len, words))


def _lexicon(sample: DataFrame, languages: list) -> dict:
    """Log-odds of sampled words per language, from their counts; a bounded sample bounds it."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            counts: dict = {}
            for text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in words_of(text):
                    counts[word, own] = counts.get((word, own), 0) + 1
            if counts:
                columns = zip(*((w, o, n) for (w, o), n in counts.items()))
                kinds = [pa.string(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "own", "n"]
                )

    rows = (
        sample.select("text", "own")
        .mapInArrow(run, "word string, own int, n bigint")
        .groupBy("word", "own")
        .agg(F.sum("n").alias("n"))
        .groupBy("word")
        .agg(F.map_from_entries(F.collect_list(F.struct("own", "n"))).alias("n"))
        .filter(F.aggregate(F.map_values("n"), F.lit(0).cast("long"), lambda a, b: a + b) > 1)
        .collect()
    )
    odds = {}
    for word, by_lang in rows:
        counts = np.full(len(languages), 0.3)
        for own, n in by_lang.items():
            counts[own] += n
        logs = np.log(counts / counts.sum())
        odds[word] = logs - logs.max()
    return odds


def sample_of(docs: DataFrame, key: str, text: str, lang: str, size: int) -> tuple[DataFrame, list]:
    """``(text, own)`` of about ``size`` labelled documents per language, and the languages."""
    known = docs.select(
        F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter(F.col("lang").isNotNull() & ~held_out(F.col("id")) & F.col("text").rlike(r"\p{L}"))
    counts = known.groupBy("lang").count()
    counted = {r["lang"]: r["count"] for r in counts.collect()}
    languages = sorted(counted)
    # the draw is a hash of the id, so it can be repeated
    draw = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    # one flat CASE each, however many languages there are
    number, share = F.when(F.lit(False), 0), F.when(F.lit(False), 0.0)
    for i, name in enumerate(languages):
        number = number.when(F.col("lang") == name, i)
        share = share.when(F.col("lang") == name, min(1.0, size / counted[name]))
    picked = known.select("text", number.alias("own"), (draw < share).alias("picked"))
    return picked.filter("picked").select("text", "own"), languages


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    rounds: int = ROUNDS,
) -> Field:
    import numpy as np

    sample, languages = sample_of(docs, key, text, lang, sample_docs)
    langs = len(languages)
    field = Field(languages, np.zeros((FEATURES, langs), np.float32), np.zeros((langs, langs)))
    if langs < 2:
        return field
    sample = stable(sample.repartition(PARTITIONS))
    context = docs.sparkSession.sparkContext
    odds = _lexicon(sample, languages)
    first = [np.zeros_like(field.weights), np.zeros_like(field.transitions)]
    second = [np.zeros_like(field.weights), np.zeros_like(field.transitions)]
    sent_odds = context.broadcast(odds)
    for step in range(1, rounds + 1):
        sent = context.broadcast(field)

        def run(batches: Iterator, sent=sent) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                parts = gradient(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), sent.value, sent_odds.value
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([parts[0].tobytes()], pa.binary()),
                        pa.array([parts[1].tobytes()], pa.binary()),
                        pa.array([parts[2]], pa.int64()),
                    ],
                    names=["weights", "pairs", "n"],
                )

        rows = sample.mapInArrow(run, "weights binary, pairs binary, n bigint").collect()
        sent.unpersist()
        total = max(1, sum(r["n"] for r in rows))
        own = [
            sum(np.frombuffer(r["weights"], np.float32) for r in rows).reshape(FEATURES, langs) / total,
            sum(np.frombuffer(r["pairs"], np.float64) for r in rows).reshape(langs, langs) / total,
        ]
        for i, target in enumerate((field.weights, field.transitions)):
            slope = own[i] - SHRINK * target
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            size = np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8
            target += (RATE * first[i] / (1 - 0.9**step) / size).astype(target.dtype)
    sent_odds.unpersist()
    return field


def predict(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        emissions = Emissions(sent.value)
        for batch in pieces(batches, TEXTS_AT_ONCE):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = predict_batch(texts, emissions)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=[*batch.schema.names, "lang_pred", "lang_score"],
            )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{columns}, lang_pred string, lang_score double")
