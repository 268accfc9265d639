"""TF-IDF on long tables: a fitted model is a table, and a document vector is a sorted array.

The shape follows the data flow. Raw counts are made inside the row, so the first shuffle is the
one on the document key that puts lemmatised counts together; document frequencies are a
pre-aggregated count per term; weights come from one join with the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import let, term_counts, tokenize
from folioscope.operators.lemma import lemma_map, may_inflect
from folioscope.operators.ordinal import highest
from folioscope.session import compact, fits_broadcast

# Terms that are broadcast when the whole vocabulary is too large for it; a term is a word, and words
# so frequent are short, so this many stay well within the memory of a task.
HOT_TERMS = 100_000
# Lemmas that tasks look up on their own instead of joining them, and documents they rename at once.
TASK_LEMMAS = 100_000
ROWS_AT_ONCE = 1_024


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal rows out to ``partitions``, if the caller asks for it.

    Of use for a small file of one row group, which a single task would tokenise; an input of as many
    files is read by many tasks as it is.
    """
    if partitions is None or len(df.inputFiles()) >= partitions:
        return df
    return df.repartition(partitions)


def document_counts(
    docs: DataFrame,
    key: str,
    text: str,
    tokenizer: Callable[[Column], Column] = tokenize,
    keep: tuple[str, ...] = (),
    partitions: int | None = None,
) -> DataFrame:
    """``(key, counts)`` with ``counts`` an array of ``(term, tf)``; empty documents are kept.

    ``key`` may be a struct, for documents told apart by source and id. ``keep`` names further
    columns to carry along; ``partitions`` spreads a small input first.
    """
    return spread(docs.select(key, text, *keep), partitions).select(
        key, *keep, term_counts(tokenizer(F.col(text))).alias("counts")
    )


def long_counts(counts: DataFrame, key: str) -> DataFrame:
    """``(key, term, tf)``.

    The outer form keeps the optimizer from adding a filter on the array, which would be pushed
    down as a second tokenisation of every text.
    """
    return counts.select(key, F.inline_outer("counts")).where(F.col("term").isNotNull())


def distinct_terms(counts: DataFrame) -> DataFrame:
    terms = counts.select(F.explode_outer("counts.term").alias("term"))
    return terms.where(F.col("term").isNotNull()).distinct()


def _merge_equal_terms(pairs: Column) -> Column:
    """Add up the ``tf`` of equal terms in an array of ``(term, tf)`` sorted by term."""

    def totals(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i)["term"] != F.get(s, i - 1)["term"]),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(s, start)["term"].alias("term"),
                    F.aggregate(
                        F.slice(s, start + 1, F.coalesce(F.get(at, k + 1), F.size(s)) - start),
                        F.lit(0).cast("bigint"),
                        lambda total, x: total + x["tf"],
                    ).alias("tf"),
                ),
            ),
        )

    none = F.expr("cast(array() as array<struct<term:string,tf:bigint>>)")
    return let(F.sort_array(pairs), lambda s: F.when(F.size(s) > 0, totals(s)).otherwise(none))


def _renamed(column: pa.Array, plurals: pa.Array, bases: pa.Array) -> pa.Array:
    """Lists of ``(term, tf)`` with terms renamed, equal ones added up, in term order."""
    offsets = column.offsets.to_numpy()
    pairs = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    coded = pairs.field("term").dictionary_encode(null_encoding="encode")
    words = coded.dictionary
    base = pc.index_in(words, value_set=plurals)
    names = pc.coalesce(bases.take(base), words).dictionary_encode(null_encoding="encode")
    # the numbers of the names in their byte order, which is Spark's
    order = pc.sort_indices(names.dictionary, null_placement="at_start").to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    codes = place[names.indices.to_numpy()][coded.indices.to_numpy()]
    rows = len(offsets) - 1
    cells = np.repeat(np.arange(rows), np.diff(offsets)) * len(order) + codes
    by_cell = np.argsort(cells, kind="stable")
    cells = cells[by_cell]
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    tf = pairs.field("tf").to_numpy()[by_cell]
    totals = np.add.reduceat(tf, first) if len(first) else tf
    held = cells[first]
    terms = names.dictionary.take(pa.array(order[held % max(1, len(order))]))
    ends = np.searchsorted(held, np.arange(rows + 1) * len(order)).astype(np.int32)
    merged = pa.StructArray.from_arrays([terms, pa.array(totals, pa.int64())], names=["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends), merged)


def _rename_in_tasks(counts: DataFrame, key: str, lemmas: DataFrame) -> DataFrame:
    """``counts`` last, with the lemmas of a small table; no row leaves its task.

    Rows without a key keep their terms, as they do where keys are joined.
    """
    sent = counts.sparkSession.sparkContext.broadcast(
        lemmas.select("term", "lemma").toArrow().combine_chunks()
    )
    rows = counts.select(*[F.col(f"`{c}`") for c in counts.columns if c != "counts"], "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plurals, bases = (
            pa.concat_arrays(sent.value[c].chunks) if sent.value.num_rows else pa.array([], pa.string())
            for c in ("term", "lemma")
        )
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                counted, keyless = batch.columns[-1], batch.column(key).is_null()
                merged = _renamed(counted, plurals, bases)
                if batch.column(key).null_count:
                    merged = pc.if_else(keyless, counted, merged.cast(counted.type))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], merged], names=batch.schema.names
                )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(run, ", ".join(kinds))


def lemmatize_counts(counts: DataFrame, key: str, lemmas: DataFrame) -> DataFrame:
    """Replace terms by their lemma and add up counts that meet; all documents and columns are kept.

    Lemmas are few beside the terms, so tasks look them up where the counts lie. Beyond
    ``TASK_LEMMAS`` only terms with a noun ending are joined with them, and what is found travels back
    to its document as a small map, so the counts themselves stay arrays, one row per document.
    """
    lemmas = compact(lemmas)
    small = fits_broadcast(lemmas)
    if small and lemmas.count() <= TASK_LEMMAS:
        return _rename_in_tasks(counts, key, lemmas)
    inflected = (
        counts.select(key, F.explode_outer("counts.term").alias("term"))
        .where(may_inflect(F.col("term")))
        .join(F.broadcast(lemmas) if small else lemmas, "term")
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "lemma"))).alias("renames"))
    )
    def lemma(term: Column) -> Column:
        return F.coalesce(F.when(may_inflect(term), F.col("renames")[term]), term)

    renamed = F.transform(
        "counts", lambda x: F.struct(lemma(x["term"]).alias("term"), x["tf"].alias("tf"))
    )
    merged = F.when(F.col("renames").isNull(), F.col("counts")).otherwise(
        _merge_equal_terms(renamed)
    )
    return counts.join(inflected, key, "left").select(
        *[c for c in counts.columns if c != "counts"], merged.alias("counts")
    )


def df_limit(value: int | float | str | None) -> int | float | None:
    """An integer is a count of documents, a fraction within 0..1 a share of them; 0 is no limit."""
    if value is None:
        return None
    if isinstance(value, str):
        try:
            value = int(value)
        except ValueError:
            value = float(value)
    if isinstance(value, float) and not 0.0 <= value <= 1.0:
        raise ValueError("a share of documents must lie between 0.0 and 1.0")
    if value < 0:
        raise ValueError("a count of documents must not be negative")
    return value or None


def _threshold(limit: int | float, n: Column) -> Column:
    return F.lit(limit) * n if isinstance(limit, float) else F.lit(limit)


def fit(
    counts: DataFrame,
    min_df: int | float | str | None = None,
    max_df: int | float | str | None = None,
    max_features: int | None = None,
) -> DataFrame:
    """The model ``(term, df, tf_total, idf)`` of a training set.

    ``idf = ln((1 + n) / (1 + df)) + 1`` where ``n`` counts every training document, empty ones
    too. Limits on ``df`` apply before ``max_features`` keeps the terms with the highest totals
    (equal totals: by term).
    """
    n = counts.agg(F.count("*")).scalar()
    terms = (
        counts.select(F.inline_outer("counts"))
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("tf_total"))
    )
    low, high = df_limit(min_df), df_limit(max_df)
    if low is not None:
        terms = terms.where(F.col("df") >= _threshold(low, n))
    if high is not None:
        terms = terms.where(F.col("df") <= _threshold(high, n))
    if max_features is not None:
        terms = highest(terms, "tf_total", "term", max_features)
    return terms.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1)


def _lists(ends: np.ndarray, **parts: pa.Array) -> pa.Array:
    """Lists of structs that end at ``ends``."""
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(parts.values()), names=list(parts)))


def _split_by_model(counts: DataFrame, key: str, hot: pa.Table) -> DataFrame:
    """``(key, n, tf, rare)``: numbers and counts of the terms in ``hot``, which is sent, and all others."""
    sent = counts.sparkSession.sparkContext.broadcast(hot)
    rows = counts.select(key, "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value["term"].combine_chunks()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                offsets = batch.column(1).offsets.to_numpy()
                pairs = batch.column(1).values.slice(offsets[0], offsets[-1] - offsets[0])
                coded = pairs.field("term").dictionary_encode(null_encoding="encode")
                numbers = pc.fill_null(pc.index_in(coded.dictionary, value_set=terms), -1)
                numbers = numbers.to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
                known = numbers >= 0
                before = np.concatenate([[0], np.cumsum(known)])[offsets[1:] - offsets[0]]
                after = offsets[1:] - offsets[0] - before
                tf = pairs.field("tf").to_numpy()
                mask = pa.array(~known)
                ends = pa.array(np.concatenate([[0], before]).astype(np.int32))
                held = [
                    pa.ListArray.from_arrays(ends, pa.array(x[known].astype(np.int32)))
                    for x in (numbers, tf)
                ]
                others = _lists(after, term=pairs.field("term").filter(mask), tf=pa.array(tf[~known], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *held, others], names=[key, "n", "tf", "rare"]
                )

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        run, f"`{key}` {kind}, n array<int>, tf array<int>, rare array<struct<term:string,tf:bigint>>"
    )


def _scaled(owner: np.ndarray, rows: int, terms: pa.Array, weights: np.ndarray) -> pa.Array:
    """Lists of ``(term, weight)`` of length 1 in term order."""
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    at = np.lexsort((weights, place[coded.indices.to_numpy()], owner))
    owner, weights = owner[at], weights[at]
    length = np.sqrt(np.bincount(owner, weights * weights, rows))
    scaled = pa.array(weights / length[owner])
    return _lists(np.searchsorted(owner, np.arange(rows), side="right"), term=terms.take(pa.array(at)), weight=scaled)


def transform(
    counts: DataFrame, key: str, model: DataFrame, hot_terms: int = HOT_TERMS
) -> DataFrame:
    """``(key, vector)``, see ``transformer``."""
    return transformer(counts, key, model, hot_terms)()


def transformer(
    counts: DataFrame, key: str, model: DataFrame, hot_terms: int = HOT_TERMS
) -> Callable[..., DataFrame]:
    """A function that gives ``(key, vector)``: L2-normalised weights as an array of ``(term, weight)`` in term order.

    Terms the model does not know are ignored before the norm is taken. A document without a
    known term has no row here: take set sizes from the documents, not from the vectors.

    A model is cut at a document frequency: the terms above it, at most ``hot_terms``, hold most of the
    counts and would each meet in one task, so they are sent to the tasks, and travel back to their
    document as numbers. Only counts of the other terms become rows and meet the model in a shuffle, and
    none of those terms has more rows than the cut.

    Given a table with one row per key, the function adds its columns, for the keys it holds. The two meet where
    the counts of a document are gathered, before they are as large as a vector. Given a function of batches
    and its columns, too, it maps the vectors by it in the worker that makes them.
    """
    known = model.select("term", "df", "idf")
    hot, rare = known, known.limit(0)
    n_terms = known.count()
    if n_terms > hot_terms:
        cut = highest(known.select("df", "term"), "df", "term", hot_terms).agg(F.min("df")).first()[0]
        above = F.lit(False) if cut is None else F.col("df") > cut
        hot, rare = known.where(above), known.where(~above)
    table = hot.select("term", "idf").toArrow()
    parts = _split_by_model(counts, key, table)
    if n_terms > hot_terms:
        parts = compact(parts)
        others = (
            parts.select(key, F.inline("rare"))
            .join(rare.select("term", "idf"), "term")
            .select(key, F.struct("term", (F.col("tf") * F.col("idf")).alias("weight")).alias("rare"))
        )
    else:
        none = F.lit(None).cast("struct<term:string,weight:double>")
        others = parts.where(F.lit(False)).select(key, none.alias("rare"))
    met = parts.where(F.size("n") > 0).select(key, "n", "tf")
    gathered = (
        met.unionByName(others, allowMissingColumns=True)
        .groupBy(key)
        .agg(
            F.flatten(F.collect_list("n")).alias("n"),
            F.flatten(F.collect_list("tf")).alias("tf"),
            F.collect_list("rare").alias("rare"),
        )
    )
    sent = counts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = sent.value["term"].combine_chunks(), sent.value["idf"].to_numpy()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                owners, held = [], []
                for column in batch.columns[-3:]:
                    offsets = column.offsets.to_numpy()
                    owners.append(np.repeat(np.arange(batch.num_rows), np.diff(offsets)))
                    held.append(column.values.slice(offsets[0], offsets[-1] - offsets[0]))
                numbers, tf, others = held
                listed = [terms.take(numbers), others.field("term").cast(terms.type)]
                weights = [tf.to_numpy() * idf[numbers.to_numpy()], others.field("weight").to_numpy()]
                vector = _scaled(
                    np.concatenate([owners[0], owners[2]]),
                    batch.num_rows,
                    pa.concat_arrays(listed),
                    np.concatenate(weights),
                )
                carried = batch.columns[:-3]
                yield pa.RecordBatch.from_arrays([*carried, vector], names=[*batch.schema.names[:-3], "vector"])

    def vectors(
        beside: DataFrame | None = None, then: Callable | None = None, fields: str = ""
    ) -> DataFrame:
        rows, carried = gathered, [key]
        if beside is not None:
            carried = [key, *[c for c in beside.columns if c != key]]
            rows = gathered.join(beside, key).select(*carried, "n", "tf", "rare")
        if then is not None:
            return rows.mapInArrow(lambda batches: then(run(batches)), fields)
        kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried]
        return rows.mapInArrow(run, ", ".join([*kinds, "vector array<struct<term:string,weight:double>>"]))

    return vectors


def long_weights(vectors: DataFrame, key: str) -> DataFrame:
    """``(key, term, weight)``."""
    return vectors.select(key, F.inline("vector"))


def training_lemmas(train_counts: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Lemma table of the training terms; the lexicon defaults to the training vocabulary."""
    terms = compact(distinct_terms(train_counts))
    return lemma_map(terms, terms if lexicon is None else lexicon)
