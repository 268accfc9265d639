"""Exact top-k by inner product: exhaustive term-at-a-time accumulation over blocks.

Vectors become sparse integer rows. Candidates are packed, where they are scanned, into blocks that
hold for each term (dimension) the postings ``(position, weight)``; queries are gathered first, so that
they fill as few blocks as they need however they were scanned. Each query block meets each candidate
block once; as long as the query blocks are small enough to broadcast, no candidate is moved for it: for every term the weights of the
queries that have it are scattered, times the postings, into a dense array of scores, one line per
query. A partition selection keeps the best of each line, ties included by the smaller id, and a
window merges the lines of all blocks. A block is one row, so what is shipped and held is bounded by
the block sizes; the pairing is a join on block numbers, of the stated queries against all rows.

Defined results: vectors that are null, or hold null or non-finite components, take no part, as
query or candidate; a vector without components scores 0 against all; a missing component counts as
0, so lengths may differ; rows with a null id take no part; a repeated row is a query and a candidate
of its own, and no row is a candidate of a query with its own id; with fewer than ``k`` candidates
all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.session import broadcast_if_small, stable

CANDIDATE_ROWS = 8192
QUERY_ROWS = 4096
SCATTER_BELOW = 16  # postings of at least one in so many candidates are added as full columns
LINES = 64  # queries accumulated together; their score lines stay in the processor's cache
PARTS = {"ids": "<i8", "terms": "<i4", "sizes": "<i4", "at": "<i4", "weights": "<i8"}
BLOCK = "block bigint, ids binary, terms binary, sizes binary, at binary, weights binary"


def quantised(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` per component, null for vectors that take no part."""
    # a double outside of the long range would saturate, which no score could carry
    fine = F.forall(
        vector,
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (F.abs(x.cast("double")) < float("inf")),
    )
    values = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return F.when(F.coalesce(fine, F.lit(False)), values)


def _pack(rows: int):
    """``(id, values)`` rows to blocks of at most ``rows`` rows, postings sorted by term."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids: list = []
        lengths: list = []
        values: list = []

        def block() -> pa.RecordBatch:
            nonlocal number
            size = np.concatenate(lengths)
            flat = np.concatenate(values)
            row = np.repeat(np.arange(len(size)), size)
            term = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            kept = flat != 0
            order = np.lexsort((row[kept], term[kept]))
            row, term, flat = row[kept][order], term[kept][order], flat[kept][order]
            terms, sizes = np.unique(term, return_counts=True)
            whole = [np.concatenate(ids), terms, sizes, row, flat]
            number += 1
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([(task << 32) + number], pa.int64()),
                    **{
                        n: pa.array([x.astype(kind).tobytes()], pa.binary())
                        for (n, kind), x in zip(PARTS.items(), whole)
                    },
                }
            )

        held = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows - held)
                vectors = part.column(1)
                ids.append(part.column(0).to_numpy())
                lengths.append(vectors.value_lengths().to_numpy(zero_copy_only=False))
                values.append(vectors.flatten().to_numpy(zero_copy_only=False))
                at += part.num_rows
                held += part.num_rows
                if held == rows:
                    yield block()
                    ids, lengths, values, held = [], [], [], 0
        if held:
            yield block()

    return run


def _unpack(batch, prefix: str, i: int) -> list:
    import numpy as np

    return [
        np.frombuffer(batch.column(batch.schema.get_field_index(prefix + n))[i].as_py(), kind)
        for n, kind in PARTS.items()
    ]


def accumulate(queries: list, candidates: list, k: int) -> Iterator[tuple]:
    """Best ``k`` of one candidate block for every row of one query block, as index arrays."""
    import numpy as np

    q_ids, q_terms, q_sizes, q_at, q_weights = queries
    c_ids, c_terms, c_sizes, c_at, c_weights = candidates
    if not len(c_ids):
        return
    most = max(int(np.abs(q_weights).max(initial=0)), 1) * max(int(np.abs(c_weights).max(initial=0)), 1)
    kind = np.int32 if most * max(len(c_terms), 1) < 2**31 else np.int64
    q_ends, c_ends = np.cumsum(q_sizes), np.cumsum(c_sizes)
    place = {int(t): i for i, t in enumerate(c_terms)}
    c_weights = c_weights.astype(kind)
    # postings that reach many candidates are laid out once, with zeros between them
    columns: dict[int, object] = {}
    product = np.empty(len(c_ids), dtype=kind)
    for first in range(0, len(q_ids), LINES):
        last = min(first + LINES, len(q_ids))
        scores = np.zeros((last - first, len(c_ids)), dtype=kind)
        for i, term in enumerate(q_terms):
            j = place.get(int(term))
            if j is None:
                continue
            own = slice(q_ends[i] - q_sizes[i], q_ends[i])
            lo, hi = np.searchsorted(q_at[own], (first, last))
            lines = q_at[own][lo:hi] - first
            weights = q_weights[own][lo:hi].astype(kind)
            postings = slice(c_ends[j] - c_sizes[j], c_ends[j])
            at, values = c_at[postings], c_weights[postings]
            if len(at) * SCATTER_BELOW >= len(c_ids):
                if j not in columns:
                    columns[j] = np.zeros(len(c_ids), dtype=kind)
                    columns[j][at] = values
                for line, weight in zip(lines, weights):
                    np.multiply(columns[j], weight, out=product)
                    scores[line] += product
            else:
                for line, weight in zip(lines, weights):
                    scores[line, at] += weight * values
        for line in range(last - first):
            row = scores[line]
            allowed = np.flatnonzero(c_ids != q_ids[first + line])
            if len(allowed) > k:
                edge = np.partition(row[allowed], len(allowed) - k)[len(allowed) - k]
                above = allowed[row[allowed] > edge]
                ties = allowed[row[allowed] == edge]
                ties = ties[np.argsort(c_ids[ties], kind="stable")[: k - len(above)]]
                allowed = np.concatenate([above, ties])
            yield first + line, allowed, row[allowed]


def _meet(k: int):
    """Rows holding a query block and a candidate block to ``(query, at, vec_id, score)``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(batch.schema.get_field_index("q_block"))[i].as_py()
                queries, candidates = _unpack(batch, "q_", i), _unpack(batch, "c_", i)
                rows = list(accumulate(queries, candidates, k))
                if not rows:
                    continue
                line = np.concatenate([np.full(len(a), n) for n, a, _ in rows])
                at = np.concatenate([a for _, a, _ in rows])
                score = np.concatenate([s for _, _, s in rows]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(line), name)),
                        pa.array(line.astype(np.int32)),
                        pa.array(queries[0][line]),
                        pa.array(candidates[0][at]),
                        pa.array(score),
                    ],
                    names=["q_block", "line", "query_id", "vec_id", "score"],
                )

    return run


def top_k(
    rows: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    scale: float = 64.0,
    candidate_rows: int = CANDIDATE_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best among all rows of other ids."""
    usable = rows.select(
        F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter("id IS NOT NULL AND v IS NOT NULL")
    packed = usable.select("id", "v").mapInArrow(_pack(candidate_rows), BLOCK)
    candidates = stable(packed)
    asked = stable(usable.filter("asks").select("id", "v"))
    full = max(1, -(-asked.count() // query_rows))
    # dealing in turn leaves the partitions equal but for a few rows, so each is one block
    queries = stable(asked.repartition(full).mapInArrow(_pack(2 * query_rows), BLOCK))
    # one row per thousands of vectors is numbered here
    numbers = Window.orderBy("block")
    numbered = queries.select([F.col(c).alias(f"q_{c}") for c in queries.columns]).join(
        stable(queries.select("block").withColumn("q_number", F.row_number().over(numbers))),
        F.col("q_block") == F.col("block"),
    )
    # each candidate block is sent to every query block: the stated queries against all rows
    meets = F.expr(f"filter(sequence(0, {queries.count()}), i -> i > 0)")
    sent = candidates.select(
        [F.col(c).alias(f"c_{c}") for c in candidates.columns]
        + [F.explode(meets).alias("number")]
    )
    pairs = sent.join(broadcast_if_small(numbered), F.col("number") == F.col("q_number")).drop("block", "number")
    found = pairs.mapInArrow(
        _meet(k), "q_block bigint, line int, query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("q_block", "line").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
