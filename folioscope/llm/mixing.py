"""Mixing sources to target weights by Efraimidis-Spirakis order, in DataFrame functions only.

Every document draws an exponential key divided by its quality weight; the order of the keys within
a source is a weighted random order without replacement. A source first takes whole epochs of its
documents, then the documents of smallest key up to its budget of words. The draw is a hash of
seed and id, so it can be repeated.

Prefix sums need no task that sees a whole source: keys fall into ``slices`` equal parts of the
distribution that texts of quality 1 have, and the sums of the slices are added up within a source.
Keys of poor texts crowd into the last slices, so the slice that the budget ends in is cut again, at
``EDGE_PARTS`` quantiles of the keys it really holds, and only rows of one such part are ordered
together. The outcome of a source is a number of epochs and the last key taken, one row per
source, so applying it to documents moves no text.

Defined results: a null text has no words; a null source is a source of its own, last in the order;
a source without words gets the target 0; repeated rows count as often as they occur and share
their key; a null id has the key of the empty string; an empty table gives no rows; all columns of the
input are kept, but for those of the same name as one of the four added ones, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.session import broadcast_if_small, stable

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2.0
SLICES = 4096
EDGE_PARTS = 256
SEED = "mix-1"
WORDS = r"[^\x20\x09-\x0D]+"
# signs that prose seldom holds; their share lowers the quality of a text
ODD_SIGNS = "$%&#*|_{}<>[]\\/=+~^@0123456789"
LEAST_QUALITY = 0.05


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """One minus the share of odd signs, and never below ``LEAST_QUALITY``."""
    odd = F.length(text) - F.length(F.translate(text, ODD_SIGNS, ""))
    share = odd / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(1 - share, F.lit(LEAST_QUALITY)), F.lit(LEAST_QUALITY))


def draw_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """``-ln(u) / weight`` with ``u`` in (0, 1) from 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((number + 0.5) / float(16**13)) / weight


def keyed(docs: DataFrame, doc_id: str, text: str, source: str, slices: int) -> DataFrame:
    """Documents with ``mix_size``, ``mix_key`` and ``mix_slice``."""
    key = draw_key(F.col(doc_id), quality(F.col(text)))
    return docs.withColumns({"mix_size": word_count(F.col(text)), "mix_key": key}).withColumn(
        "mix_slice", F.floor((1 - F.exp(-F.col("mix_key"))) * slices).cast("int")
    )


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources in code-point order get the weights in turn. A source stops at ``most`` times its size:
    in the order of size per weight, the first sources stop until the level, what is left per unit of
    weight left, reaches no further one. The windows see one row per source and nothing larger.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    whole = Window.partitionBy()
    by_need = Window.orderBy("need", F.col("source").asc_nulls_last())
    stopped = by_need.rowsBetween(Window.unboundedPreceding, -1)
    left = by_need.rowsBetween(0, Window.unboundedFollowing)
    table = (
        sizes.withColumn("weight", weight)
        .withColumn("need", most * F.col("source_size") / F.col("weight"))
        .withColumn("budget", share * F.sum("source_size").over(whole))
        .withColumn(
            "level",
            (
                F.col("budget")
                - most * F.coalesce(F.sum("source_size").over(stopped), F.lit(0)).cast("double")
            )
            / F.sum("weight").over(left),
        )
        # the level counts from the first source that it does not lift to its stop
        .withColumn(
            "water",
            F.min_by(
                F.when(F.col("level") <= F.col("need"), F.col("level")),
                F.when(F.col("level") <= F.col("need"), F.col("need")),
            ).over(whole),
        )
    )
    stop = most * F.col("source_size")
    target = F.least(stop, F.coalesce(F.col("water") * F.col("weight"), stop))
    return table.select("source", "source_size", target.cast("double").alias("target"))


def _last_keys(drawn: DataFrame, edges: DataFrame) -> DataFrame:
    """``(source, last_key)``: the largest key of each edge slice that the budget still takes.

    A document whose middle lies within the budget brings the total nearer to it.
    """
    same = F.col("d.source").eqNullSafe(F.col("e.source")) & F.expr("d.mix_slice = e.edge_slice")
    rows = (
        drawn.alias("d")
        .join(edges.alias("e"), same)
        .select(F.col("d.source").alias("source"), "mix_key", "mix_size", "before", "rest")
    )
    shares = [i / EDGE_PARTS for i in range(1, EDGE_PARTS)]
    cuts = broadcast_if_small(
        rows.groupBy(F.col("source").alias("cut_source")).agg(
            F.percentile_approx("mix_key", shares, 100 * EDGE_PARTS).alias("cuts")
        )
    )
    # equal keys are in one part, as they are taken together
    part = F.size(F.filter("cuts", lambda c: c < F.col("mix_key")))
    parted = rows.join(cuts, F.col("source").eqNullSafe(F.col("cut_source"))).withColumn("part", part)
    # at most EDGE_PARTS rows per source meet in this window
    running = F.sum("part_size").over(Window.partitionBy("source").orderBy("part"))
    ends = broadcast_if_small(
        parted.groupBy("source", "part", "before", "rest")
        .agg(F.sum("mix_size").alias("part_size"))
        .withColumn("part_end", F.col("before") + running)
        .filter("part_end >= rest")
        .groupBy(F.col("source").alias("end_source"))
        .agg(F.min(F.expr("struct(part, part_end - part_size AS part_before)")).alias("end"))
        .select("end_source", F.col("end.part").alias("end_part"), "end.part_before")
    )
    met = parted.join(ends, F.col("source").eqNullSafe(F.col("end_source")))
    total = F.sum("mix_size").over(Window.partitionBy("source").orderBy("mix_key"))
    within = (
        met.filter("part = end_part")
        .withColumn("middle", F.col("part_before") + total - F.col("mix_size") / 2)
        .filter("middle <= rest")
    )
    earlier = met.filter("part < end_part")
    return (
        within.select("source", "mix_key")
        .unionAll(earlier.select("source", "mix_key"))
        .groupBy("source")
        .agg(F.max("mix_key").alias("last_key"))
    )


def mix_plan(drawn: DataFrame) -> DataFrame:
    """What each source takes: whole ``epochs``, then all keys up to ``last_key``.

    ``drawn`` has ``source``, ``mix_size``, ``mix_key`` and ``mix_slice``. Keys of slices before
    ``edge_slice`` are taken, in the edge slice those up to ``last_key``, a null meaning none.
    """
    by_slice = Window.partitionBy("source").orderBy("mix_slice")
    sizes = drawn.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    plan = stable(
        source_targets(sizes)
        .withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
        .withColumn("rest", F.expr("target - epochs * source_size"))
    )
    # at most as many rows per source as there are slices meet in this window
    sums = drawn.groupBy("source", "mix_slice").agg(F.sum("mix_size").alias("slice_size"))
    sums = sums.withColumn("slice_end", F.sum("slice_size").over(by_slice))
    edges = stable(
        sums.alias("s")
        .join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
        .filter("rest > 0 AND slice_end >= rest")
        .groupBy(F.col("s.source").alias("source"))
        .agg(F.min(F.expr("struct(mix_slice, slice_end - slice_size AS before, rest)")).alias("edge"))
        .select("source", F.col("edge.mix_slice").alias("edge_slice"), "edge.before", "edge.rest")
    )
    last = _last_keys(drawn, edges)
    return (
        plan.drop("rest")
        .alias("p")
        .join(edges.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
        .join(last.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")), "left")
        .select("p.source", "source_size", "target", "epochs", "edge_slice", "last_key")
    )


def apply_plan(docs: DataFrame, source: str, plan: DataFrame) -> DataFrame:
    """Keyed documents with ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    The plan has one row per source; it is broadcast if it is counted as small, else joined as any
    other table.
    """
    plan = broadcast_if_small(plan.select([F.col(c).alias(f"plan_{c}") for c in plan.columns]))
    further = F.expr(
        "mix_slice < plan_edge_slice OR mix_slice = plan_edge_slice AND mix_key <= plan_last_key"
    )
    copies = F.col("plan_epochs") + F.coalesce(further, F.lit(False)).cast("long")
    return (
        docs.join(plan, docs[source].eqNullSafe(F.col("plan_source")))
        .withColumns(
            {
                "mix_source_size": F.col("plan_source_size"),
                "mix_target": F.col("plan_target"),
                "mix_copies": copies.cast("long"),
            }
        )
        .drop(*plan.columns)
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    slices: int = SLICES,
    measures_only: bool = False,
) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    With ``measures_only`` all other columns but id and source are left out, which saves the second
    reading of the texts.
    """
    added = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    # the input's own columns travel in a struct, so no name of theirs can meet one used here
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    named = docs.select(
        own, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")
    )
    full = keyed(named, "doc_id", "text", "source", slices)
    drawn = stable(full.select("doc_id", "source", "mix_size", "mix_key", "mix_slice"))
    rows = apply_plan(drawn if measures_only else full, "source", mix_plan(drawn))
    if measures_only:
        kept = [F.col("doc_id").alias(doc_id), F.col("source").alias(source)]
    else:
        kept = [F.col(f"doc.`{c}`") for c in docs.columns if c not in added]
    return rows.select(*kept, *added)
