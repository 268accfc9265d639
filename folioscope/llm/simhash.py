"""SimHash near-duplicates: 64-bit fingerprints linked at a small Hamming distance.

Close fingerprints share blocks: the 64 bits are cut into ``distance + 3`` blocks, and two
fingerprints that differ in at most ``distance`` bits agree on at least three whole blocks. Each
distinct fingerprint is sent to one group per choice of three blocks (about 32 equal bits, so a
group holds few unrelated fingerprints), and inside a group distances are verified. A group emits a
spanning forest of its links, never its pairs. A group with more than ``group_limit`` members is not
compared in pairs at all: its members stream on and meet through common neighbours, see
``_wide_links``.

Defined results: a null or empty text, and one without words, has fingerprint zero, which links like
any other; fewer words than a shingle make one shingle; repeated rows and ties are rows of their own
with the same component; a null id never names a component that has another id; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.batches import pieces
from folioscope.llm.components import components
from folioscope.session import stable

BITS = 64
SPARE_BLOCKS = 3
GROUP_LIMIT = 4096
HASH_SEED = 42


def simhash_of(text: bytes, shingle: int) -> int:
    """Fingerprint of one text as a signed 64-bit number.

    Words are runs of anything but the six ASCII blanks, lower-cased in A-Z only.
    """
    import numpy as np
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    count = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, HASH_SEED) for g in grams), dtype="<u8", count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, count, 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3):
    """``(key, fp)`` of every row, ``fp`` a signed long."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in pieces(batches):
            found = [simhash_of(t or b"", shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["id", "fp"]
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, fp bigint").withColumnRenamed("id", key)


def block_masks(distance: int) -> list[int]:
    """Signed masks of every choice of three out of ``distance + 3`` blocks."""
    blocks = distance + SPARE_BLOCKS
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    whole = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(whole, SPARE_BLOCKS)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def spanning_links(members, distance: int) -> list[tuple[int, int]]:
    """Edges of a breadth-first forest over the links among distinct fingerprints (numpy array)."""
    import numpy as np

    rest, links = members, []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count((rest ^ at).view(np.uint64)) <= distance
            if near.any():
                reached = rest[near]
                links.extend((int(at), int(x)) for x in reached)
                queue.extend(reached)
                rest = rest[~near]
    return links


def _group_links(distance: int, group_limit: int):
    """Streams rows ``(block, part, fp)`` sorted by group; a row is a link, or a member passed on.

    Holds one group of at most ``group_limit`` members, and one batch.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = ["wide", "block", "a", "b"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [pa.bool_(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

        def links_of(group) -> list[tuple]:
            return [(False, None, a, b) for a, b in spanning_links(group, distance)]

        held, at, passing = np.empty(0, np.int64), None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            block, part, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            starts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (part[1:] != part[:-1])])
            ends = np.r_[starts[1:], len(fp)]
            rows: list[tuple] = []
            # a group of one that is neither first nor last in the batch cannot link anything
            keep = ends - starts > 1
            keep[[0, -1]] = True
            for s, e in zip(starts[keep], ends[keep]):
                name = (int(block[s]), int(part[s]))
                if name != at:
                    rows += links_of(held)
                    held, at, passing = fp[s:e], name, False
                elif not passing:
                    held = np.r_[held, fp[s:e]]
                else:
                    rows += [(True, name[0], int(x), None) for x in fp[s:e]]
                if len(held) > group_limit:
                    rows += [(True, name[0], int(x), None) for x in held]
                    held, passing = held[:0], True
            if rows:
                yield out(rows)
        if rows := links_of(held):
            yield out(rows)

    return run


def _flips(fp: Column, mask: int, most: int) -> Column:
    """``fp`` with up to ``most`` of the bits outside ``mask`` flipped, each way once."""
    free = [i for i in range(BITS) if not (mask % (1 << BITS)) >> i & 1]
    flips = [sum(1 << i for i in c) for n in range(most + 1) for c in combinations(free, n)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in flips]
    return F.transform(F.array(*map(F.lit, signed)), lambda m: fp.bitwiseXOR(m))


def _wide_links(members: DataFrame, distance: int) -> DataFrame:
    """Links of groups too large for pairs, through common neighbours, with linear work.

    Two fingerprints differ in at most ``distance`` bits exactly if some value is at most
    ``distance // 2`` flips from one and at most the rest from the other. All fingerprints that
    reach a value are linked to the smallest that reaches it by the fewer flips. A value is reached
    by a number of fingerprints that depends on the bits alone, so the collected sets are bounded.
    """
    few = distance // 2
    links = None
    for block, mask in enumerate(block_masks(distance)):
        own = members.filter(F.col("block") == block).select(F.col("a").alias("fp"))
        reached = own.select(
            "fp", F.explode(_flips(F.col("fp"), mask, distance - few)).alias("value")
        ).withColumn(
            "close",
            F.bit_count(F.col("fp").bitwiseXOR(F.col("value"))) <= few,
        )
        found = (
            reached.groupBy("value")
            .agg(
                F.collect_list("fp").alias("all"),
                F.min(F.when(F.col("close"), F.col("fp"))).alias("a"),
            )
            .filter((F.size("all") > 1) & F.col("a").isNotNull())
            .select("a", F.explode("all").alias("b"))
            .filter("a <> b")
        )
        links = found if links is None else links.unionAll(found)
    return links.distinct()


def near_links(distinct: DataFrame, distance: int = 3, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs within ``distance`` bits.

    ``distinct`` has one row per fingerprint ``fp``.
    """
    fp = F.col("fp")
    groups = distinct.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("block"), fp.bitwiseAND(F.lit(m)).alias("part"))
                    for i, m in enumerate(block_masks(distance))
                ]
            )
        ).alias("g"),
        "fp",
    ).select("g.block", "g.part", "fp")
    found = stable(
        groups.repartition("block", "part")
        .sortWithinPartitions("block", "part", "fp")
        .mapInArrow(
            _group_links(distance, group_limit), "wide boolean, block int, a bigint, b bigint"
        )
    )
    links = found.filter(~F.col("wide")).select("a", "b").distinct()
    wide = found.filter("wide")
    if wide.isEmpty():
        return links
    return links.unionAll(_wide_links(wide, distance))


def classes(prints: DataFrame, key: str, distance: int = 3, group_limit: int = GROUP_LIMIT):
    """``(fp, root, component_id)`` per distinct fingerprint of ``prints``.

    ``root`` is one fingerprint of the component, ``component_id`` the smallest key in it.
    """
    nodes = stable(prints.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(near_links(nodes, distance, group_limit), "a", "b")
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    linked = (
        named.join(roots.select("root").distinct(), "root", "left_semi")
        .groupBy("root")
        .agg(F.min("least").alias("linked_least"))
    )
    return named.join(linked, "root", "left").select(
        "fp", "root", F.coalesce("linked_least", "least").alias("component_id")
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 3,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """``(key, fp, component_id)`` per row; the component is named by its smallest key."""
    prints = stable(fingerprints(docs, key, text, shingle))
    of_print = classes(prints, key, distance, group_limit)
    return prints.join(of_print, "fp").select(key, "fp", "component_id")


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 3,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row of each component, the one of the smallest key; repeated rows are one component.

    Rows are told apart by a number that is written next to them, so keys may repeat or be null.
    """
    numbered = stable(docs.withColumn("dedup_row", F.monotonically_increasing_id()))
    rows = numbered.select("dedup_row", F.col(key).alias("dedup_key"))
    prints = stable(fingerprints(numbered, "dedup_row", text, shingle))
    keyed = stable(prints.join(rows, "dedup_row"))
    kept = (
        keyed.join(classes(keyed, "dedup_key", distance, group_limit), "fp")
        .groupBy("root")
        .agg(
            F.min(F.struct(F.isnull("dedup_key").alias("none"), "dedup_key", "dedup_row")).alias("r")
        )
        .select(F.col("r.dedup_row").alias("dedup_row"))
    )
    return numbered.join(kept, "dedup_row", "left_semi").drop("dedup_row")


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
