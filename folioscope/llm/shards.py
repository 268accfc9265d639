"""Sharding by jump consistent hashing, in DataFrame functions only.

The shard of a row depends on its key and on the number of shards. A 64-bit state, seeded by an MD5 of
the key, runs through a linear congruential generator; each draw names the next number of shards
at which the key would move, and the last such jump below the number of shards is the shard. No
ring or table is kept, and one more shard takes rows only into itself. Assigning shards is an
expression: no row is moved.

``number`` gives each row of a shard a place without gaps. The order within a shard is a draw from the
row's key and content, so it shuffles the shard and any rerun repeats it. The draws of a shard
fall into slices of about ``ROWS_PER_SLICE`` rows; only rows of one slice are ordered together,
and slices begin where the counts of the earlier ones end. Equal rows are counted before they
are shuffled, so a row repeated many times is one row until its places are written out.

The state is kept in three limbs of 24, 20 and 20 bits, whose products fit in 64 bits.

Defined results: a null key is the empty string, one key like any other; a null text has no bytes and the
checksum 0; repeated rows get the same shard and places of their own; an empty table gives no rows;
columns other than key and text are not read by ``number``, and ``assign`` keeps them all,
refusing a table that already holds a column it would add.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.session import broadcast_if_small, stable

SHARDS = 8
ROWS_PER_SLICE = 2_048
# fixed values of the generator: state = state * MULTIPLIER + 1 modulo 2^64
MULTIPLIER = 2862933555777941757
LOW, HIGH = (1 << 20) - 1, (1 << 24) - 1


def _hex(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def _text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(""))


def _advance(s: Column) -> list[Column]:
    """The limbs of the next state, highest first."""
    a0, a1, a2 = MULTIPLIER & LOW, MULTIPLIER >> 20 & LOW, MULTIPLIER >> 40 & HIGH
    k0, k1, k2 = s["k0"], s["k1"], s["k2"]
    c0 = k0 * a0 + 1
    c1 = k1 * a0 + k0 * a1 + F.shiftright(c0, 20)
    # of the products beyond 2^60 only four bits remain below 2^64
    top = F.shiftleft((k2 * a1 + k1 * a2).bitwiseAND(F.lit(15)), 20)
    c2 = k2 * a0 + k1 * a1 + k0 * a2 + F.shiftright(c1, 20) + top
    return [c2.bitwiseAND(F.lit(HIGH)), c1.bitwiseAND(F.lit(LOW)), c0.bitwiseAND(F.lit(LOW))]


def _jump(s: Column, shards: int) -> Column:
    """Note the jump reached, draw the next one; nothing changes past ``shards + 1``."""
    top = F.shiftleft(s["k2"], 7) + F.shiftright(s["k1"], 13)  # the upper 31 bits
    noted = F.struct(
        *[s[k].alias(k) for k in ("k2", "k1", "k0")],
        F.floor((s["jump"] + 1) * (F.lit(float(1 << 31)) / (top + 1))).alias("jump"),
        F.when(s["jump"] < shards, s["jump"]).otherwise(s["shard"]).alias("shard"),
        s["jump"].alias("grown"),
    )
    return F.when(s["jump"] <= shards, noted).otherwise(s)


def jump_hash(key: Column, shards: int = SHARDS) -> Column:
    """``struct(shard, grown)``: the shard of a key among ``shards`` and among one more.

    About ``ln(shards)`` jumps are made. The first steps are one fold that nearly every key ends in; a
    key that has not passed the last shard by then goes on, at most to one jump per shard.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    digest = F.md5(_text(key))
    zero = F.lit(0).cast("long")
    start = F.struct(
        _hex(digest, 1, 6).alias("k2"),
        _hex(digest, 7, 5).alias("k1"),
        _hex(digest, 12, 5).alias("k0"),
        zero.alias("jump"),
        zero.alias("shard"),
        zero.alias("grown"),
    )

    def step(s: Column, _: Column) -> Column:
        ahead = F.struct(
            *[c.alias(k) for c, k in zip(_advance(s), ("k2", "k1", "k0"))],
            *[s[k].alias(k) for k in ("jump", "shard", "grown")],
        )
        # the draw reads the advanced state, so that is bound first
        return F.element_at(F.transform(F.array(ahead), lambda t: _jump(t, shards)), 1)

    def fold(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, step)

    most = shards + 1
    first = min(most, 16 + 4 * math.ceil(math.log(most)))
    ended = fold(start, first)
    if first < most:
        ended = F.element_at(
            F.transform(
                F.array(ended),
                lambda s: F.when(s["jump"] > shards, s).otherwise(fold(s, most - first)),
            ),
            1,
        )
    return F.element_at(
        F.transform(
            F.array(ended),
            lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")),
        ),
        1,
    )


def assign(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``shard`` and ``grown_shard``; nothing is shuffled."""
    clash = {"shard", "grown_shard"} & set(docs.columns)
    if clash:
        raise ValueError(f"the table already holds {sorted(clash)}")
    found = jump_hash(F.col(key), shards)
    return (
        docs.withColumn("_jump", found)
        .withColumns({"shard": F.col("_jump.shard"), "grown_shard": F.col("_jump.grown")})
        .drop("_jump")
    )


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, size, text_crc32)``: bytes of the text plus one, and its checksum."""
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("key"),
        (F.octet_length(value).cast("long") + 1).alias("size"),
        F.crc32(value).alias("text_crc32"),
    )


def number(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``(key, size, text_crc32, shard, slot, grown_shard)``, slots from 0 without gaps per shard."""
    content = ["key", "size", "text_crc32"]
    held = stable(measures(docs, key, text))
    slices = max(1, -(-held.count() // (shards * rows_per_slice)))
    draw = _hex(
        F.md5(F.concat_ws(":", F.lit("slot"), _text(F.col("key")), F.col("text_crc32"), F.col("size"))), 1, 13
    )
    kinds = stable(
        assign(held.groupBy(*content).agg(F.count(F.lit(1)).alias("copies")), "key", shards)
        .withColumn("draw", draw)
        .withColumn("slice", F.floor(F.col("draw") / float(16**13) * slices).cast("long"))
    )
    # one row per shard and slice meets in this window
    earlier = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        kinds.groupBy("shard", "slice")
        .agg(F.sum("copies").alias("rows"))
        .select("shard", "slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("begin"))
    )
    within = Window.partitionBy("shard", "slice").orderBy("draw", *content)
    last = F.sum("copies").over(within.rowsBetween(Window.unboundedPreceding, 0))
    placed = kinds.withColumn("last", last).join(broadcast_if_small(begins), ["shard", "slice"])
    first = F.col("begin") + F.col("last") - F.col("copies")
    return placed.select(
        *content,
        "shard",
        "grown_shard",
        F.explode(F.sequence(first, F.col("begin") + F.col("last") - 1)).alias("slot"),
    )


def write_shards(
    docs: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS, append: bool = False
) -> None:
    """Write whole rows below ``path/shard=<n>``; a large shard is written by several tasks."""
    placed = assign(docs, key, shards).drop("grown_shard").hint("rebalance", "shard")
    placed.write.mode("append" if append else "errorifexists").partitionBy("shard").parquet(path)
