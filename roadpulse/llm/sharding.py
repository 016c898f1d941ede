"""Sharding by jump consistent hashing, without a ring table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.session import written

# The generator of the published jump hash.
_MULTIPLIER = "2862933555777941757"
_TWO_64 = "18446744073709551616"
_TWO_33 = "8589934592"
_TWO_31 = float(1 << 31)
# Most rows of the table of part sizes that is broadcast.
_PARTS = 1 << 14
_STEPS = 12


def _steps(state: Column, shards: int, steps: int) -> Column:
    """Jump ``steps`` times, or until the jump leaves the shards."""

    def jump(at: Column, _: Column) -> Column:
        product = at["seed"] * F.lit(_MULTIPLIER).cast("decimal(19,0)") + 1
        seed = F.pmod(product, F.lit(_TWO_64).cast("decimal(20,0)")).cast("decimal(20,0)")
        drawn = F.floor(seed / F.lit(_TWO_33).cast("decimal(20,0)")).cast("double") + 1
        ahead = F.floor((at["next"] + 1).cast("double") * (F.lit(_TWO_31) / drawn))
        moved = F.struct(
            seed.alias("seed"), at["next"].alias("shard"), ahead.cast("bigint").alias("next")
        )
        return F.when(at["next"] < shards, moved).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, jump)


def jump_state(key: Column, shards: int) -> Column:
    """The jumps of a 64-bit key: ``shard``, and ``next``, where it would jump on to.

    Few keys need more than a dozen jumps; those that do go on as long as any key can.
    """
    unsigned = key.cast("decimal(20,0)") + F.when(
        key < 0, F.lit(_TWO_64).cast("decimal(20,0)")
    ).otherwise(F.lit(0).cast("decimal(20,0)"))
    start = F.struct(
        unsigned.cast("decimal(20,0)").alias("seed"),
        F.lit(-1).cast("bigint").alias("shard"),
        F.lit(0).cast("bigint").alias("next"),
    )
    first = _steps(start, shards, _STEPS)
    if shards <= _STEPS:
        return first
    return F.when(first["next"] < shards, _steps(first, shards, shards)).otherwise(first)


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with its shard and its slot in the shard.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law (``key``), shard,
    slot (gapless from 0 in each shard) and grown_shard, the shard among one more.
    The shard depends on doc_id and the number of shards alone. A NULL text has no bytes and
    checksum 0; null ids share a shard. Rows that agree in id, size and checksum
    take neighbouring slots. Other columns are ignored.

    Slots are counted in parts of a shard by a hash of the row, so no task orders a
    whole shard; equal rows are counted before they are shuffled.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint")
        .alias("text_crc32"),
    )
    jumped = jump_state(F.xxhash64("doc_id"), shards)
    part = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(max(1, _PARTS // shards)))
    counted = written(
        rows.groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("n"))
        .withColumn("jumped", jumped)
        .select(
            "doc_id", "size", "text_crc32", "n",
            F.col("jumped.shard").cast("int").alias("shard"),
            F.when(F.col("jumped.next") == shards, F.lit(shards))
            .otherwise(F.col("jumped.shard")).cast("int").alias("grown_shard"),
            part.alias("part"),
        ),
        "shard-rows",
    )
    # One row for each part of a shard: at most _PARTS, or one for each shard.
    sizes = counted.groupBy("shard", "part").agg(F.sum("n").alias("part_size"))
    before = sizes.selectExpr(
        "shard", "part",
        "sum(part_size) over (partition by shard order by part) - part_size as before",
    )
    before = F.broadcast(before) if shards <= _PARTS else before
    placed = counted.join(before, ["shard", "part"]).withColumn(
        "last",
        F.expr(
            "before + sum(n) over (partition by shard, part order by doc_id, size, text_crc32)"
        ),
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(F.col("last") - F.col("n"), F.col("last") - 1)).alias("slot"),
        "grown_shard",
    )
