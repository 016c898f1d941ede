"""Exact duplicates by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.session import written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX = 256
_SLOTS = 1 << 20


def normalised(text: Column) -> Column:
    """The text with A to Z in lower case and nothing else changed; NULL is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def _repeated(keys: DataFrame, *names: str) -> Column:
    """A test whether a key may occur twice: never false for a repeated key.

    Repeated keys are marked in a bitmap of fixed size, 128 KB, whose words are at most
    16,384 rows. A crowded bitmap only lets more unique rows through to the next,
    exact step.
    """
    slot = F.pmod(F.xxhash64(*names), F.lit(_SLOTS))
    marks = (
        keys.groupBy(*names)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.shiftright(slot, 6).alias("word"), (slot % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        .collect()
    )
    words = np.zeros(_SLOTS // 64, dtype=np.int64)
    for row in marks:
        words[row.word] = row.bits
    word = F.get(F.lit(words), F.shiftright(slot, 6).cast("int"))
    shifted = F.call_function("shiftrightunsigned", word, (slot % 64).cast("int"))
    return shifted.bitwiseAND(F.lit(1).cast("bigint")) == 1


def exact_groups(docs: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """For every row of ``docs(doc_id, text)`` the row that stays of its equal texts.

    Returns doc_id, keep_id (largest doc_id of the group), group_size, kept and
    text_sha256, one row per input row. Texts are equal if they are after lower-casing A to Z;
    NULL and the empty text are equal. Of rows that repeat a doc_id exactly one is
    kept; a null doc_id sorts below all others. Other columns are ignored.

    Only lengths that occur twice have their prefix hashed, and only texts whose length
    and prefix occur twice take part in the grouping by the full hash. No text is
    shuffled. A group of any size is one row of partial counts per task.
    """
    text = normalised(F.col("text"))
    size = F.octet_length(F.coalesce("text", F.lit(""))).alias("size")
    # Lower-casing A to Z changes no length, so the prefix is cut before it.
    head = F.xxhash64(normalised(F.substring("text", 1, prefix))).alias("head")
    sized = docs.select(size)
    same_size = _repeated(sized, "size")
    same_head = _repeated(docs.select("text", size).filter(same_size).select("size", head),
                          "size", "head")
    rows = written(
        docs.select("doc_id", "text", size)
        .withColumn("head", F.when(same_size, head))
        .select(
            "doc_id",
            F.sha2(text, 256).alias("text_sha256"),
            (F.col("head").isNotNull() & same_head).alias("survives"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-rows",
    )
    groups = written(
        rows.filter("survives")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("keep"))
        .filter("n > 1"),
        "exact-groups",
    )
    single = F.col("n").isNull()
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
        (single | (F.col("row") == F.col("keep.row"))).alias("kept"),
        "text_sha256",
    )
