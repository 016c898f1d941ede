"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import numbered
from roadpulse.session import written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Preferences are rounded to sixteenths up to 64, so that a source has at most 1,024 of them.
_TASTE_STEPS, _TASTE_MOST = 16, 64
_HALVINGS = 52
_WORD = r"[^\x20\x09-\x0D]+"
_BINS = 4096
_DRAW_HEX = 13  # hexadecimal digits of a draw: 52 bits, exact in a double


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def draw(*parts: Column) -> Column:
    """A number in (0, 1) fixed by the parts, so that every run draws alike."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, _DRAW_HEX)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / F.lit(float(1 << (4 * _DRAW_HEX)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Sources with the words each is to give: source, source_size, target.

    Sources in code point order, NULL last, take the weights in turn. A target stops at
    ``most`` times its source and the excess is reshared by weight, until none is above.
    Every pass over the sources fixes at least one more of them, and few are ever needed.
    """
    ranked = numbered(sizes.withColumn("missing", F.col("source").isNull()), "place",
                      "missing", "source")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int"))
    sources = written(
        ranked.select("source", "source_size", weight.cast("bigint").alias("weight")), "sources"
    )
    wide = "decimal(38,0)"
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    left, shares, full = words, 0, F.lit(False)
    while True:
        open_weight, closed = sources.agg(
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(F.when(full, F.col("source_size") * most)), F.lit(0)),
        ).first()
        if (words - closed, open_weight) == (left, shares) or open_weight == 0:
            break
        left, shares = words - closed, open_weight
        full = F.col("source_size").cast(wide) * most * F.lit(shares).cast(wide) <= F.col(
            "weight"
        ).cast(wide) * F.lit(left).cast(wide)
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(shares or 1))
    cap = (F.col("source_size") * most).cast("double")
    return sources.select("source", "source_size", F.when(full, cap).otherwise(share).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    preference: str | None = None,
    size_steps: Sequence[tuple[int, float]] = (),
) -> DataFrame:
    """How many words of every row of ``docs(doc_id, source, text)`` the mix takes.

    Returns doc_id, source, size (words), source_size, target, copies and taken (copies times size),
    one row per input row. A source is to give ``target`` words. The whole part of target by
    source_size is given to each of its documents as certain copies; the rest p is the
    inclusion probability of one more. Documents are ranked by u/(1-u) divided by p/(1-p), u a hash
    of id and text, and taken in this order until the words left are reached, so that
    a source misses its target by half a document at most.

    A ``preference`` column of docs (1 is neutral, NULL too) makes probabilities unequal within a source, or
    ``size_steps``: (500, 4.0) gives documents of at least 500 words a preference of 4, later steps
    before earlier ones. A document's probability is then 1-(1-q)^preference, with the q of its source
    at which the expected words are the words left. Preferences count to a sixteenth, from a sixteenth to 64.

    NULL text has no words; NULL sources are one source. Equal rows draw alike. The order is
    cut by a histogram of ranks; only the rows of a source's last bin are sorted.
    """
    taste = F.coalesce(F.col(preference).cast("double"), F.lit(1.0)) if preference else F.lit(1.0)
    unequal = preference is not None or len(size_steps) > 0
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        draw(identity, F.md5(F.coalesce("text", F.lit("")))).alias("u"),
        F.xxhash64("text").alias("text_hash"),
        taste.alias("taste"),
    )
    if unequal:
        given = F.col("taste")
        for least, value in size_steps:
            given = F.when(F.col("size") >= least, F.lit(float(value))).otherwise(given)
        bounded = F.least(F.greatest(F.round(given * _TASTE_STEPS), F.lit(1.0)), F.lit(float(_TASTE_MOST * _TASTE_STEPS)))
        sized = sized.withColumn("taste", bounded / _TASTE_STEPS)
    rows = written(sized, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ratio = F.col("target") / F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0).cast("bigint")
    targets = written(
        source_targets(sizes, weights, most)
        .withColumn("whole", whole)
        .withColumn("words_left", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("p", F.when(F.col("source_size") > 0, ratio - F.col("whole")).otherwise(0.0)),
        "mix-targets",
    )
    if unequal:
        targets = written(_calibrated(rows, targets), "mix-calibrated")
    ranked = _ranked(rows, targets)
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    ends = bins.selectExpr(
        "source", "bin", "sum(words) over (partition by source order by bin) - words as before",
        "words",
    )
    # The last bin of which anything can be taken.
    cut = written(
        ends.join(targets.select(F.col("source").alias("s"), "words_left"),
                  F.col("source").eqNullSafe(F.col("s")))
        .filter("before < words_left")
        .groupBy("source")
        .agg(F.max("bin").alias("cut_bin"), F.max("before").alias("before")),
        "mix-cuts",
    )
    plan = written(
        targets.join(cut.withColumnRenamed("source", "s"),
                     F.col("source").eqNullSafe(F.col("s")), "left").drop("s"),
        "mix-plan",
    )
    joined = _ranked(rows, plan)
    edge = F.col("bin") == F.col("cut_bin")
    sure = joined.filter(~F.coalesce(edge, F.lit(False))).withColumn(
        "extra", F.coalesce(F.col("bin") < F.col("cut_bin"), F.lit(False))
    )
    running = F.expr(
        "before + sum(size) over (partition by source order by z, doc_id, size"
        " rows unbounded preceding)"
    )
    last = joined.filter(edge).withColumn("ends", running).withColumn(
        "extra", 2 * F.col("ends") - F.col("size") <= 2 * F.col("words_left")
    ).drop("ends")
    copies = F.col("whole") + F.col("extra").cast("bigint")
    return sure.unionByName(last).select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _calibrated(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with ``p`` replaced by the q at which preferences give the words left, found by halving.

    A source's words by preference are one short list (see ``_TASTE_STEPS``), added up before any shuffle.
    """
    tastes = rows.groupBy("source", "taste").agg(F.sum("size").alias("words"))
    lists = tastes.groupBy(F.col("source").alias("s")).agg(
        F.sort_array(F.collect_list(F.struct("taste", "words"))).alias("tastes")
    )

    def expected(q: Column) -> Column:
        return F.aggregate(
            "tastes", F.lit(0.0), lambda total, t: total + t["words"] * (1 - F.pow(1 - q, t["taste"]))
        )

    def halve(at: Column, _: Column) -> Column:
        middle = (at["low"] + at["high"]) / 2
        short = expected(middle) < F.col("words_left")
        return F.struct(
            F.when(short, middle).otherwise(at["low"]).alias("low"),
            F.when(short, at["high"]).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(_HALVINGS)), start, halve, lambda at: at["high"])
    joined = targets.join(lists, F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.withColumn("p", F.when(F.col("p") > 0, found).otherwise(0.0)).drop("s", "tastes")


def repeat_mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """The rows, with all their columns, each as often as the mix takes it.

    Rows that repeat both doc_id and text are one document here: each of its copies is a row.
    """
    names = docs.columns
    text_hash = F.xxhash64("text").alias("_hash")
    copies = written(
        mix_sources(docs, weights, most)
        .groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"))
        .agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
        .filter("_copies > 0"),
        "mix-copies",
    )
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, source, text = (F.col(f"c{names.index(n)}") for n in ("doc_id", "source", "text"))
    matched = rows.join(
        copies,
        doc_id.eqNullSafe(F.col("_id")) & source.eqNullSafe(F.col("_source"))
        & (F.xxhash64(text) == F.col("_hash")),
    )
    # Equal rows share their copies evenly; the first of them take what is over.
    order = Window.partitionBy("_id", "_source", "_hash").orderBy(F.lit(0))
    place = F.when(F.col("_rows") > 1, F.row_number().over(order) - 1).otherwise(0)
    times = F.floor(F.col("_copies") / F.col("_rows")).cast("int") + (
        F.col("_place") < F.col("_copies") % F.col("_rows")
    ).cast("int")
    dealt = matched.withColumn("_place", place).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), times))
    )
    return dealt.filter("_copy > 0").drop("_id", "_source", "_hash", "_copies", "_rows", "_place", "_copy").toDF(*names)


def _ranked(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with what their source is to give and their rank ``z``, which grows with the odds ratio."""
    here = targets.withColumnRenamed("source", "s")
    p = 1 - F.pow(1 - F.col("p"), F.col("taste"))
    mine, others = F.col("u") * (1 - p), (1 - F.col("u")) * p
    z = F.coalesce(F.try_divide(mine, mine + others), F.lit(1.0))
    bins = F.least(F.floor(z * _BINS), F.lit(_BINS - 1)).cast("int")
    return (
        rows.join(here, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("z", z)
        .withColumn("bin", bins)
    )
