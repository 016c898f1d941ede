"""Secrets: fixed patterns, and Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import unit_hash
from roadpulse.session import written

# The base patterns, and how long a value, key or run must be.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIZE = len(ALPHABET)
# What random strings are drawn from, the smaller first: hexadecimal, base 32, capitals, small letters, base 62, all.
ALPHABETS = ("0-9a-f", "0-9A-F", "A-Z2-7", "A-Z0-9", "a-z0-9", "A-Za-z0-9", "A-Za-z0-9+/_=-")
_UNIFORM = 20.0  # samples of each pair that a uniform model counts as
_CAPITALS = 0.05
_TOKEN = r"[A-Za-z0-9+/_=-]"
CANDIDATE_LENGTH = 20
_IDENTIFIER_LENGTH = 8
_JUDGED_LENGTH = 12  # of tokens whose evidence sets the limits
_RECURRING = 5  # tokens seen so often are ordinary words
_LOOKS_RANDOM = math.log(10.0)
_BLOCK = 64
_SPANS = "array<struct<start:bigint,stop:bigint,kind:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _located(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches as structs of stop, width and the group's text.

    The text between matches and the matches alternate, so a match ends at the sum of the
    lengths so far. Sums are taken by blocks, which keeps many matches cheap.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    steps = F.transform(
        F.filter(parts, lambda p: p["whole"].isNotNull()),
        lambda p: F.struct(
            (F.length(p["gap"]) + F.length(p["whole"])).cast("bigint").alias("step"),
            F.length(p["whole"]).cast("bigint").alias("width"),
            p["value"].alias("value"),
        ),
    )

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0).cast("bigint"), lambda s, p: s + p["step"])

    def stops(items: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.size(items) - 1, F.lit(_BLOCK)),
            lambda b: total(F.slice(items, b + 1, F.lit(_BLOCK))),
        )
        before = F.aggregate(
            blocks,
            F.array(F.lit(0).cast("bigint")),
            lambda sums, b: F.concat(sums, F.array(F.element_at(sums, -1) + b)),
        )
        return _let(
            before,
            lambda sums: F.transform(
                items,
                lambda p, i: F.struct(
                    (
                        F.get(sums, F.floor(i / _BLOCK).cast("int"))
                        + total(F.slice(items, i - i % _BLOCK + 1, i % _BLOCK + 1))
                    ).alias("stop"),
                    p["width"].alias("width"),
                    p["value"].alias("value"),
                ),
            ),
        )

    return _let(steps, lambda items: F.when(F.size(items) > 0, stops(items)))


def _spans(text: Column, pattern: str, kind: str, accept, group: int = 0) -> Column:
    """Spans of the accepted matches; most texts have none and are only searched once."""

    def span(m: Column) -> Column:
        return F.struct(
            (m["stop"] - m["width"]).alias("start"), m["stop"].alias("stop"),
            F.lit(KINDS.index(kind)).alias("kind"),
        )

    matches = F.coalesce(_located(text, pattern, group), F.lit(None))
    found = F.transform(F.filter(matches, lambda m: accept(m["value"])), span)
    return F.coalesce(F.when(text.rlike(pattern), found), F.array()).cast(_SPANS)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start and kind. Each kind is leftmost and non-overlapping.

    Runs that are too short are never part of a longer one, so lengths of access keys and
    hexadecimal runs are in the pattern; an assignment's short value still uses up its match.
    """
    return F.array_sort(
        F.concat(
            _spans(text, ASSIGN, "assign", lambda v: F.length(v) >= ASSIGN_VALUE, 1),
            _spans(text, ACCESS, "access", lambda v: F.lit(True)),
            _spans(text, HEX, "hex", lambda v: F.lit(True)),
        )
    )


def _alphabet(token: Column) -> Column:
    """Number of the smallest of ALPHABETS that has all characters of a token."""
    found = F
    for at, letters in enumerate(ALPHABETS[:-1]):
        found = found.when(token.rlike(f"^[{letters}]*$"), at)
    return found.otherwise(len(ALPHABETS) - 1)


def _characters(token: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the characters of a token, cut once, however long it is."""
    return _let(F.split(token, ""), body)


def _numbers(values: np.ndarray) -> Column:
    """A constant array; one text for the driver to hand over."""
    return F.split(F.lit(",".join(f"{v:.5g}" for v in values.ravel())), ",").cast("array<double>")


@dataclass(frozen=True)
class SecretModel:
    """Log-likelihood ratios of character pairs by alphabet, and the least mean and total of a secret."""

    ratios: np.ndarray
    least_mean: float
    least_total: float

    def evidence(self, token: Column) -> Column:
        """Log-likelihood ratio of a token: random string of its alphabet against ordinary identifier."""
        codes = np.zeros(128, dtype=np.int32)
        for at, letter in enumerate(ALPHABET):
            codes[ord(letter)] = at
        code, ratios = F.lit(codes), _numbers(self.ratios)

        def total(state: Column) -> Column:
            def pair(i: Column) -> Column:
                place = F.get(state["codes"], i - 1) * _SIZE + F.get(state["codes"], i)
                return F.get(ratios, state["first"] + place)

            return F.aggregate(
                F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda sum_, i: sum_ + pair(i)
            )

        def read(characters: Column) -> Column:
            return F.struct(
                F.transform(characters, lambda c: F.get(code, F.ascii(c))).alias("codes"),
                (_alphabet(token) * (_SIZE * _SIZE)).alias("first"),
            )

        return _characters(token, lambda characters: _let(read(characters), total))

    def is_secret(self, token: Column) -> Column:
        return _let(
            self.evidence(token),
            lambda e: (e >= self.least_total) & (e / (F.length(token) - 1) >= self.least_mean),
        )


def labelled_tokens(docs: DataFrame, rows: int = 20_000) -> DataFrame:
    """Tokens with a label: values the base patterns find, and identifiers outside them.

    Drawn from about ``rows`` whole texts, by a hash of doc_id.
    """
    n = docs.count()
    sample = docs.filter(unit_hash(F.col("doc_id"), salt="secrets") < F.lit(min(1.0, rows / max(n, 1))))
    text = F.coalesce("text", F.lit(""))
    values = F.concat(
        F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)),
                 lambda v: F.length(v) >= ASSIGN_VALUE),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    plain = text
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    identifiers = F.regexp_extract_all(
        plain, F.lit(_TOKEN + "{" + str(_IDENTIFIER_LENGTH) + ",}"), F.lit(0)
    )
    return sample.select(F.explode(values).alias("token"), F.lit(True).alias("secret")).union(
        sample.select(F.explode(identifiers), F.lit(False))
    )


def train_secret_model(samples: DataFrame, most_false: float = 1e-4) -> SecretModel:
    """Fit both Markov models on ``samples(token, secret)``.

    The collected counts are at most one for each pair of characters, alphabet and label. The random model of an
    alphabet starts uniform, as strings drawn from it are, and labelled secrets move it.

    Ordinary samples hold every random string the base patterns miss. So a first ordinary model is fitted on
    tokens that recur, and then twice on all but those the model before finds likelier random; these
    set no limit either. A secret's mean evidence must exceed that of all but ``most_false`` of the ordinary
    samples. Labelled secrets shape the random models alone, so alphabets that none of them shows are found as well.
    """
    tokens = written(
        samples.filter(F.length("token") > 1).groupBy("secret", "token").agg(F.count("*").alias("n")),
        "secret-samples",
    )
    judged = F.length("token") >= F.lit(_JUDGED_LENGTH)
    recurring = F.col("secret") | (F.col("n") >= _RECURRING)
    model = _fit(tokens.filter(recurring)) if tokens.filter(~F.col("secret") & recurring).head(1) else _fit(tokens)
    for _ in range(2):
        random = ~F.col("secret") & judged & (model.evidence(F.col("token")) >= _LOOKS_RANDOM)
        ordinary = tokens.filter(~random)
        model = _fit(ordinary)
    mean = model.evidence(F.col("token")) / (F.length("token") - 1)
    highest = ordinary.filter(judged & ~F.col("secret")).agg(
        F.percentile(mean, F.lit(1 - most_false), F.col("n"))
    ).first()[0]
    return SecretModel(model.ratios, max(0.0, highest or 0.0), model.least_total)


def _fit(tokens: DataFrame) -> SecretModel:
    """Ratios of the Markov models of ``tokens(token, secret, n)``, one random model for each alphabet."""
    pairs = _characters(
        F.col("token"),
        lambda characters: F.transform(
            F.sequence(F.lit(1), F.length("token") - 1),
            lambda i: F.concat(F.get(characters, i - 1), F.get(characters, i)),
        ),
    )
    random, plain = np.zeros((len(ALPHABETS), _SIZE, _SIZE)), np.zeros((_SIZE, _SIZE))
    place = {letter: at for at, letter in enumerate(ALPHABET)}
    kind = F.when(F.col("secret"), _alphabet(F.col("token")))
    # A secret that many documents share is one draw.
    times = F.when(F.col("secret"), F.lit(1)).otherwise(F.col("n"))
    for row in (
        tokens.select(kind.alias("kind"), times.alias("n"), F.explode(pairs).alias("pair"))
        .filter(F.col("pair").rlike(f"^{_TOKEN}{{2}}$"))
        .groupBy("kind", "pair").agg(F.sum("n").alias("times")).collect()
    ):
        first, second = row.pair
        if row.kind is not None:
            random[row.kind, place[first], place[second]] += row.times
            continue
        plain[place[first], place[second]] += row.times
        # Ordinary words are ordinary in capitals too, alone or as a first letter.
        for other in {row.pair.upper(), row.pair.capitalize()} - {row.pair}:
            plain[place[other[0]], place[other[1]]] += _CAPITALS * row.times
    plain = (plain + 0.01) / (plain + 0.01).sum(axis=1, keepdims=True)
    # One character over and over is a ruler or a filler, not a secret.
    plain = 0.7 * plain + 0.1 * np.eye(_SIZE) + 0.2 / _SIZE
    for at, letters in enumerate(ALPHABETS):
        inside = np.array([re.match(f"[{letters}]", c) is not None for c in ALPHABET])
        weight = _UNIFORM * inside
        random[at] = (random[at] + weight) / (random[at] + weight).sum(axis=1, keepdims=True)
        random[at][~np.outer(inside, inside)] = 1.0  # never looked up
    ratios = np.log(random) - np.log(plain)
    return SecretModel(ratios, 0.0, math.log(1e4 * len(ALPHABETS)))


def find_secrets(docs: DataFrame, model: SecretModel, carry: list[str] | None = None) -> DataFrame:
    """Carried columns (doc_id) with ``spans`` of every whole text: start, stop (exclusive), kind.

    Offsets count characters; ``kind`` is a place in KINDS; spans are ordered by start and kind. To the
    base spans the models add tokens of 20 characters or more that touch no base span and are
    likelier random than ordinary. NULL texts are empty; time is linear in a token's length. Everything is one narrow stage.
    """
    text = F.coalesce("text", F.lit(""))
    candidate = _TOKEN + "{" + str(CANDIDATE_LENGTH) + ",}"
    added = _spans(text, candidate, "random", model.is_secret)

    def combined(base: Column) -> Column:
        apart = F.filter(
            added,
            lambda c: ~F.exists(base, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])),
        )
        return F.array_sort(F.concat(base, apart))

    columns = [c for c in (carry or ["doc_id"]) if c != "spans"]
    return docs.select(*columns, _let(base_spans(text), combined).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of the spans in order, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])
        ),
        ",",
    )
