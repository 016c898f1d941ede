"""Quality by compression: zstandard dictionaries of good and of bad text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import map_texts, unit_hash

PIECE = 256
DICTIONARY = 64 * 1024
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """A dictionary for each label and the logistic that turns a difference into a score."""

    good: bytes
    bad: bytes
    slope: float
    offset: float


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_AUTO)
    content.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def differences(good: bytes, bad: bytes):
    """A function from texts to their normalised difference of compressed sizes.

    A text is compressed in pieces, so that a dictionary counts as much at the end of a
    long text as at its start. Positive: the good dictionary fits better.
    """
    compressors = _compressor(good), _compressor(bad)

    def measure(texts: list[bytes | None]) -> list[float]:
        found = []
        for text in texts:
            cut = [text[at : at + PIECE] for at in range(0, len(text or b""), PIECE)]
            by_good, by_bad = (sum(len(c.compress(p)) for p in cut) for c in compressors)
            found.append((by_bad - by_good) / max(1, len(text or b"")))
        return found

    return measure


def _dictionary(texts: list[bytes]) -> bytes:
    parts = [t[at : at + PIECE] for t in texts for at in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        return (b"\n".join(texts)[-DICTIONARY:]).rjust(8, b" ")


def _spread_pieces(texts: list[bytes | None], most: int = 64) -> list[bytes]:
    """At most ``most`` pieces of each text, evenly spaced over all of it."""
    found = []
    for text in texts:
        cuts = range(0, len(text or b""), PIECE)
        chosen = sorted({cuts[round(k * (len(cuts) - 1) / (most - 1))] for k in range(most)}) if cuts else []
        found.append(b"".join(text[at : at + PIECE] for at in chosen))
    return found


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic, by Newton's method."""
    scale = x.std() or 1.0
    design = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-design @ beta))
        slope = design.T @ (y - chance) - ridge * beta
        curve = (design * (chance * (1 - chance))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def train_quality_model(
    docs: DataFrame, labels: DataFrame, learnable: Column | None = None, rows_by_label: int = 1500
) -> QualityModel:
    """Fit on labelled rows: ``docs(doc_id, text)`` with ``labels(doc_id, quality)``.

    The sample is drawn by a hash of doc_id: about ``rows_by_label`` rows with quality 1 and as many with
    quality 0, of which at most 64 evenly spaced pieces build a
    dictionary. A quarter of the sample is kept out of the dictionaries and measured as
    whole texts: on it the logistic is fitted, weighted back to the labels' own shares.
    If a label has no rows every text scores the share of label 1 (0.5 without labels). Other columns are ignored.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    if learnable is not None:
        known = known.filter(learnable)
    counts = dict(known.groupBy("quality").count().collect())
    good, bad = counts.get(1, 0), counts.get(0, 0)
    share = good / (good + bad) if good + bad else 0.5
    constant = QualityModel(b"", b"", 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    if not good or not bad:
        return constant
    fraction = F.when(F.col("quality") == 1, rows_by_label / good).otherwise(rows_by_label / bad)
    chosen = known.filter(unit_hash(F.col("doc_id"), salt="quality") < fraction).select(
        "doc_id", "quality"
    ).limit(3 * rows_by_label)
    sample = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    part = unit_hash(F.col("doc_id"), salt="calibrate") < 0.25
    build = map_texts(sample.filter(~part), lambda: lambda t: {"pieces": _spread_pieces(t)},
                      "pieces binary", ["quality", "doc_id"]).limit(3 * rows_by_label).collect()
    build.sort(key=lambda r: (r.doc_id, r.pieces))
    if {r.quality for r in build} != {0, 1}:
        return constant
    texts = {label: [bytes(r.pieces) for r in build if r.quality == label] for label in (0, 1)}
    dictionaries = _dictionary(texts[1]), _dictionary(texts[0])

    def measure():
        function = differences(*dictionaries)
        return lambda t: {"difference": function(t)}

    rest = map_texts(sample.filter(part), measure, "difference double", ["quality"]).collect()
    x = np.array([r.difference for r in rest] or [0.0])
    y = np.array([float(r.quality) for r in rest] or [share])
    slope, offset = _logistic(x, y) if len(set(y)) > 1 else (0.0, 0.0)
    # The sample is balanced as far as the labels allow; move to their own odds.
    odds = (np.mean(y) + 1e-6) / (1 - np.mean(y) + 1e-6)
    return QualityModel(*dictionaries, slope, offset + constant.offset - float(np.log(odds)))


def score_quality(docs: DataFrame, model: QualityModel, carry: list[str] | None = None) -> DataFrame:
    """Carried columns (doc_id) with difference and score for every whole text.

    ``score`` is the calibrated chance of label 1. NULL and empty texts have difference 0 and the
    score that belongs to it.
    """

    def make():
        measure = differences(model.good, model.bad) if model.good else lambda t: [0.0] * len(t)

        def score(texts: list[bytes | None]) -> dict[str, list]:
            found = measure(texts)
            return {
                "difference": found,
                "score": [1 / (1 + float(np.exp(-np.clip(model.slope * d + model.offset, -700, 700))))
                          for d in found],
            }

        return score

    return map_texts(docs, make, "difference double, score double", carry)
