"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import filter_texts, map_texts, unit_hash

UNDETERMINED = "und"
_BUCKET_BITS = 15
BUCKETS = 1 << _BUCKET_BITS
DIMENSIONS = 16
_ORDERS = (2, 3, 4)
_BLANK = 32
# A byte of a word stays: an ASCII letter in lower case or a byte of a longer character.
_KEEP = np.array([b if chr(b).islower() and b < 128 or b >= 128 else _BLANK for b in range(256)],
                 dtype=np.uint32)


def subwords(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Start of each text in the joined bytes; per subword length its buckets and validity.

    Subwords are two to four bytes of a lower-cased word with one blank at its ends.
    """
    joined = b" ".join([*texts, b"   "])
    lengths = np.array([len(t) + 1 for t in texts])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    code = _KEEP[np.frombuffer(b" " + joined, dtype=np.uint8)]
    blank = code == _BLANK
    n = int(lengths.sum())
    gram = code[:n].copy()
    buckets, valid = [], []
    inner = np.ones(n, dtype=bool)
    for order in range(2, max(_ORDERS) + 1):
        gram = gram | (code[order - 1 : order - 1 + n] << np.uint32(8 * (order - 1)))
        if order == 2:
            ok = ~(blank[:n] & blank[1 : n + 1])
        else:
            inner = inner & ~blank[order - 2 : order - 2 + n]
            ok = inner
        mixed = (gram ^ np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
        buckets.append((mixed >> np.uint32(32 - _BUCKET_BITS)).astype(np.int32))
        valid.append(ok)
    return starts, buckets, valid


def _lowered(text: bytes | None) -> bytes:
    return (text or b"").decode("utf-8", "replace").lower().encode()


def _has_letter(text: bytes | None) -> bool:
    return any(map(str.isalpha, (text or b"").decode("utf-8", "replace")))


@dataclass(frozen=True)
class LanguageModel:
    """Learned languages, their evidence by bucket, temperature and least accepted score."""

    languages: list[str]
    evidence: np.ndarray  # one row of BUCKETS values for each language
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """Calibrated probabilities, one row for each text."""
        lowered = [_lowered(t) for t in texts]
        starts, buckets, valid = subwords(lowered)
        count = sum(np.add.reduceat(v, starts, dtype=np.int64) for v in valid)
        logits = np.empty((len(texts), len(self.languages)))
        for k, weights in enumerate(self.evidence):
            total = sum(np.where(v, weights[b], np.float32(0)) for b, v in zip(buckets, valid))
            logits[:, k] = np.add.reduceat(total, starts, dtype=np.float64) / np.maximum(count, 1)
        return _softmax((logits + self.bias) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _features(texts: list[bytes | None]) -> dict[str, list]:
    """Buckets and counts of each text, as the bytes of two arrays."""
    found = {"buckets": [], "counts": []}
    for text in texts:
        _, buckets, valid = subwords([_lowered(text)])
        counts = np.bincount(np.concatenate([b[v] for b, v in zip(buckets, valid)]), minlength=BUCKETS)
        used = np.flatnonzero(counts)
        found["buckets"].append(used.astype(np.uint16).tobytes())
        found["counts"].append(counts[used].astype(np.float32).tobytes())
    return found


def train_language_model(
    docs: DataFrame,
    learnable: Column | None = None,
    rows_by_language: int = 800,
    rows: int = 8000,
    epochs: int = 6,
    least_steps: int = 5_000,
    rate: float = 8.0,
    most_rejected: float = 0.0005,
    least_precision: float = 0.99,
    most_lost: float = 0.02,
) -> LanguageModel:
    """Fit on a sample of the rows of ``docs(doc_id, text, lang)`` with text and lang.

    The sample is drawn by a hash of doc_id: about ``rows_by_language`` whole texts of every
    language, ``rows`` in total, each as at most BUCKETS counts. Four fifths train
    the embeddings by stochastic gradient descent, in ``epochs`` passes or as many more as make
    ``least_steps`` steps, so that a small sample is learned as far as a large one; on the rest the temperature is fitted
    and the rejection calibrated: the threshold is the larger of the score below which
    ``most_rejected`` of correct predictions lie and the least score from which on the
    predictions reach ``least_precision``, but never above the score below which ``most_lost`` of correct
    predictions lie: wrong labels lower the measured precision at every score, and must not
    cost the good documents. Rows without lang or text are not learned from.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if learnable is not None:
        labelled = labelled.filter(learnable)
    # At most `rows` languages can have a row in the sample.
    counts = dict(labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect())
    each = min(rows_by_language, rows // max(1, len(counts)) or 1)
    if not counts:
        return LanguageModel([], np.zeros((0, BUCKETS), np.float32), np.zeros(0), 1.0, 1.0)
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    drawn = unit_hash(F.col("doc_id"), salt="language") < F.try_element_at(shares, F.col("lang"))
    sample = labelled.filter(drawn).withColumn("part", unit_hash(F.col("doc_id"), salt="calibrate"))
    taken = map_texts(
        sample, lambda: _features, "buckets binary, counts binary", ["lang", "part", "doc_id"]
    ).limit(2 * rows).collect()
    taken.sort(key=lambda r: (r.part, r.lang, r.doc_id or 0, r.buckets))
    languages = sorted(counts)
    data = [
        (np.frombuffer(r.buckets, np.uint16).astype(np.int64), np.frombuffer(r.counts, np.float32),
         languages.index(r.lang), r.part < 0.2)
        for r in taken
        if r.buckets
    ]
    train = [d[:3] for d in data if not d[3]] or [d[:3] for d in data]
    held = [d[:3] for d in data if d[3]] or train
    limits = (most_rejected, least_precision, most_lost)
    passes = max(epochs, -(-least_steps // max(1, len(train))))
    return _fit(languages, train, held, passes, rate, limits)


def _fit(languages, train, held, epochs, rate, limits) -> LanguageModel:
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    seen = np.zeros(BUCKETS, dtype=bool)
    steps, at = epochs * len(train), 0
    for _ in range(epochs):
        for k in rng.permutation(len(train)):
            used, counts, label = train[k]
            share = counts / counts.sum()
            mean = share @ vectors[used]
            error = _softmax((mean @ weights + bias)[None])[0].astype(np.float32)
            error[label] -= 1
            step = rate * (1 - at / steps)
            back = weights @ error
            weights -= step * 0.1 * np.outer(mean, error)
            bias -= step * 0.01 * error
            vectors[used] -= step * np.outer(share, back)
            seen[used] = True
            at += 1
    # What was never seen says nothing.
    vectors[~seen] = 0
    evidence = np.ascontiguousarray((vectors @ weights).T)
    logits = np.array([(c / c.sum()) @ evidence[:, u].T + bias for u, c, _ in held])
    labels = np.array([label for _, _, label in held])
    temperature = min(
        np.geomspace(0.05, 20, 121),
        key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).sum(),
    )
    chances = _softmax(logits / temperature)
    score, right = chances.max(axis=1), chances.argmax(axis=1) == labels
    threshold = least_score(score, right, 1 / len(languages), *limits)
    return LanguageModel(languages, evidence, bias, float(temperature), threshold)


def least_score(
    score: np.ndarray, right: np.ndarray, chance: float,
    most_rejected: float = 0.0005, least_precision: float = 0.99, most_lost: float = 0.02,
) -> float:
    """The least accepted score, from held-out predictions and whether they are right.

    Where no prediction is right nothing can be calibrated, and ``chance`` accepts every score.
    """
    if not right.any():
        return chance
    order = np.argsort(-score)
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= least_precision
    by_loss, most = np.quantile(score[right], [most_rejected, most_lost])
    # If precision holds over all predictions, the quantile decides.
    if precise[-1]:
        return float(min(by_loss, max(0.5, chance)))
    by_precision = score[order][np.flatnonzero(precise)[-1]] if precise.any() else 1.0
    return float(min(max(by_loss, by_precision), most))


def _predictor(model: LanguageModel):
    def predict(texts: list[bytes | None]) -> dict[str, list]:
        letters = [_has_letter(t) for t in texts]
        known = bool(model.languages)
        chances = model.scores(texts) if known else np.zeros((len(texts), 1))
        best, top = chances.argmax(axis=1), chances.max(axis=1)
        return {
            "lang_pred": [model.languages[b] if ok and known else UNDETERMINED
                          for b, ok in zip(best, letters)],
            "score": [float(s) if ok else 0.0 for s, ok in zip(top, letters)],
            "rejected": [not ok or not known or bool(s < model.threshold)
                         for s, ok in zip(top, letters)],
        }

    return predict


def identify(docs: DataFrame, model: LanguageModel, carry: list[str] | None = None) -> DataFrame:
    """Carried columns (doc_id) with lang_pred, score and rejected for every whole text.

    A text that is NULL or has no letter is ``und`` with score 0 and rejected; so is
    every text if no language was learned. Other texts get the likeliest learned language, and are
    rejected if its calibrated probability is below the model's threshold.
    """
    return map_texts(docs, lambda: _predictor(model),
                     "lang_pred string, score double, rejected boolean", carry)


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows, with all their columns, whose language is not rejected."""

    def accept(texts: list[bytes | None]) -> list[bool]:
        return [not r for r in _predictor(model)(texts)["rejected"]]

    return filter_texts(docs, lambda: accept)
