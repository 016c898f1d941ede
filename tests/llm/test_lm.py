"""Language model scores against a plain model of the same corpus."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import lm
from roadpulse.llm.common import unit_hash
from roadpulse.llm.lm import HELD_SHARE, count_ngrams, lm_scores, train_interpolation

END = "</s>"


def corpus(n: int):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [
        (i, " ".join(vocabulary[int(draw.paretovariate(0.6)) % 300] for _ in range(draw.randrange(60))))
        for i in range(n)
    ]
    return rows + [(n, None), (n + 1, ""), (n + 2, "Wholly NEW words"), (2, rows[2][1])]


def plain(rows, learnt, held):
    """Score by row: exact counts, and weights from every single held-out token."""
    texts = [[END, *(t or "").lower().split(), END] for _, t in rows]

    def count(which):
        word, pair = Counter(), Counter()
        for ok, t in zip(which, texts):
            if ok:
                word.update(t[1:])
                pair.update(zip(t, t[1:]))
        return word, pair

    def estimates(word, pair, a, b):
        return [
            pair[a, b] / max(word[a], 1), word[b] / max(sum(word.values()), 1), 1 / (len(word) + 1)
        ], (int(math.log2(word[a])) + 1 if word[a] else 0)

    open_counts = count([a and not b for a, b in zip(learnt, held)])
    events = defaultdict(list)
    for ok, t in zip(held, texts):
        for a, b in zip(t, t[1:]) if ok else ():
            e, k = estimates(*open_counts, a, b)
            events[k].append(e)

    def maximise(rows, start, pull):
        w = list(start)
        for _ in range(100 if rows else 0):
            new = [pull * s for s in start]
            for e in rows:
                total = sum(x * y for x, y in zip(e, w))
                new = [n + x * y / total for n, x, y in zip(new, e, w)]
            w = [n / sum(new) for n in new]
        return w

    shared = maximise([e for es in events.values() for e in es], [1 / 3] * 3, 1e-3)
    weights = defaultdict(lambda: shared, {k: maximise(es, shared, 5.0) for k, es in events.items()})
    zero = weights[0][1:]
    weights[0] = [0, *(z / sum(zero) for z in zero)]
    full = count(learnt)
    scores = []
    for t in texts:
        total = 0.0
        for a, b in zip(t, t[1:]):
            e, k = estimates(*full, a, b)
            total += math.log10(sum(x * y for x, y in zip(e, weights[k])))
        scores.append(total)
    return scores, events


@pytest.mark.parametrize("block_bytes", [lm.BLOCK_BYTES, 4000])
def test_scores_match_a_plain_model(spark, monkeypatch, block_bytes):
    """Also with the corpus in many blocks and the keys in many parts."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lm, "PART_BYTES", block_bytes)
    rows = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    flags = {
        r.doc_id: (r.learnt, r.held)
        for r in docs.select(
            "doc_id", (F.col("doc_id") % 7 != 0).alias("learnt"),
            (unit_hash(F.col("doc_id"), salt="deleted") < HELD_SHARE).alias("held"),
        ).collect()
    }
    learnt = [flags[i][0] for i, _ in rows]
    held = [flags[i][0] and flags[i][1] for i, _ in rows]
    wanted, _ = plain(rows, learnt, held)
    scores, model = lm_scores(docs, F.col("doc_id") % 7 != 0)
    found = sorted((r.doc_id, r.score) for r in scores.collect())
    assert model.tokens == sum(len((t or "").split()) + 1 for (_, t), ok in zip(rows, learnt) if ok)
    for (doc_id, score), (other, exact) in zip(found, sorted((i, s) for (i, _), s in zip(rows, wanted))):
        assert doc_id == other
        assert score == pytest.approx(exact, rel=2e-3)


def test_every_held_out_token_counts(spark, monkeypatch):
    """The events that set the weights grow with the input; there is no bound on documents or positions."""
    seen = []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda b, n, e: seen.append(int(n.sum())) or learn(b, n, e))
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit(True).alias("learn"), F.expr("repeat('a b c ', 500)").alias("text")
    )
    train_interpolation(count_ngrams(docs))
    held = docs.filter(unit_hash(F.col("doc_id"), salt="deleted") < HELD_SHARE).count()
    assert seen == [held * 1501]
