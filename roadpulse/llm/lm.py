"""Language model scoring by deleted interpolation of word n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import pieces, unit_hash
from roadpulse.session import shuffles_removed, written

BLOCK_BYTES = 18_000_000  # text of one block
PART_BYTES = 24_000_000  # text whose n-grams one part counts: about as many keys as a tenth of it
HELD_SHARE = 0.1  # of the learnable texts, at every size of the input
_BUCKETS = 65
_BINS = 4  # of an octave, for the estimates of held-out tokens
_ADDED = 0.1  # of the base score

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANKS = np.zeros(256, dtype=bool)
_BLANKS[[9, 10, 11, 12, 13, 32]] = True


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix)."""
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_END = _mixed(np.array([1], dtype=np.uint64))[0]


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_INVERSE = pow(int(_BASE), -1, 1 << 64)
_ROOM = 1 << 21
_UP, _DOWN = _powers(_ROOM, int(_BASE)), _powers(_ROOM, _INVERSE)


def _word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, from sums of byte values times powers, and where words start."""
    raw = np.frombuffer(joined, np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_BLANKS[raw]
    edges = np.diff(inside)
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = (_UP, _DOWN) if len(raw) <= _ROOM else (
        _powers(len(raw), int(_BASE)), _powers(len(raw), _INVERSE))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    return _mixed((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64)), starts


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts in order, each text followed by the end token; tokens by text."""
    found, sizes = [], np.zeros(len(texts), dtype=np.int64)
    waiting, held = [], 0

    def flush() -> None:
        nonlocal waiting, held
        if not waiting:
            return
        joined = b" ".join(part for _, part in waiting)
        hashes, starts = _word_hashes(joined)
        bounds = np.cumsum([len(part) + 1 for _, part in waiting])
        counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
        np.add.at(sizes, [at for at, _ in waiting], counts)
        found.append(hashes)
        waiting, held = [], 0

    for at, text in enumerate(texts):
        for part in pieces((text or b"").lower()):
            if held + len(part) >= _ROOM - len(waiting) - 2:
                flush()
            waiting.append((at, part))
            held += len(part) + 1
    flush()
    words = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
    return np.insert(words, np.cumsum(sizes), _END), sizes + 1


def ngram_keys(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every token alone and of every token after the one before it in its text.

    The first token of a text follows the end token: as many texts begin as end.
    """
    before = np.roll(words, 1)
    before[np.cumsum(sizes) - sizes] = _END
    return words, _mixed(before * np.uint64(0xC2B2AE3D27D4EB4F) + (words ^ _BASE))


def bucket(contexts: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0 if unseen, then by powers of two."""
    return np.where(contexts > 0, 1 + np.log2(np.maximum(contexts, 1)).astype(np.int64), 0)


@dataclass(frozen=True)
class Interpolation:
    """Weights of bigram, unigram and uniform estimates by bucket, and what they need."""

    weights: np.ndarray
    tokens: int
    types: int

    def chances(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        estimates = _estimates(pair, context, word, self.tokens, self.types)
        return (self.weights[bucket(context)] * estimates).sum(axis=1)


def _estimates(pair, context, word, n_tokens: int, n_types: int) -> np.ndarray:
    """Maximum-likelihood estimates of order two, one and none, as columns."""
    return np.column_stack(
        [pair / np.maximum(context, 1), word / max(n_tokens, 1), np.full(len(word), 1 / (n_types + 1))]
    )


def cell(pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Number of the cell of a held-out token: bucket of its context, and its two estimates to a quarter octave."""
    share = np.where(pair > 0, 1 + _steps(np.maximum(context, 1) / np.maximum(pair, 1)), 0)
    often = np.where(word > 0, 1 + _steps(np.maximum(word, 1)), 0)
    return (bucket(context) << 20) + (share << 10) + often


def _steps(values: np.ndarray) -> np.ndarray:
    return (_BINS * np.log2(values)).astype(np.int64)


def learn_weights(
    buckets: np.ndarray, times: np.ndarray, estimates: np.ndarray, rounds: int = 100
) -> np.ndarray:
    """Mixture weights by bucket, by expectation-maximisation on held-out counts.

    A row stands for ``times`` held-out tokens with about the same estimates. Every bucket
    starts from, and is held by five tokens to, the weights of all buckets together.
    """

    def maximise(rows: np.ndarray, n: np.ndarray, start: np.ndarray, held: float) -> np.ndarray:
        weights = start.copy()
        for _ in range(rounds if len(rows) else 0):
            parts = rows * weights
            parts *= (n / np.maximum(parts.sum(axis=1), 1e-300))[:, None]
            weights = parts.sum(axis=0) + held * start
            weights /= weights.sum()
        return weights

    shared = maximise(estimates, times, np.full(3, 1 / 3), 1e-3)
    learned = np.array(
        [maximise(estimates[buckets == b], times[buckets == b], shared, 5.0) for b in range(_BUCKETS)]
    )
    # After an unseen context there is no bigram estimate to give weight to.
    learned[0] = [0, *(learned[0][1:] / learned[0][1:].sum())]
    return learned


@dataclass(frozen=True)
class Counted:
    """Texts in blocks, and what other blocks count of the n-grams of each.

    ``answers`` has, by block and part of the key space, the count of each of the block's keys in the learnable texts
    of all other blocks, and for blocks of held-out texts also that in texts not held out.
    """

    blocks: DataFrame
    answers: DataFrame
    n_open: int  # blocks from this number on are of held-out texts
    n_blocks: int
    n_parts: int
    tokens: int
    types: int
    open_tokens: int
    open_types: int


def count_ngrams(docs: DataFrame, held_share: float = HELD_SHARE) -> Counted:
    """Count the n-grams of ``docs(doc_id, learn, text)`` for learning weights and for scoring.

    Texts are dealt to blocks of about BLOCK_BYTES by a hash of the row; the share ``held_share`` of the learnable ones,
    drawn by a hash of doc_id, is held out (deleted) and has blocks of its own. A block names its distinct n-grams with
    their count in its learnable texts; the parts of the key space add them up and answer a block, key by key
    in its own order. Tasks grow in number with the input, so none grows in size; a frequent n-gram is one entry for
    each block.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_open, n_parts = 1 + size // BLOCK_BYTES, 1 + size // PART_BYTES
    n_blocks = n_open + 1 + int(size * held_share) // BLOCK_BYTES
    held = F.col("learn") & (unit_hash(F.col("doc_id"), salt="deleted") < held_share)
    row = F.xxhash64("doc_id", "text")
    block = F.when(held, n_open + F.pmod(row, F.lit(n_blocks - n_open))).otherwise(F.pmod(row, F.lit(n_open)))
    blocks = docs.select("doc_id", "learn", "text", block.alias("block"))

    def count(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        out = {"part": [], "block": [], "keys": [], "counts": []}
        for order, (key, n) in enumerate(_block_counts(table)[0]):
            for part, cut in _parts(key, n_parts):
                out["part"].append(2 * part + order)
                out["block"].append(block)
                out["keys"].append(key[cut].view(np.int64))
                out["counts"].append(n[cut].astype(np.int32))
        return pa.table(out)

    def total(table: pa.Table) -> pa.Table:
        keys, counts = _flat(table["keys"]), _flat(table["counts"])
        sizes = pa.compute.list_value_length(table["keys"]).to_numpy()
        deleted = table["block"].to_numpy() >= n_open
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.diff(keys[order], prepend=~keys[order][:1]))
        times = np.diff(np.append(first, len(keys)))
        of_held = np.repeat(deleted, sizes)

        def summed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sums = np.add.reduceat(values[order], first, dtype=np.int64)
            spread = np.empty(len(keys), dtype=np.int64)
            spread[order] = np.repeat(sums, times)
            return sums, spread

        sums, others = summed(counts)
        open_sums, rest = summed(np.where(of_held, 0, counts))
        others -= counts
        # One more row, without a block, has the sums of the part's single tokens.
        single = table["part"][0].as_py() % 2 == 0
        told = [x for v in (sums, open_sums) for x in (int(v.sum()), int((v > 0).sum()))] if single else [0] * 4
        stops = np.append(0, np.cumsum(sizes))
        kept = np.append(0, np.cumsum(np.where(deleted, sizes, 0)))
        return pa.table(
            {
                "block": pa.array([*table["block"].to_pylist(), None], pa.int64()),
                "part": pa.array([*table["part"].to_pylist(), None], pa.int64()),
                "others": pa.ListArray.from_arrays(
                    np.append(stops, stops[-1] + 4).astype(np.int32), pa.array(np.append(others, told))
                ),
                "rest": pa.ListArray.from_arrays(
                    np.append(kept, kept[-1]).astype(np.int32), pa.array(rest[of_held])
                ),
            }
        )

    counted = _by(blocks, "block", n_blocks).applyInArrow(
        count, "part bigint, block bigint, keys array<bigint>, counts array<int>"
    )
    with shuffles_removed(docs.sparkSession):
        answers = written(
            _by(counted, "part", 2 * n_parts).applyInArrow(
                total, "block bigint, part bigint, others array<bigint>, rest array<bigint>"
            ),
            "ngram-counts",
        )
    sums = answers.filter("block is null").agg(
        *[F.coalesce(F.sum(F.get("others", F.lit(i))), F.lit(0)) for i in range(4)]
    ).first()
    return Counted(blocks, answers.filter("block is not null"), n_open, n_blocks, n_parts, *map(int, sums))


def train_interpolation(counted: Counted) -> Interpolation:
    """Learn the weights from every token of the held-out texts.

    Estimates come from the learnable texts that are not held out. Held-out tokens
    are counted by cells of their bucket and estimates, some 500,000 at most at any size of the input, and
    a cell is as many tokens with its mean estimates.
    """

    n_parts = counted.n_parts

    def cells(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        (word, pair), context, _ = _looked_up(texts, _answered(answers, "rest"), n_parts, False)
        place, at = np.unique(cell(pair, context, word), return_inverse=True)
        share = pair / np.maximum(context, 1)
        return pa.table(
            [place, np.bincount(at).astype(np.int64), np.bincount(at, share), np.bincount(at, word)], names=names
        )

    names, kinds = ["cell", "n", "share", "word"], [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    held, groups = F.col("block") >= counted.n_open, counted.n_blocks - counted.n_open
    answers = counted.answers.filter(held).select("block", "part", "rest")
    table = (
        _by(counted.blocks.filter(held), "block", groups).cogroup(_by(answers, "block", groups))
        .applyInArrow(cells, "cell bigint, n bigint, share double, word double")
        .groupBy("cell").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow()
    )
    place, times, share, word = (table[c].to_numpy() for c in names)
    estimates = np.column_stack(
        [
            share / np.maximum(times, 1), word / np.maximum(times, 1) / max(counted.open_tokens, 1),
            np.full(len(place), 1 / (counted.open_types + 1)),
        ]
    )
    weights = learn_weights(place >> 20, times, estimates)
    return Interpolation(weights, counted.tokens, counted.types)


def score_texts(counted: Counted, model: Interpolation) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score for every counted row."""
    n_parts = counted.n_parts

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            ids = pa.array([], texts.schema.field("doc_id").type)
            return pa.table([ids, *(pa.array([], kind) for kind in out_types)], names=out_names)
        found, context, sizes = _looked_up(texts, _answered(answers, "others"), n_parts, True)
        word, pair = found
        firsts = np.cumsum(sizes) - sizes
        base = np.log10(word + _ADDED) - np.log10(model.tokens + _ADDED * (model.types + 1))
        own = np.empty(len(word))
        for at in range(0, len(word), 1 << 18):
            cut = slice(at, at + (1 << 18))
            own[cut] = np.log10(model.chances(pair[cut], context[cut], word[cut]))
        sums = (np.add.reduceat(x, firsts) for x in ((word > 0).astype(np.int64), base, own))
        known, base, own = sums
        ids = texts["doc_id"].combine_chunks()
        return pa.table([ids, pa.array(sizes), pa.array(known), pa.array(base), pa.array(own)],
                        names=out_names)

    out_names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    out_types = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    kind = counted.blocks.schema["doc_id"].dataType.simpleString()
    return _by(counted.blocks, "block", counted.n_blocks).cogroup(
        _by(counted.answers.select("block", "part", "others"), "block", counted.n_blocks)
    ).applyInArrow(
        score, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    )


def _by(df: DataFrame, key: str, groups: int):
    """Groups by a key, in about as many tasks as there are groups, 100,000 at most."""
    return df.repartition(min(2 * groups, 100_000), key).groupBy(key)


def _answered(answers: pa.Table, name: str) -> dict[int, np.ndarray]:
    """Counts by part, of the answers to one block."""
    out = {}
    for chunk in answers.to_batches():
        lists = chunk.column(chunk.schema.get_field_index(name))
        for at, part in enumerate(chunk.column(chunk.schema.get_field_index("part")).to_pylist()):
            out[part] = lists[at].values.to_numpy()
    return out


def _looked_up(texts: pa.Table, answered: dict[int, np.ndarray], n_parts: int, own: bool):
    """Counts of every token alone and in its pair, of its context, and the tokens by text.

    ``own`` adds what the block's own learnable texts count to the answers of others.
    """
    counted, places, sizes = _block_counts(texts, places=True)
    found = []
    for order, ((key, n), place) in enumerate(zip(counted, places)):
        if not own:
            n = np.zeros_like(n)
        for part, cut in _parts(key, n_parts):
            n[cut] += answered[2 * part + order]
        found.append(n[place].astype(float))
    context = np.roll(found[0], 1)
    context[np.cumsum(sizes) - sizes] = found[0][sizes[0] - 1]
    return found, context, sizes


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([chunk.flatten().to_numpy() for chunk in lists.chunks])


def _parts(key: np.ndarray, n_parts: int):
    """The parts of the key space that have some of the ordered keys, and the slice of each."""
    part = key // np.uint64((1 << 64) // n_parts + 1) if n_parts > 1 else np.zeros(len(key), np.uint64)
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(key) else np.zeros(0, np.int64)
    stops = np.append(first[1:], len(key))
    return [(int(part[a]), slice(int(a), int(b))) for a, b in zip(first, stops)]


def _block_counts(table: pa.Table, places: bool = False):
    """For single tokens and for pairs: ordered distinct keys with their count in learnable texts.

    Also the place of every occurrence among the keys, if asked for, and the tokens by text.
    """
    texts = [t for chunk in table["text"].cast(pa.binary()).chunks for t in chunk.to_pylist()]
    words, sizes = tokens(texts)
    del texts
    learn = np.repeat(table["learn"].to_numpy().astype(bool), sizes)
    counted, found = [], []
    for keys in ngram_keys(words, sizes):
        key = np.unique(keys)
        known, times = np.unique(keys[learn], return_counts=True)
        n = np.zeros(len(key), dtype=np.int64)
        n[np.searchsorted(key, known)] = times
        counted.append((key, n))
        if places:
            found.append(np.searchsorted(key, keys).astype(np.int32))
    return counted, found, sizes


def lm_scores(docs: DataFrame, learn: Column) -> tuple[DataFrame, Interpolation]:
    """Scores of all whole texts of ``docs(doc_id, text)`` by a model of the rows for which ``learn`` holds.

    Tokens are words with A to Z lowered, and an end for each text; NULL is the empty text. A row whose ``learn``
    is NULL is scored and not learned from; other columns are ignored. Without any learnable row every token has the
    uniform chance. n-grams are told apart by 64-bit hashes. Equal rows get equal scores.
    """
    rows = docs.select("doc_id", F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    counted = count_ngrams(rows)
    model = train_interpolation(counted)
    return score_texts(counted, model), model
