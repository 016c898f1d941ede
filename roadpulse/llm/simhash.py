"""SimHash near-duplicates, found by fuzzy hashing with the Golay code."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import map_texts, pieces
from roadpulse.llm.components import connected_components
from roadpulse.session import written

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
BITS = 64
_GOLAY_BITS = 23
_KIND_SHIFT = 58
# Fixed value: generator polynomial of the perfect binary Golay code.
_GENERATOR = 0xC75


def _remainder(word: int) -> int:
    for bit in range(_GOLAY_BITS - 1, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


def _leaders() -> np.ndarray:
    """The error of at most three bits for each syndrome; the code is perfect, so each has one."""
    single = [_remainder(1 << b) for b in range(_GOLAY_BITS)]
    table = np.zeros(1 << 11, dtype=np.uint32)
    for a in range(_GOLAY_BITS):
        table[single[a]] = 1 << a
        for b in range(a):
            table[single[a] ^ single[b]] = 1 << a | 1 << b
            for c in range(b):
                table[single[a] ^ single[b] ^ single[c]] = 1 << a | 1 << b | 1 << c
    return table


class Golay:
    """Decoding of 23-bit words to the index of the nearest codeword."""

    def __init__(self) -> None:
        self.leaders = _leaders()
        self.low, self.mid, self.high = (
            np.array([_remainder(v << s) for v in range(n)], dtype=np.uint32)
            for s, n in ((0, 256), (8, 256), (16, 128))
        )

    def decode(self, words: np.ndarray) -> np.ndarray:
        syndrome = self.low[words & 255] ^ self.mid[words >> 8 & 255] ^ self.high[words >> 16]
        return (words ^ self.leaders[syndrome]) >> 11

    def keys(self, words: np.ndarray) -> np.ndarray:
        """Indices of the codewords that the word or a word one bit away decodes to.

        Two words at most two bits apart have one in common. One row for each word, repeats included.
        """
        flips = np.concatenate(([0], 1 << np.arange(_GOLAY_BITS))).astype(np.uint32)
        return self.decode(words[:, None] ^ flips[None, :])


_golay = cache(Golay)


def layout(distance: int) -> list[tuple[int, int, int]]:
    """(shift of an exact segment, its width, shift of a Golay word after turning it to the end).

    Of ``distance`` + 1 segments one has no differing bit; the bits outside it hold
    two Golay words, one of which has at most half of the errors.
    """
    if not 0 <= distance <= 5:
        raise ValueError("distances from 0 to 5 only")
    edges = [round(k * BITS / (distance + 1)) for k in range(distance + 2)]
    plan = []
    for start, stop in zip(edges, edges[1:]):
        room = (BITS - (stop - start)) // _GOLAY_BITS
        parts = range(min(2, room)) if distance else ()
        plan += [(start, stop - start, part) for part in parts] or [(start, stop - start, -1)]
    return plan


def fuzzy_keys(prints: np.ndarray, distance: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys: rows at most ``distance`` bits apart share a key."""
    golay, rows, keys = _golay(), [], []
    for number, (start, width, part) in enumerate(layout(distance)):
        turned = prints >> np.uint64(start)
        if start:
            turned = turned | prints << np.uint64(BITS - start)
        exact = turned & np.uint64((1 << width) - 1 if width < BITS else 2**64 - 1)
        if part < 0:  # distance 0: the whole fingerprint
            rows.append(np.arange(len(prints)))
            keys.append(exact)
            continue
        word = turned >> np.uint64(width + part * _GOLAY_BITS) & np.uint64((1 << _GOLAY_BITS) - 1)
        found = np.sort(golay.keys(word.astype(np.uint32)), axis=1).astype(np.uint64)
        new = np.ones(found.shape, dtype=bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        at, _ = np.nonzero(new)
        rows.append(at)
        keys.append(np.uint64(number) << np.uint64(_KIND_SHIFT) | exact[at] << np.uint64(12) | found[new])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of the shingles of a text.

    Shingles of whole words, A to Z lowered; a shorter text is one shingle, a text without words has fingerprint 0.
    """
    ones, total, carried = np.zeros(BITS, dtype=np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for piece in pieces((text or b"").lower()):
        found = carried + piece.split()
        carried = found[max(0, len(found) - shingle + 1) :] if shingle > 1 else []
        if len(found) < shingle:
            continue
        joined = b" ".join(found)
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = np.concatenate(([0], ends[:-1])).tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8")
        for at in range(0, len(hashes), 1 << 14):
            part = hashes[at : at + (1 << 14)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                axis=0, dtype=np.int64
            )
        total += len(hashes)
    if not total:
        return digest(b" ".join(carried), SEED) if carried else 0
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > total).tolist()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: list[str] | None = None) -> DataFrame:
    """Carried columns (doc_id) with the 64-bit ``print`` (a signed long) of every whole text."""

    def prints(texts: list[bytes | None]) -> dict[str, list]:
        values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return {"print": values.view(np.int64).tolist()}

    return map_texts(docs, lambda: prints, "print bigint", carry)


def near_links(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Links ``(a, b)`` of distinct fingerprints in ``prints(print)`` with at most ``distance`` differing bits.

    Each fingerprint is put under several keys, joined on them and compared; a link
    may be found under more than one key.
    """

    def spread(batches):
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 1 << 12):
                part = values[at : at + (1 << 12)]
                rows, keys = fuzzy_keys(part.view(np.uint64), distance)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(part[rows])], ["key", "print"])

    keyed = prints.select("print").mapInArrow(spread, "key bigint, print bigint")
    a = keyed.select("key", F.col("print").alias("a"))
    b = keyed.select(F.col("key").alias("other"), F.col("print").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    near = F.bit_count(differing) <= distance
    # A link shares keys in many ways; only the first kind of key reports it.
    first = _first_kind(differing, distance) == F.shiftrightunsigned("key", _KIND_SHIFT)
    same = F.col("key") == F.col("other")
    return a.join(b.hint("merge"), same & (F.col("a") < F.col("b")) & near & first).select("a", "b")


def _first_kind(differing: Column, distance: int) -> Column:
    """Number of the first kind of key that two words with these differing bits must share."""
    found = F
    for number, (start, width, part) in enumerate(layout(distance)):
        exact, word = (
            _signed(sum(1 << (start + b) % BITS for b in bits))
            for bits in (
                range(width),
                range(width + part * _GOLAY_BITS, width + (part + 1) * _GOLAY_BITS)
                if part >= 0
                else (),
            )
        )
        equal = differing.bitwiseAND(F.lit(exact)) == 0
        few = F.bit_count(differing.bitwiseAND(F.lit(word))) <= 2
        found = found.when(equal & few, number)
    return found


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, print and component_id for every row of ``docs(doc_id, text)``.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is the smallest
    doc_id reachable over links, its own included. Texts without words have fingerprint 0
    and link like any other. Null ids count only if a component has no other. Other columns
    are ignored. ``text_hash`` tells texts apart.

    Equal fingerprints are one node, so copies cost one row; links are sought between
    distinct fingerprints only.
    """
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    rows = written(fingerprints(hashed, shingle, ["doc_id", "text_hash"]), "fingerprints")
    nodes = written(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "prints")
    roots = connected_components(near_links(nodes, distance))
    placed = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = written(placed.join(least, "root").drop("first"), "classes")
    return rows.join(classes, "print").select("doc_id", "text_hash", "print", "root", "component_id")


def keep_first_of_groups(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE
) -> DataFrame:
    """One row, with all its columns, of every near-duplicate group: that of the smallest doc_id.

    Rows with the same id are told apart by a hash of their text, the least of which stays; equal
    rows stay once. A group without ids keeps one of its rows too.
    """
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("least")
    leaders = near_groups(docs, shingle, distance).groupBy("root").agg(least)
    keep = written(
        leaders.select(F.col("least.doc_id").alias("_id"), F.col("least.text_hash").alias("_hash")),
        "leaders",
    )
    # Positions instead of names, so that no column of the input can clash.
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = (F.col(f"c{names.index(n)}") for n in ("doc_id", "text"))
    kept = rows.join(keep, doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_hash")))
    return kept.dropDuplicates(["_id", "_hash"]).drop("_id", "_hash").toDF(*names)
