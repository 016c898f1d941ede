"""Repeated passages: bytes covered by a string of 100 bytes that starts earlier too."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import byte_runs
from roadpulse.session import written

LENGTH = 100
_GRAM = 16
BLOCK_BYTES = 24_000_000
_ROOM = 1 << 20  # positions hashed at a time
_PLACE_BITS = np.uint64(20)
_FLUSH = 1 << 20

_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


class Hasher:
    """64-bit hashes of parts of a run of bytes, from sums of byte values times powers."""

    def __init__(self, base: int, room: int):
        self.values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
        self.up, self.down = np.full(room, base, np.uint64), np.full(room, pow(base, -1, 1 << 64), np.uint64)
        self.up[0] = self.down[0] = 1
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def read(self, raw: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(self.values[raw] * self.up[: len(raw)], out=sums[1:])
        return sums

    def parts(self, sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        lengths = (stops - starts).astype(np.uint64)
        return _mixed((sums[stops] - sums[starts]) * self.down[starts] + lengths)


def _least_places(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` consecutive values, the first of equal ones.

    Minima of blocks from the left and from the right meet in every window.
    """
    places = np.arange(len(grams), dtype=np.uint64)
    marked = grams >> _PLACE_BITS << _PLACE_BITS | places
    size = -(-len(marked) // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(marked)] = marked
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(grams) - width + 1
    least = np.minimum(right[:count], left[width - 1 : width - 1 + count])
    return (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)


def anchored_runs(texts: list[bytes | None], hasher: Hasher, length: int = LENGTH):
    """Runs of window starts that share an anchor: text, place, anchor hash, region hash, sides.

    The anchor of a window of ``length`` bytes is its gram of least hash, so equal windows have
    equal anchors at equal places, wherever they stand. A run's region is all that its windows
    cover. ``place`` packs start, distance to the anchor and number of windows; ``sides`` packs short hashes
    of the bytes left and right of the anchor, 0 where the text ends. Yields arrays for some
    texts at a time.
    """
    waiting: list[tuple[int, int, bytes]] = []
    held = 0
    for at, text in enumerate(texts):
        step = _ROOM - length
        for start in range(0, max(0, len(text or b"") - length + 1), step):
            part = text[start : start + step + length - 1]
            if held + len(part) > _ROOM:
                yield _runs(waiting, hasher, length)
                waiting, held = [], 0
            waiting.append((at, start, part))
            held += len(part)
    if waiting:
        yield _runs(waiting, hasher, length)


def _runs(waiting, hasher: Hasher, length: int):
    joined = np.frombuffer(b"".join(part for _, _, part in waiting), np.uint8)
    sums = hasher.read(joined)
    first = np.arange(len(joined) - _GRAM + 1)
    anchors = _least_places(hasher.parts(sums, first, first + _GRAM), length - _GRAM + 1)
    sizes = np.array([len(part) for _, _, part in waiting])
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(waiting)), sizes)[: len(anchors)]
    inside = np.arange(len(anchors)) + length <= (begins + sizes)[owner]
    starts = np.flatnonzero(inside)
    turn = np.flatnonzero(
        np.diff(anchors[starts], prepend=-1).astype(bool) | np.diff(owner[starts], prepend=-1).astype(bool)
    )
    low = starts[turn]
    number = np.diff(np.append(turn, len(starts)))
    anchor, who = anchors[low], owner[low]
    shift = (anchor - low).astype(np.uint64) * np.uint64(_BASES[1])
    region = _mixed(hasher.parts(sums, low, low + number + length - 1) ^ shift)
    texts, offsets = (np.array([w[k] for w in waiting]) for k in (0, 1))
    side = (length - _GRAM) // 2
    left, right = np.maximum(anchor - side, 0), np.minimum(anchor + _GRAM + side, len(joined))
    sides = [
        np.where(there, hasher.parts(sums, a, b) % np.uint64(65535) + np.uint64(1), 0).astype(np.int64)
        for there, a, b in (
            (anchor - side >= begins[who], left, anchor),
            (anchor + _GRAM + side <= (begins + sizes)[who], anchor + _GRAM, right),
        )
    ]
    start = low - begins[who] + offsets[who]
    return (
        texts[who], start << 14 | (anchor - low) << 7 | number,
        hasher.parts(sums, anchor, anchor + _GRAM).view(np.int64), region.view(np.int64),
        (sides[0] << 16 | sides[1]).astype(np.uint32).view(np.int32),
    )


_SEEN = (
    "anchor bigint, region bigint, id bigint, tie bigint, place bigint, sides int,"
    " more array<struct<id:bigint,tie:bigint,place:bigint>>"
)


def _run_rows(length: int):
    """Arrow map from (id, tie, text) to distinct regions with where a task saw them."""

    def emit(found) -> pa.RecordBatch:
        ids, ties, place, anchor, region, sides = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((place, ties, ids, region, anchor))
        new = np.append(True, np.diff(anchor[order]).astype(bool) | np.diff(region[order]).astype(bool))
        head, rest = order[new], order[~new]
        # Of most regions a task sees one; the others of a region follow its first.
        after = np.cumsum(~new)[np.append(np.flatnonzero(new)[1:] - 1, len(order) - 1)]
        empty = np.diff(after, prepend=0) == 0
        more = pa.ListArray.from_arrays(
            pa.array(np.append(0, after).astype(np.int32), mask=np.append(empty, False)),
            pa.StructArray.from_arrays(
                [pa.array(x[rest]) for x in (ids, ties, place)], ["id", "tie", "place"]
            ),
        )
        columns = [pa.array(x[head]) for x in (anchor, region, ids, ties, place, sides)]
        return pa.RecordBatch.from_arrays(
            [*columns, more], names=["anchor", "region", "id", "tie", "place", "sides", "more"]
        )

    def run(batches):
        hasher, found, held = Hasher(_BASES[0], _ROOM), [], 0
        for batch in batches:
            ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = batch.column(2).cast(pa.binary())
            for a, b in byte_runs(texts):
                for who, *rest in anchored_runs(texts[a:b].to_pylist(), hasher, length):
                    found.append((ids[a:b][who], ties[a:b][who], *rest))
                    held += len(who)
                if held > _FLUSH:
                    yield emit(found)
                    found, held = [], 0
        if found:
            yield emit(found)

    return run


def repeated_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """What stays of every whole text of ``docs(doc_id, text)`` without its repeated passages.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a row of smaller doc_id,
    or before in the same text. Strings are judged on the input and never cross texts. Returns doc_id, n_bytes,
    n_removed, n_spans (maximal removed runs), spans (start and stop in bytes) and kept_sha256. NULL is the
    empty text. Null ids come first. Rows that repeat an id follow each other by a hash of their
    text, and a row that repeats both is a copy of the one before. Other columns are ignored.

    Every window of ``length`` bytes has an anchor by its content. Windows that share an anchor without a
    gap are a run, and equal runs collapse to the first of them: the others go whole. Where
    runs with one anchor differ but agree on one side of it, at the edges of a passage, the windows of
    their first occurrences are compared one by one by 95-bit hashes. So only runs, one
    for about 45 bytes, are shuffled, and windows only at edges.
    """
    counted = docs.agg(F.count("*"), F.countDistinct("doc_id"), F.sum(F.octet_length("text"))).first()
    unique = counted[0] == counted[1]
    size = counted[2] or 0
    n_blocks = 1 + size // BLOCK_BYTES
    tie = F.lit(0).cast("bigint") if unique else F.xxhash64("text")
    # A null id sorts below every other; it is put back at the end.
    low = F.lit(-(1 << 63)).cast("bigint")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), low).alias("id"), tie.alias("tie"), "text"
    )

    def block(doc_id: str, tie_name: str):
        return F.pmod(F.xxhash64(doc_id, tie_name), F.lit(n_blocks)).alias("block")

    seen = rows.mapInArrow(_run_rows(length), _SEEN)
    of_anchor = Window.partitionBy("anchor")
    several = F.min("region").over(of_anchor) != F.max("region").over(of_anchor)
    met = (
        seen.withColumn("rows", F.count("*").over(of_anchor))
        .withColumn("several", several)
        .filter((F.col("rows") > 1) | F.col("more").isNotNull())
    )

    def shared(side: str):
        # Another region has the same bytes on this side of the anchor.
        alike = Window.partitionBy("anchor", side)
        return (F.col(side) > 0) & (F.min("region").over(alike) != F.max("region").over(alike))

    head = F.struct("id", "tie", "place")
    every = F.concat(F.array(head), F.coalesce("more", F.array()))
    # Once for both of its uses; whatever is in one place only is gone by now.
    places = written(
        met.withColumn("left", F.shiftrightunsigned("sides", 16))
        .withColumn("right", F.col("sides").bitwiseAND(0xFFFF))
        .withColumn("left_shared", F.col("several") & shared("left"))
        .withColumn("right_shared", F.col("several") & shared("right"))
        .withColumn("first", F.min(head).over(Window.partitionBy("anchor", "region")))
        .select("left_shared", "right_shared", "first", F.explode(every).alias("at"))
        .withColumn("later", F.col("at") > F.col("first"))
        .filter("later or ((left_shared or right_shared) and at = first)")
        .select("at.*", "later", "left_shared", "right_shared"),
        "repeat-places",
    )
    place = places.select(
        block("id", "tie"), "id", "tie", "later", "left_shared", "right_shared",
        F.shiftright("place", 14).cast("int").alias("start"),
        F.col("place").bitwiseAND(127).cast("int").alias("n"),
        (F.shiftright("place", 7).bitwiseAND(127).cast("int") - (length - _GRAM) // 2).alias("reach"),
    )
    whole = place.filter("later").select(
        "block", "id", "tie", "start", (F.col("n") + length - 1).alias("bytes")
    )
    # A window with more than half of the rest left of the anchor needs the left side shared.
    skipped = F.when(F.col("left_shared"), 0).otherwise(F.greatest("reach", F.lit(0)))
    stop = F.when(F.col("right_shared"), F.col("n")).otherwise(F.least(F.col("n"), F.col("reach") + 1))
    edges = place.filter("not later").select(
        "block", "id", "tie", (F.col("start") + skipped).alias("start"), (stop - skipped).alias("n")
    ).filter("n > 0")
    blocks = rows.select(block("id", "tie"), "id", "tie", "text")

    def windows(texts: pa.Table, found: pa.Table) -> pa.Table:
        return _edge_windows(texts, found, length)

    single = (
        blocks.groupBy("block").cogroup(edges.groupBy("block"))
        .applyInArrow(windows, "a bigint, b int, id bigint, tie bigint, start int")
    )
    order = Window.partitionBy("a", "b").orderBy("id", "tie", "start")
    later = single.withColumn("nth", F.row_number().over(order)).filter("nth > 1").select(
        block("id", "tie"), "id", "tie", "start", F.lit(length).alias("bytes")
    )
    covers = whole.unionByName(later)

    def cut(texts: pa.Table, found: pa.Table) -> pa.Table:
        return _without(texts, found, length)

    kept = blocks.groupBy("block").cogroup(covers.groupBy("block")).applyInArrow(
        cut, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
        "spans array<struct<start:bigint,stop:bigint>>, kept_sha256 string",
    )
    kind = docs.schema["doc_id"].dataType
    return kept.select(
        F.when(F.col("id") != low, F.col("id")).cast(kind).alias("doc_id"),
        "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256",
    )


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[n].to_numpy() for n in names]


def _edge_windows(texts: pa.Table, edges: pa.Table, length: int) -> pa.Table:
    """Two hashes of every window of the edge runs, with where it starts."""
    whole, half = np.zeros(0, np.int64), np.zeros(0, np.int32)
    out = [(whole, half, whole, whole, half)]
    if edges.num_rows and texts.num_rows:
        # Copies of a row have the same edges, and all of a row are in its block.
        edges = edges.select(["id", "tie", "start", "n"])
        edges = edges.group_by(edges.column_names).aggregate([])
        hashers = [Hasher(base, _ROOM) for base in _BASES]
        text_of = {
            (i, t): x.as_buffer()
            for i, t, x in zip(texts["id"].to_pylist(), texts["tie"].to_pylist(), _binary(texts["text"]))
            if x.is_valid
        }
        for i, t, start, n in zip(*(c.tolist() for c in _columns(edges, "id", "tie", "start", "n"))):
            raw = np.frombuffer(text_of[i, t], np.uint8)[start : start + n + length - 1]
            at = np.arange(n)
            a, b = (h.parts(h.read(raw), at, at + length).view(np.int64) for h in hashers)
            b = (b & 0x7FFFFFFF).astype(np.int32)
            out.append((a, b, np.full(n, i), np.full(n, t), (start + at).astype(np.int32)))
    return pa.table(
        {name: pa.array(np.concatenate(x)) for name, x in zip(("a", "b", "id", "tie", "start"), zip(*out))}
    )


def _binary(column: pa.ChunkedArray):
    return (x for chunk in column.cast(pa.binary()).chunks for x in chunk)


def _without(texts: pa.Table, covers: pa.Table, length: int) -> pa.Table:
    """Every text of a block with the covered bytes taken out."""
    ids, ties, starts, sizes = _columns(covers, "id", "tie", "start", "bytes")
    order = np.lexsort((starts, ties, ids))
    ids, ties, starts, stops = ids[order], ties[order], starts[order], (starts + sizes)[order]
    bounds = np.flatnonzero(
        np.diff(ids, prepend=~ids[:1]).astype(bool) | np.diff(ties, prepend=~ties[:1]).astype(bool)
    )
    where = {
        (int(ids[a]), int(ties[a])): (a, b) for a, b in zip(bounds, np.append(bounds[1:], len(ids)))
    }
    out = {n: [] for n in ("id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")}
    done = set()
    for i, t, x in zip(texts["id"].to_pylist(), texts["tie"].to_pylist(), _binary(texts["text"])):
        text = memoryview(x.as_buffer() if x.is_valid else b"")
        a, b = where.get((i, t), (0, 0))
        spans = _joined(starts[a:b], stops[a:b])
        if (i, t) in done and len(text) >= length:
            spans = [(0, len(text))]
        done.add((i, t))
        digest, last = hashlib.sha256(), 0
        for start, stop in spans:
            digest.update(text[last:start])
            last = stop
        digest.update(text[last:])
        out["id"].append(i)
        out["n_bytes"].append(len(text))
        out["n_removed"].append(sum(stop - start for start, stop in spans))
        out["n_spans"].append(len(spans))
        out["spans"].append([{"start": s, "stop": e} for s, e in spans])
        out["kept_sha256"].append(digest.hexdigest())
    kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string()]
    return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)})


def _joined(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Covered runs of intervals that are ordered by start; touching ones are one run."""
    if not len(starts):
        return []
    reach = np.maximum.accumulate(stops)
    new = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return list(zip(starts[new].tolist(), reach[np.append(new[1:] - 1, len(starts) - 1)].tolist()))
