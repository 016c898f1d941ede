"""Benchmark decontamination with an Aho-Corasick automaton over benchmark windows."""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import byte_runs, filter_texts, pieces
from roadpulse.session import written

WINDOW = 10
_BLOCK_BYTES = 4_000_000
_BLANK = 32
# Letters in lower case, digits and bytes of longer characters stay; all else is a blank.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else _BLANK
    for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Normalised words: runs of a-z (A-Z lowered), 0-9 and non-ASCII characters."""
    return (text or b"").translate(_NORMAL).split()


def benchmark_windows(text: bytes | None, window: int = WINDOW) -> set[bytes]:
    """Each ``window`` consecutive words; all words of a shorter text; none of an empty one."""
    found = words(text)
    last = max(1, len(found) - window + 1) if found else 0
    return {b" ".join(found[at : at + window]) for at in range(last)}


class Scanner:
    """Finds the occurrences of windows and their items in a text."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for passage in benchmark_windows(text, window):
                owners.setdefault(passage, set()).add(item)
        self.longest = max((p.count(b" ") + 1 for p in owners), default=0)
        self.automaton = ahocorasick.Automaton()
        for passage, who in owners.items():
            # Latin-1 keeps one character for each byte; blanks mark whole words.
            self.automaton.add_word(f" {passage.decode('latin-1')} ", (passage.count(b" ") + 1, frozenset(who)))
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged ranges of hit words and the items with an occurrence."""
        count, ranges, who, carried = 0, [], set(), []
        for piece in pieces((text or b"").translate(_NORMAL)):
            found = piece.split()
            count += len(found)
            if not self.longest:
                continue
            found = carried + found
            first = count - len(found)
            carried = found[len(found) - self.longest + 1 :] if self.longest > 1 else []
            joined = b" " + b" ".join(found) + b" "
            blanks = None
            for end, (length, owners) in self.automaton.iter(joined.decode("latin-1")):
                if blanks is None:
                    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == _BLANK)
                stop = first + int(np.searchsorted(blanks, end))
                ranges.append((stop - length, stop))
                who |= owners
        return count, merged(ranges), who


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges without overlap or contact, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as ranges of characters of the original text."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.concatenate(([0], np.frombuffer(text.translate(_NORMAL), np.uint8) != _BLANK, [0]))
    edges = np.diff(inside.astype(np.int8))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    characters = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [(int(characters[starts[a]]), int(characters[stops[b - 1]])) for a, b in ranges]


def _blocks(benchmark: DataFrame, window: int) -> list[list[tuple[str, bytes]]]:
    """The items in blocks of bounded size: each window repeats a text's bytes ``window`` times."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = 1 + total * window // _BLOCK_BYTES
    block = F.pmod(F.xxhash64("item", "text"), F.lit(number))
    for at in range(number):
        yield [(r.item, r.text.encode()) for r in items.filter(block == at).collect()]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, carry: list[str] | None = None
) -> DataFrame:
    """Carried columns (doc_id) with the passages of ``benchmark(item_id, text)`` in every whole text.

    Adds n_words, word_ranges (ranges of hit words), item_ids (sorted as strings) and spans (ranges of characters of
    the original text). NULL texts have no words. A NULL item id counts as the empty string;
    items without words have no window. Rows of ``docs`` are scanned once for each block of items; one block
    holds about 4 MB of windows, so a usual benchmark is one block.
    """
    carried = [c for c in (carry or ["doc_id"])]
    names = [f"c{i}" for i in range(len(carried))]
    state = docs.select(*[F.col(c).alias(n) for c, n in zip(carried, names)], "text").selectExpr(
        *names, "text", "0L as n_words", "cast(array() as array<struct<start:bigint,stop:bigint>>) as word_ranges",
        "cast(array() as array<string>) as item_ids",
    )
    schema, width = state.schema, len(names)
    for at, items in enumerate(_blocks(benchmark, window)):
        if at:
            state = written(state, "contamination")

        def run(batches, items=items):
            scanner = Scanner(items, window)
            for batch in batches:
                texts = batch.column(width).cast(pa.binary())
                for start, stop in byte_runs(texts):
                    part = batch.slice(start, stop - start)
                    count, ranges, who = zip(*map(scanner.scan, texts[start:stop].to_pylist()))
                    before = [[(r["start"], r["stop"]) for r in rs] for rs in part.column(width + 2).to_pylist()]
                    ids = part.column(width + 3).to_pylist()
                    found = [[{"start": a, "stop": b} for a, b in merged([*o, *n])] for o, n in zip(before, ranges)]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[: width + 1], pa.array(count, pa.int64()),
                         pa.array(found, part.schema.field(width + 2).type),
                         pa.array([sorted({*o, *n}) for o, n in zip(ids, who)], part.schema.field(width + 3).type)],
                        schema=part.schema,
                    )

        state = state.mapInArrow(run, schema)

    def spans(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            texts = batch.column(width).cast(pa.binary()).to_pylist()
            ranges = batch.column(width + 2).to_pylist()
            found = [
                [{"start": a, "stop": b} for a, b in original_spans(t, [(r["start"], r["stop"]) for r in rs])] if rs else []
                for t, rs in zip(texts, ranges)
            ]
            columns = [*batch.columns[:width], *batch.columns[width + 1 :], pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "word_ranges", "item_ids", "spans"])

    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema if f.name != "text")
    mapped = state.mapInArrow(spans, out + ", spans array<struct<start:bigint,stop:bigint>>")
    return mapped.toDF(*carried, "n_words", "word_ranges", "item_ids", "spans")


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows, with all their columns, whose text holds no passage of the benchmark."""
    for items in _blocks(benchmark, window):

        def clean(items=items):
            scanner = Scanner(items, window)
            return lambda texts: [not scanner.scan(t)[1] for t in texts]

        docs = filter_texts(docs, clean)
    return docs
