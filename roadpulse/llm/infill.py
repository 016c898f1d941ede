"""Fill-in-the-middle: piece tables cut, arrange and restore documents without copying their text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from roadpulse.llm.common import map_columns

SENTINELS = ("<P>", "<S>", "<M>")
SEED = 7

_LINE_END = 10
# Slots of a table that is ready to be arranged: the three parts, then the three sentinels.
_PREFIX, _MIDDLE, _SUFFIX, _P, _S, _M = range(6)
#: The order in which each form reads the slots.
ARRANGEMENTS = {
    "psm": (_P, _PREFIX, _S, _SUFFIX, _M, _MIDDLE),
    "spm": (_S, _SUFFIX, _P, _PREFIX, _M, _MIDDLE),
}


@dataclass(frozen=True)
class Piece:
    """A descriptor: bytes ``start`` to ``stop`` of a buffer that nobody changes."""

    buffer: bytes
    start: int
    stop: int

    def __len__(self) -> int:
        return self.stop - self.start

    def view(self) -> memoryview:
        return memoryview(self.buffer)[self.start : self.stop]


def whole(buffer: bytes) -> list[Piece]:
    """A table of one piece; an empty buffer has none."""
    return [Piece(buffer, 0, len(buffer))] if buffer else []


def cut(table: Sequence[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The table before and after an offset; a piece that holds the offset becomes two."""
    before: list[Piece] = []
    for number, piece in enumerate(table):
        if at < len(piece):
            rest = [Piece(piece.buffer, piece.start + at, piece.stop), *table[number + 1 :]]
            return before + ([Piece(piece.buffer, piece.start, piece.start + at)] if at else []), rest
        before.append(piece)
        at -= len(piece)
    return before, []


def arranged(slots: Sequence[list[Piece]], order: Sequence[int]) -> list[Piece]:
    return [piece for slot in order for piece in slots[slot]]


def inverse(order: Sequence[int]) -> list[int]:
    """The permutation that undoes ``order``."""
    back = [0] * len(order)
    for place, slot in enumerate(order):
        back[slot] = place
    return back


def content(table: Sequence[Piece]) -> bytes:
    return b"".join(piece.view() for piece in table)


def digest(table: Sequence[Piece]) -> str:
    """SHA-256 of a table's content, read piece by piece."""
    total = hashlib.sha256()
    for piece in table:
        total.update(piece.view())
    return total.hexdigest()


def characters(table: Sequence[Piece]) -> int:
    """Code points of a table: the bytes that continue none."""
    return sum(
        int(np.count_nonzero((np.frombuffer(p.buffer, np.uint8, len(p), p.start) & 0xC0) != 0x80))
        for p in table
    )


class Sentinels:
    """The three marks of an arrangement, as pieces of one buffer.

    No mark may contain another or end as one begins. Then a text without marks, set
    between marks, forms none with them, and the output can be taken apart again.
    """

    def __init__(self, marks: Sequence[str] = SENTINELS):
        self.marks = [m.encode() for m in marks]
        if len(self.marks) != 3 or not all(self.marks) or any(
            one[-length:] == other[:length]
            for a, one in enumerate(self.marks)
            for b, other in enumerate(self.marks)
            for length in range(1, min(len(one), len(other)) + 1)
            if a != b or length < len(one)
        ) or any(one in other for one in self.marks for other in self.marks if one is not other):
            raise ValueError("three sentinels are needed, none of which overlaps another or itself")
        buffer = b"".join(self.marks)
        self.slots, start = [], 0
        for mark in self.marks:
            self.slots.append([Piece(buffer, start, start + len(mark))])
            start += len(mark)

    def occur_in(self, text: bytes) -> bool:
        return any(mark in text for mark in self.marks)

    def arrange(self, parts: Sequence[list[Piece]], form: str) -> list[Piece]:
        return arranged([*parts, *self.slots], ARRANGEMENTS[form])

    def restore(self, output: bytes, form: str) -> list[Piece]:
        """The pieces of ``output`` that are the original text, in its order."""
        if form not in ARRANGEMENTS:
            return whole(output)
        order, rest, found, at = ARRANGEMENTS[form], whole(output), [], 0
        # Marks and parts alternate: a part ends where the next mark starts.
        for mark, following in zip(order[::2], [*order[2::2], None]):
            head, rest = cut(rest, len(self.marks[mark - _P]))
            at += len(self.marks[mark - _P])
            end = len(output) if following is None else output.index(self.marks[following - _P], at)
            part, rest = cut(rest, end - at)
            found += [head, part]
            at = end
        return arranged(found, inverse(order)[: _SUFFIX + 1])


def line_ends(text: bytes) -> np.ndarray:
    """Offsets after 0, 1, 2, ... lines; the last line may lack its line feed."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == _LINE_END) + 1
    last = [len(text)] if text and text[-1] != _LINE_END else []
    return np.concatenate(([0], ends, last)).astype(np.int64)


def drawn(seed: int, doc_id: object) -> list[int]:
    """Four numbers of 32 bits that depend on the seed and the id alone."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    hashed = hashlib.sha256(key.encode()).hexdigest()
    return [int(hashed[at : at + 8], 16) for at in range(0, 32, 8)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    percent: int = 100,
    percent_spm: int = 50,
    sentinels: Sequence[str] = SENTINELS,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Every document with its text cut at two line ends and arranged for infilling.

    Adds n (lines), form (plain, psm or spm), prefix_chars and middle_chars (code points, NULL if
    plain), output (the arranged text) and output_sha256, which is computed from the pieces. The
    cuts and the form follow from ``seed`` and doc_id; rows with equal ids are cut by the same
    draws, and a NULL id draws like an empty one. A text stays plain if it is NULL or empty
    (output ''), if it contains a sentinel, or for 100 - ``percent`` of the ids. Long texts are
    one buffer each and are not copied until the output is joined. Carried columns that are named like an
    added one are left out.
    """
    marks = Sentinels(sentinels)

    def make():
        def one(doc_id, text: bytes | None) -> dict:
            text = text or b""
            ends = line_ends(text)
            n = len(ends) - 1
            first, second, plain, form = drawn(seed, doc_id)
            if not text or plain % 100 >= percent or marks.occur_in(text):
                table, name, sizes = whole(text), "plain", (None, None)
            else:
                low, high = sorted((first % (n + 1), second % (n + 1)))
                head, suffix = cut(whole(text), int(ends[high]))
                prefix, middle = cut(head, int(ends[low]))
                name = "spm" if form % 100 < percent_spm else "psm"
                table = marks.arrange((prefix, middle, suffix), name)
                sizes = characters(prefix), characters(middle)
            return {"n": n, "form": name, "prefix_chars": sizes[0], "middle_chars": sizes[1],
                    "output": content(table), "output_sha256": digest(table)}

        return one

    fields = ("n bigint, form string, prefix_chars bigint, middle_chars bigint, "
              "output string, output_sha256 string")
    return map_columns(docs, make, ["doc_id", "text"], fields, carry)


def restore_middle(
    formatted: DataFrame, sentinels: Sequence[str] = SENTINELS, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Carried columns with ``restored``, the original text rebuilt from output and form alone.

    Adds restored_sha256, computed from the pieces. A NULL output counts as empty; any form but psm and
    spm means that the output is the text.
    """
    marks = Sentinels(sentinels)

    def make():
        def one(form, output: bytes | None) -> dict:
            table = marks.restore(output or b"", form)
            return {"restored": content(table), "restored_sha256": digest(table)}

        return one

    return map_columns(formatted, make, ["form", "output"], "restored string, restored_sha256 string", carry)
