"""Infilling against a direct computation, exact round trips, and odd rows."""

import hashlib
import re

import pytest

from roadpulse.llm.infill import (
    Sentinels,
    characters,
    content,
    cut,
    digest,
    fill_in_middle,
    inverse,
    restore_middle,
    whole,
)

SCHEMA = "doc_id bigint, text string, n string, form string, output string, source string"
TEXTS = [
    None, "", "\n", "a", "a\nb", "a\r\n\n\nbü\n", "line\n" * 50, "holds <P> mark\nx", "<S\n>", "<<P\n>P>", "x<M>",
    "no end\n\n", "é😀\n漢字\n" * 300_000, "P>\n<S\n<M", " \n ",
]


def expected(doc_id, text, seed=7, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in marks):
        return len(lines), "plain", None, None, text
    low, high = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = ("".join(part) for part in (lines[:low], lines[low:high], lines[high:]))
    p, s, m = marks
    form = "spm" if h[3] % 100 < 50 else "psm"
    output = s + suffix + p + prefix + m + middle if form == "spm" else p + prefix + s + suffix + m + middle
    return len(lines), form, len(prefix), len(middle), output


@pytest.mark.parametrize("marks", [("<P>", "<S>", "<M>"), ("|pre|x", "|suf|x", "|mid|x")])
def test_every_text_is_cut_arranged_and_restored(spark, marks):
    rows = [(i if i % 5 else None, t) for copy in range(3) for i, t in enumerate(TEXTS, copy * 20)]
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash", "src") for r in rows], SCHEMA).repartition(3)
    carried = ["doc_id", "text", "source", "n"]
    formatted = fill_in_middle(docs, sentinels=marks, carry=carried)
    assert formatted.columns == ["doc_id", "text", "source", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
    found = formatted.collect()
    assert len(found) == len(rows)
    for r in found:
        want = expected(r.doc_id, r.text, marks=marks)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
    for r in restore_middle(formatted, marks, ["text"]).collect():
        assert r.restored == (r.text or "")
        assert r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()


def test_shares_of_the_forms(spark):
    docs = spark.createDataFrame([(i, "one\ntwo\nthree\n") for i in range(2000)], "doc_id bigint, text string")
    counts = {r.form: r["count"] for r in fill_in_middle(docs, percent=40, percent_spm=25).groupBy("form").count().collect()}
    assert abs(counts["plain"] - 1200) < 100 and abs(counts["spm"] - 200) < 60 and abs(counts["psm"] - 600) < 80


def test_no_documents(spark):
    formatted = fill_in_middle(spark.createDataFrame([], SCHEMA))
    assert formatted.collect() == [] and restore_middle(formatted).collect() == []


def test_cuts_split_descriptors_only():
    text = "aü😀\nxyz".encode()
    first, rest = cut(whole(text), 3)
    middle, last = cut(rest, 5)
    assert all(p.buffer is text for p in first + middle + last)
    assert content(first + middle + last) == text and digest([*first, *middle, *last]) == hashlib.sha256(text).hexdigest()
    assert cut(whole(text), 0) == ([], whole(text)) and cut(whole(text), 99) == (whole(text), [])
    assert [characters(p) for p in (first, middle, last)] == [2, 2, 3]
    assert inverse((3, 0, 4, 2, 5, 1)) == [1, 5, 3, 0, 2, 4]


@pytest.mark.parametrize("marks", [("a", "a", "b"), ("ab", "ba", "c"), ("aa", "b", "c"), ("abc", "b", "d"), ("x", "", "y"), ("x", "y")])
def test_marks_that_overlap_are_refused(marks):
    with pytest.raises(ValueError):
        Sentinels(marks)
