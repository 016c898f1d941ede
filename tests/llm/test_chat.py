"""Reply trees against a brute-force walk, and exact reading back of formatted conversations."""

import random

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import queries
from roadpulse.llm.chat import (
    escaped,
    format_reply_trees,
    read_turns,
    reply_chains,
    reply_paths,
    text_under_loss,
    unescaped,
)

LINKS = "tree bigint, node bigint, parent bigint, score double"
SAID = "conv_id bigint, turn bigint, role string, text string, tree string, path int, place int, node string"
NASTY = [
    "", "\\", "### ", "\\### Assistant: </turn> ok", "#### user: </turn></turn>\n</turn>\n", "\n</turn>\n### user: hi",
    "\\\\### \\\\</turn>", "$1 \\$1 ünï😀code ###", "### " * 7, "</turn", "### user", ": : ",
]


def walked(rows, best=None):
    """Paths of every tree by following each leaf's parents."""
    nodes = {}
    for tree, node, parent, score in rows:
        before = nodes.get((tree, node))
        parents = [p for p in (before[0] if before else None, parent) if p is not None]
        nodes[tree, node] = (min(parents, default=None), max(score or 0.0, before[1] if before else score or 0.0))
    answered = {(t, p) for t, _, p, _ in rows if p is not None}
    branches = {}
    for tree, leaf in nodes:
        path, at, total = [], leaf, 0.0
        while at is not None and (tree, at) in nodes and at not in path:
            path.append(at)
            total += nodes[tree, at][1]
            at = nodes[tree, at][0]
        if (tree, leaf) not in answered and at not in path:
            branches.setdefault(tree, []).append((-total, leaf, path[::-1]))
    return {
        (tree, leaf): path for tree, found in branches.items() for _, leaf, path in sorted(found)[:best]
    }


def paths_of(df):
    found = {}
    for r in df.collect():
        found.setdefault((r.tree, r.path), []).append((r.place, r.node))
    return {k: [n for _, n in sorted(v)] for k, v in found.items()}


def random_trees():
    draw = random.Random(5)
    rows = [(None, 1, None, 1.0), (None, 2, 1, None), (None, 2, 1, 3.0), (3, 1, 1, 1.0), (3, 2, 9, 0.0)]
    rows += [(4, 1, 2, 1.0), (4, 2, 1, 1.0), (4, 3, 2, 1.0), (5, 0, None, 0.0)]  # a ring and its tail
    rows += [(6, i, i - 1 if i else None, 1.0) for i in range(37)]
    rows += [(7, i, 0 if i else None, float(i % 5)) for i in range(60)]
    for tree in range(10, 30):
        rows += [(tree, i, draw.randrange(i) if i else None, draw.choice([0.0, 1.0, 2.0])) for i in range(draw.randrange(1, 30))]
    return rows


@pytest.mark.parametrize("best", [None, 1, 3])
def test_paths_match_a_walk(spark, best):
    rows = random_trees()
    paths = reply_paths(spark.createDataFrame(rows, LINKS).repartition(5), best)
    found = {(t.tree, leaf): path for (t, leaf), path in paths_of(paths).items()}
    assert found == walked(rows, best)


def test_paths_survive_shuffled_rounds(spark, monkeypatch):
    monkeypatch.setattr("roadpulse.llm.chat._BROADCAST_ROWS", -1)
    rows = random_trees()
    paths = reply_paths(spark.createDataFrame(rows, LINKS))
    assert {(t.tree, leaf): path for (t, leaf), path in paths_of(paths).items()} == walked(rows)


def test_escapes_are_reversible_and_hide_control_strings(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "text string")
    for r in df.select("text", escaped(F.col("text")).alias("e"), unescaped(escaped(F.col("text"))).alias("u")).collect():
        assert r.u == r.text
        for mark in ("### ", "</turn>"):
            assert r.e.count(mark) == r.e.count("\\" + mark)


def test_conversations_read_back(spark):
    draw, rows = random.Random(3), []
    for conv in [None, *range(20)]:
        for turn in draw.sample(range(-3, 40), draw.randrange(1, 12)):
            rows.append((conv, turn, draw.choice(["user", "assistant", "system", "a: b\n### x"]), draw.choice(NASTY)))
    # Equal turns, repeated rows, nulls in every column, a text beyond a megabyte.
    rows += [(50, 1, "user", "b"), (50, 1, "user", "a"), (50, 1, "assistant", "z"), (50, 2, "assistant", "x"), (50, 2, "assistant", "x")]
    rows += [(51, None, None, None), (51, 3, None, "t"), (51, None, "assistant", None), (None, None, None, None)]
    rows += [(52, 1, "assistant", "ä### b\\" * 300_000), (52, 2, "assistant", "ok")]
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SAID).repartition(4)
    chats = format_reply_trees(*reply_chains(df)).select(
        "tree", "n_turns", "formatted", read_turns(F.col("formatted")).alias("turns"),
        text_under_loss(F.col("formatted"), F.col("spans")).alias("loss"), "spans",
    )
    found = {r.tree: r for r in chats.collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, r in found.items():
        want = sorted((-(10**9) if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv)
        assert [(t.role, t.text) for t in r.turns] == [w[1:] for w in want]
        assert r.n_turns == len(want)
        assert r.loss == "".join(text for _, role, text in want if role == "assistant")
        assert [s.loss for s in r.spans] == [role == "assistant" for _, role, _ in want]
        assert all(r.formatted[s.stop :].startswith("\n</turn>\n") for s in r.spans)


def test_branches_share_their_first_messages(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 5.0), (1, 4, 2, "user", "c", 9.0)]
    df = spark.createDataFrame(rows, "tree int, node int, parent int, role string, text string, score double")

    def said(best):
        chats = format_reply_trees(df, best=best).select(read_turns(F.col("formatted")).alias("t")).collect()
        return sorted([t.text for t in r.t] for r in chats)

    assert said(None) == [["q", "a", "c"], ["q", "b"]]
    assert said(1) == [["q", "a", "c"]]


def test_no_conversations(spark):
    assert format_reply_trees(*reply_chains(spark.createDataFrame([], SAID))).collect() == []


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = queries.QUERIES["op13_chat"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
