"""Conversations from reply trees: root-to-leaf paths by self-joins, ranked, formatted and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import written

TRAINED_ROLE = "assistant"

# The template: "### role: text" and a closing line. Both marks are control strings inside texts.
_OPEN, _BETWEEN, _CLOSE = "### ", ": ", "</turn>"
_END = f"\n{_CLOSE}\n"
_CONTROL = f"({_OPEN}|{_CLOSE})"
# Rounds whose open rows are fewer are broadcast (about 100 bytes each); all others are shuffled.
_BROADCAST_ROWS = 100_000


def escaped(text: Column) -> Column:
    """The text with a backslash before every control string; other backslashes stay as they are.

    Neither control string overlaps itself or the other, so all are found, and in the result
    each has a backslash of its own. A mark of the template follows a line feed or the start.
    """
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescaped(text: Column) -> Column:
    """The inverse of :func:`escaped`: every control string loses one backslash."""
    return F.regexp_replace(text, rf"\\{_CONTROL}", "$1")


def turn_head(role: Column) -> Column:
    """The start of a turn; a role is written so that it holds no blank and no mark."""
    return F.concat(F.lit(_OPEN), F.url_encode(role), F.lit(_BETWEEN))


def reply_chains(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages and links of linear conversations(conv_id, turn, role, text).

    Each turn answers the one before it; the numbers may have gaps, and a NULL turn comes
    first. A NULL conv_id is a conversation like any other. Rows with equal turn are one message of several rows.
    Every score is 0.
    """
    node = F.struct("turn").alias("node")
    messages = conversations.select(F.col("conv_id").alias("tree"), node, "role", "text")
    before = Window.partitionBy("tree").orderBy("node")
    links = messages.select("tree", "node").distinct().select(
        "tree", "node", F.lag("node").over(before).alias("parent"), F.lit(0.0).alias("score")
    )
    return messages, links


def _steps(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestors by doubling, and every node that has a root with its depth and score.

    Round k knows each node's ancestor 2^k above, and the number and total score of the nodes
    up to it, itself included. It joins its open nodes with the state of their ancestors. Rounds
    are written, so a lost executor repeats one of them. A node whose ancestors form a ring
    never ends; such nodes are left out after as many rounds as the number of nodes allows.
    """
    nodes = links.groupBy("tree", "node").agg(
        F.min("parent").alias("parent"), F.max(F.coalesce("score", F.lit(0.0))).alias("total")
    )
    nodes = written(nodes, "reply-nodes")
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    # A parent that is no row of its tree is no parent.
    state = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("bigint").alias("depth"), "total"
    )
    rounds, ended = [], []
    most = nodes.count().bit_length() + 1
    while True:
        state = written(state, f"reply-steps-{len(rounds)}")
        ended.append(state.filter("up is null"))
        still = state.filter("up is not null")
        number = still.count()
        if number == 0 or len(rounds) == most:
            break
        rounds.append(still.select("tree", "node", "up"))
        above = reduce(DataFrame.unionAll, ended, still).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("next"),
            F.col("depth").alias("more"), F.col("total").alias("plus"),
        )
        still = F.broadcast(still) if number <= _BROADCAST_ROWS else still
        state = still.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"),
            (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("plus")).alias("total"),
        )
    return rounds, reduce(DataFrame.unionAll, ended).select("tree", "node", "depth", "total")


def reply_paths(links: DataFrame, best: int | None = None) -> DataFrame:
    """Root-to-leaf paths: one row (tree, path, place, node) for every message on a path.

    ``links(tree, node, parent, score)`` are the messages; a NULL or missing parent marks a root, and a
    repeated node counts once (smallest parent, largest score). ``path`` is the leaf, ``place`` counts from the
    root. A branch scores the sum of its messages, NULL as 0; of each tree the ``best`` branches stay
    (ties: the smaller leaf), or all. Trees are compared NULL-safely.
    """
    links = links.select(F.struct("tree").alias("tree"), "node", "parent", "score").filter("node is not null")
    rounds, nodes = _steps(links)
    answered = links.select("tree", F.col("parent").alias("node")).filter("node is not null")
    leaves = nodes.join(answered, ["tree", "node"], "left_anti")
    if best is not None:
        ranked = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
        leaves = leaves.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= best)
    entries = leaves.select("tree", F.col("node").alias("path"), F.col("depth").alias("place"), "node")
    for k, steps in reversed(list(enumerate(rounds))):
        # An entry at place p stands for the 2^(k+1) nodes up to it; half of them are the ancestor's.
        entries = written(entries, f"reply-paths-{k}")
        upper = entries.filter(F.col("place") > 1 << k).join(steps, ["tree", "node"])
        entries = entries.unionAll(
            upper.select("tree", "path", (F.col("place") - (1 << k)).alias("place"), F.col("up").alias("node"))
        )
    return entries


def format_paths(messages: DataFrame, paths: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """One formatted conversation for each path: (tree, path, n_turns, formatted, spans).

    ``messages(tree, node, role, text)`` hold the texts; several rows of one node follow each other
    by role and text. NULL role and text count as empty. ``formatted`` joins the turns by the template.
    ``spans`` has an element for each turn: the range of its text in code points of
    ``formatted``, and ``loss``, whether it belongs to the loss mask (role ``trained``).

    Texts are shuffled once, by tree, and meet the paths there; windows and the final grouping keep that
    partitioning. A conversation is one string, so its turns have to meet in one task.
    """
    row = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    none = F.lit(None)
    texts = messages.select(
        F.struct("tree").alias("tree"), "node", none.cast(paths.schema["path"].dataType).alias("path"),
        none.cast("bigint").alias("place"), row.alias("said"),
    )
    places = paths.select("tree", "node", "path", "place", none.cast(texts.schema["said"].dataType).alias("said"))
    together = texts.unionAll(places).repartition("tree")
    node = Window.partitionBy("tree", "node")
    turns = (
        together.withColumn("all", F.collect_list("said").over(node))
        .filter("place is not null")
        .select("tree", "path", "place", F.posexplode(F.array_sort("all")).alias("row", "said"))
        .select("tree", "path", "place", "row", "said.role",
                turn_head(F.col("said.role")).alias("head"), escaped(F.col("said.text")).alias("body"))
    )
    in_order = Window.partitionBy("tree", "path").orderBy("place", "row")
    size = F.char_length("head") + F.char_length("body") + len(_END)
    ends = F.sum(size.cast("bigint")).over(in_order) - len(_END)
    placed = turns.withColumn("stop", ends).select(
        "tree", "path",
        F.struct(
            "place", "row", F.concat("head", "body", F.lit(_END)).alias("turn"),
            F.struct((F.col("stop") - F.char_length("body")).alias("start"), "stop",
                     (F.col("role") == trained).alias("loss")).alias("span"),
        ).alias("turn"),
    )
    return placed.groupBy("tree", "path").agg(F.array_sort(F.collect_list("turn")).alias("turns")).select(
        "tree.tree", "path", F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join("turns.turn", "").alias("formatted"), F.col("turns.span").alias("spans"),
    )


def format_reply_trees(messages: DataFrame, links: DataFrame | None = None, best: int | None = None) -> DataFrame:
    """Conversations of the best branches of reply trees, see :func:`reply_paths` and :func:`format_paths`.

    ``messages`` are (tree, node, role, text) and, if ``links`` is not given, also (parent, score). Other columns
    are ignored. Without rows there is no conversation.
    """
    links = messages if links is None else links
    return format_paths(messages, reply_paths(links, best))


def _written_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation without their closing lines."""
    parts = F.split(formatted, _END)
    return F.slice(parts, 1, F.size(parts) - 1)


def read_turns(formatted: Column) -> Column:
    """Roles and texts read back from a formatted conversation."""

    def read(turn: Column) -> Column:
        # A role holds no colon, so the first one ends it.
        role = F.substring_index(turn, _BETWEEN, 1)
        text = turn.substr(F.char_length(role) + 1 + len(_BETWEEN), F.char_length(turn))
        return F.struct(
            F.url_decode(role.substr(F.lit(len(_OPEN) + 1), F.char_length(role))).alias("role"),
            unescaped(text).alias("text"),
        )

    return F.transform(_written_turns(formatted), read)


def text_under_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined without anything between.

    A span is read from its own turn, so the work is linear in the length of the conversation.
    """

    def masked(turn: Column, at: Column) -> Column:
        start = F.when(at > 0, F.get(spans, at - 1)["stop"] + len(_END)).otherwise(0)
        span = F.get(spans, at)
        begin, length = span["start"] - start + 1, span["stop"] - span["start"]
        return F.when(span["loss"], unescaped(turn.substr(begin.cast("int"), length.cast("int")))).otherwise("")

    return F.array_join(F.transform(_written_turns(formatted), masked), "")
