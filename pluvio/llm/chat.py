r"""Reply trees as formatted conversations, by DataFrame functions only.

A message answers at most one other. Iterative self-joins over narrow rows
(no texts) enumerate the paths from each root to its leaves: after round k
every message knows its ancestor 2^k steps up, so a path of n messages takes
log2(n) rounds up and as many joins back down. The branches of a tree are
ranked by the mean score of their messages, and each chosen path becomes one
conversation.

A turn is written as ``### role: text</turn>`` and a line feed. Inside texts
and roles a backslash becomes ``\b``, ``###`` becomes ``\h``, ``</turn>``
becomes ``\t``, and in roles a colon ``\c``: no control string is left in
them, and as every backslash then starts one of these pairs, they are undone
one after the other, ``\b`` last. The loss mask is a list of byte spans of
the formatted text, one for each assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import global_rank, staged

#: Fixed values of the template.
MARK, END, ASSISTANT = "###", "</turn>", "assistant"
ESCAPES = [("\\", "\\b"), (MARK, "\\h"), (END, "\\t"), (":", "\\c")]


def escape(text: Column, role: bool = False) -> Column:
    for plain, coded in ESCAPES[:4 if role else 3]:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for plain, coded in reversed(ESCAPES[:4 if role else 3]):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _key(*parts: Column) -> Column:
    """What tells a message's words apart: its place, its role and 128 bits of its text's SHA-256."""
    *place, role, text = parts
    return F.struct(*[p.alias(f"at{i}") for i, p in enumerate(place)], F.coalesce(role, F.lit("")).alias("role"),
                    F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32)).alias("digest"))


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(nodes, texts) of conversations given as numbered turns: each row answers the one before it.

    Rows of equal turn follow each other by role, then by a digest of the
    text; a row that is repeated is said as often. A null turn comes first,
    rows without a conversation form one, null roles and texts are empty.
    """
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv_col, turn_col, role_col, text_col))
    texts = rows.select(_key(conv, turn, role, text).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    said = (texts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            .select("key", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")))
    order = [F.col("key.at0"), F.col("key.at1"), F.col("key.role"), F.col("key.digest"), F.col("copy")]
    ranked = global_rank(said, "node", *order)
    before = ranked.select((F.col("node") + 1).alias("node"), F.struct("key.at0").alias("last"))
    nodes = ranked.join(before, "node", "left").select(
        "node", F.when(F.col("last") == F.struct("key.at0"), F.col("node") - 1).alias("parent"),
        F.col("key.at0").alias("tree"), "key", F.lit(0.0).alias("score"))
    return nodes, texts


def replies(rows: DataFrame, tree_col: str = "tree_id", id_col: str = "message_id", parent_col: str = "parent_id",
            role_col: str = "role", text_col: str = "text", score_col: str = "score") -> tuple[DataFrame, DataFrame]:
    """(nodes, texts) of messages that name the message of their tree which they answer.

    A message without a parent, or whose parent is not in its tree, is a
    root. Rows that share tree and id are one message, the least of them by
    parent, score, role and digest of the text. A null or NaN score counts as
    0, a null id or tree as a value of its own, null roles and texts are empty.
    """
    tree, ident, parent, role, text, score = (
        F.col(f"`{c}`") for c in (tree_col, id_col, parent_col, role_col, text_col, score_col))
    key = _key(tree, ident, role, text)
    texts = rows.select(key.alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    points = F.coalesce(F.nanvl(score.cast("double"), F.lit(0.0)), F.lit(0.0))
    ones = (rows.select(F.struct(tree.alias("at0"), ident.alias("at1")).alias("me"),
                        F.struct(parent.alias("parent"), points.alias("score"), key.alias("key")).alias("row"))
            .groupBy("me").agg(F.min("row").alias("row")))
    ranked = staged(global_rank(ones, "node", F.col("me.at0"), F.col("me.at1")), "messages")
    asked = ranked.select("node", "me", "row", F.when(F.col("row.parent").isNotNull(), F.struct(
        F.col("me.at0").alias("at0"), F.col("row.parent").alias("at1"))).alias("answers"))
    found = ranked.select(F.col("node").alias("parent"), F.col("me").alias("answers"))
    nodes = asked.join(found, "answers", "left").select(
        "node", "parent", F.col("me.at0").alias("tree"), "row.key", "row.score")
    return nodes, texts


def paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """(leaf, tree, branch, score, node, key, pos): the messages of each root-to-leaf path.

    ``branch`` numbers the leaves of a tree from 0 by score (the mean over
    the path, highest first), ties by leaf; with ``branches`` only so many are
    given. Messages whose parents lead round in a circle have no root; each
    of them is a path of its own.
    """
    nodes = staged(nodes, "nodes")
    here = staged(nodes.select("node", F.col("parent").alias("up"), F.lit(1).alias("hops"),
                               F.col("score").alias("total")), "state")
    done, steps, before = here.where("up is null"), [], None
    left = here.where("up is not null").count()
    while left and left != before:  # only messages whose root is not reached go on
        steps.append(here.where("up is not null").select("node", "up"))
        above = done.unionByName(here.where("up is not null")).select(
            F.col("node").alias("up"), F.col("up").alias("next"), F.col("hops").alias("more"), F.col("total").alias("gain"))
        here = staged(here.where("up is not null").join(above, "up").select(
            "node", F.col("next").alias("up"), (F.col("hops") + F.col("more")).alias("hops"),
            (F.col("total") + F.col("gain")).alias("total")), "state")
        done = done.unionByName(here.where("up is null"))
        before, left = left, here.where("up is not null").count()
    answered = nodes.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    ends = done.join(answered, "node", "left_anti")
    leaves = ends.select("node", "hops", (F.col("total") / F.col("hops")).alias("mean"))
    if left:  # these go round in circles
        own = nodes.select("node", "score").join(here.where("up is not null").select("node"), "node", "left_semi")
        leaves = leaves.unionByName(own.select("node", F.lit(1).alias("hops"), F.col("score").alias("mean")))
    leaves = leaves.join(nodes.select("node", "tree"), "node")
    placed = staged(global_rank(leaves, "place", F.col("tree"), F.col("mean").desc(), F.col("node")), "leaves")
    firsts = placed.groupBy(F.struct("tree").alias("of")).agg(F.min("place").alias("first"))
    chosen = placed.withColumn("of", F.struct("tree")).join(firsts, "of").select(
        F.col("node").alias("leaf"), "node", "hops", F.lit(0).alias("back"), (F.col("place") - F.col("first")).alias("branch"),
        F.col("mean"))
    chosen = staged(chosen if branches is None else chosen.where(F.col("branch") < branches), "chosen")
    walked = chosen.where(F.col("hops") > 1 << len(steps))  # none
    for k in reversed(range(len(steps))):  # from every place on a path, the one 2^k messages further up
        walked = walked.unionByName(chosen.where((F.col("hops") > 1 << k) & (F.col("hops") <= 2 << k)))
        further = F.struct(F.col("up").alias("node"), (F.col("back") + (1 << k)).alias("back"))
        both = F.array_compact(F.array(F.struct("node", "back"), F.when(
            F.col("up").isNotNull() & (F.col("back") + (1 << k) < F.col("hops")), further)))
        walked = walked.join(steps[k], "node", "left").select(
            "leaf", "branch", "mean", "hops", F.explode(both).alias("at")).select("*", "at.*").drop("at")
    walked = walked.unionByName(chosen.where("hops = 1"))
    return staged(walked.join(nodes.select("node", "tree", "key"), "node").select(
        "leaf", "tree", F.col("branch").cast("long").alias("branch"), F.col("mean").alias("score"), "node", "key",
        (F.col("hops") - 1 - F.col("back")).alias("pos")), "paths")


def format_paths(walked: DataFrame, texts: DataFrame) -> DataFrame:
    """One row per path: tree, branch, score, formatted, loss (array of
    (start, end): byte spans, end exclusive, of the assistant texts)."""
    once = texts.groupBy("key").agg(F.any_value("text").alias("text"))
    coded = once.join(walked, "key").select(
        "leaf", "tree", "branch", "score", "pos", (F.col("key.role") == ASSISTANT).alias("learn"),
        F.concat(F.lit(f"{MARK} "), escape(F.col("key.role"), role=True), F.lit(": ")).alias("head"),
        escape(F.col("text")).alias("body"))
    size = lambda *c: sum(map(F.octet_length, c), F.lit(0)).cast("long")
    tail = F.lit(f"{END}\n")
    so_far = Window.partitionBy("leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size(F.col("head"), F.col("body"), tail)).over(so_far), F.lit(0)) + size(F.col("head"))
    spanned = coded.withColumn("start", start).select(
        "leaf", "tree", "branch", "score", F.struct(
            "pos", F.concat("head", "body", tail).alias("turn"), "learn", "start",
            (F.col("start") + size(F.col("body"))).alias("end")).alias("turn"))
    made = spanned.groupBy("leaf").agg(
        *[F.any_value(c).alias(c) for c in ("tree", "branch", "score")],
        F.array_sort(F.collect_list("turn")).alias("turns"))
    return made.select(
        "tree", "branch", "score", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]),
                    lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    written = F.split(formatted, f"{END}\n")
    halves = F.transform(F.slice(written, F.lit(1), F.size(written) - 1), lambda t: F.split(t, ": ", 2))
    return F.transform(halves, lambda h: F.struct(
        unescape(F.substr(h[0], F.lit(len(MARK) + 2)), role=True).alias("role"), unescape(h[1]).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, as an array."""
    cut = lambda data: F.transform(loss, lambda s: unescape(F.substr(
        data, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).cast("string")))
    # as a lambda's variable the bytes are decoded once, not once a span
    return F.transform(F.array(formatted.cast("binary")), cut)[0]


def conversations(rows: DataFrame, **names: str) -> DataFrame:
    """Numbered turns as formatted conversations: tree (the conversation),
    branch, score, formatted, loss. See :func:`turns` for nulls, ties and
    repeated rows; an empty table gives none, and other columns are not read."""
    nodes, texts = turns(rows, **names)
    return format_paths(paths(nodes), texts)


def branches(rows: DataFrame, best: int | None = None, **names: str) -> DataFrame:
    """The ``best`` branches (None: all) of each reply tree as formatted
    conversations: tree, branch (its rank from 0), score, formatted, loss.
    See :func:`replies` and :func:`paths` for nulls, ties, repeated rows and
    circles; an empty table gives none, and other columns are not read."""
    nodes, texts = replies(rows, **names)
    return format_paths(paths(nodes, best), texts)
