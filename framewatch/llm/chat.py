"""Chat formatting of reply trees.

Messages form trees: every message but the first answers another one.  Ancestors
are found by iterative self-joins that double the distance at every step, so a
path of n messages takes log2(n) joins; each step also adds up the scores of the
messages between.  Leaves then have the score of their whole branch, branches are
ranked per tree, and the chosen paths are written out from leaf to root by the
same doubled distances.  Each becomes one text:

    [INST]role[/INST]text</s>  for every message, after one <s>

Control strings inside roles and texts get a backslash after their first
character, and one more if they have some already, so nothing a message says can
end a turn, and reading back takes exactly one away.

Defined cases: null roles and texts are empty; messages of one tree that share a
turn are ordered by role and text; a null conv_id is a conversation of its own;
branches of equal score are ranked by their leaf; repeated rows stay repeated; an
empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let

BEGIN, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
#: A control string, with any number of backslashes after its first character.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"


@dataclass(frozen=True)
class ChatFormat:
    branches: int = 1               # paths taken from every tree, by rank
    learn_from: str = "assistant"   # role whose texts are under the loss mask


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)(/?s>|/?INST\])", "$1$2$3")


def reply_tree(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation by turn as a tree: each answers the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        F.col("conv_id").alias("tree"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.row_number().over(order).cast("long").alias("node"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                       F.length("text").cast("double").alias("score"), "role", "text")


def _same_tree(a: str, b: str) -> Column:
    return F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree"))


def choose_paths(nodes: DataFrame, chat: ChatFormat) -> DataFrame:
    """tree, leaf, place, node: the messages of the chosen paths; place 0 is the leaf."""
    links = nodes.select("tree", "node", F.col("parent").alias("up"), "score")
    leaves = links.alias("n").join(
        links.where("up is not null").select("tree", F.col("up").alias("node")).distinct().alias("p"),
        _same_tree("n", "p") & (F.col("n.node") == F.col("p.node")), "left_anti").select("tree", "node")
    levels = [cut(links, "chat-up0")]
    while levels[-1].where("up is not null").limit(1).count():
        now = levels[-1].where("up is not null")
        top = levels[-1].where("up is null")
        far = now.alias("a").join(levels[-1].alias("b"), _same_tree("a", "b") & (F.col("a.up") == F.col("b.node")), "left").select(
            "a.tree", "a.node", F.col("b.up").alias("up"), (F.col("a.score") + F.coalesce("b.score", F.lit(0.0))).alias("score"))
        levels.append(cut(far.unionByName(top), f"chat-up{len(levels)}"))
    scored = leaves.alias("l").join(levels[-1].alias("s"), _same_tree("l", "s") & (F.col("l.node") == F.col("s.node"))).select(
        "l.tree", F.col("l.node").alias("leaf"), "s.score")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    chosen = scored.withColumn("rank", rank).where(F.col("rank") <= chat.branches)
    paths = chosen.select("tree", "leaf", F.lit(0).cast("long").alias("place"), F.col("leaf").alias("node"))
    for k in range(len(levels) - 2, -1, -1):
        up = levels[k].where("up is not null").select("tree", "node", "up")
        above = paths.alias("p").join(up.alias("u"), _same_tree("p", "u") & (F.col("p.node") == F.col("u.node"))).select(
            "p.tree", "p.leaf", (F.col("p.place") + (1 << k)).alias("place"), F.col("u.up").alias("node"))
        paths = paths.unionByName(above)
        if k % 4 == 0:
            paths = cut(paths, f"chat-paths{k}")
    return paths


def format_trees(nodes: DataFrame, chat: ChatFormat = ChatFormat()) -> DataFrame:
    """tree, leaf and ``formatted`` of every chosen path, with the parts under the loss mask:
    ``loss_spans`` as (start, end), code points of ``formatted``, and ``loss_parts`` as
    (turn, start, end), code points of that turn's part between two END marks.

    Places are one running sum over the turns, so the work is linear in a conversation."""
    nodes = cut(nodes, "chat-nodes")
    paths = choose_paths(nodes, chat)
    turns = paths.alias("p").join(nodes.alias("n"), _same_tree("p", "n") & (F.col("p.node") == F.col("n.node"))).select(
        "p.tree", "p.leaf", "p.place", F.concat(F.lit(ROLE), escape("n.role"), F.lit(TEXT)).alias("head"),
        escape("n.text").alias("body"), (F.col("n.role") == chat.learn_from).alias("learn"))
    order = Window.partitionBy("tree", "leaf").orderBy(F.desc("place"))
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = turns.select(
        "tree", "leaf", "place", "learn", F.concat("head", "body").alias("part"), F.length("head").alias("head"), F.length("body").alias("body"))
    placed = sized.withColumns({
        "turn": F.row_number().over(order) - 1,
        "until": (F.sum(F.col("head") + F.col("body") + len(END)).over(until) + len(BEGIN) - len(END)).cast("int")})
    span = F.struct((F.col("until") - F.col("body")).alias("start"), F.col("until").alias("end"))
    part = F.struct("turn", F.col("head").alias("start"), (F.col("head") + F.col("body")).alias("end"))
    whole = placed.groupBy("tree", "leaf").agg(
        F.sort_array(F.collect_list(F.struct("turn", "part")))["part"].alias("parts"),
        F.sort_array(F.collect_list(F.when(F.col("learn"), F.struct(span.alias("span"), part.alias("part"))))).alias("loss"))
    return whole.select("tree", "leaf", F.concat(F.lit(BEGIN), F.array_join("parts", END), F.lit(END)).alias("formatted"),
                        F.col("loss.span").alias("loss_spans"), F.col("loss.part").alias("loss_parts"))


def _parts(formatted: Column) -> Column:
    """What stands before each END mark, without BEGIN."""
    parts = F.split(F.substring(formatted, len(BEGIN) + 1, F.length(formatted)), END, -1)
    return let(parts, lambda p: F.slice(p, 1, F.size(p) - 1))


def read_formatted(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped."""
    def turn(p: Column) -> Column:
        at = F.instr(p, TEXT)
        return F.struct(unescape(F.substring(p, len(ROLE) + 1, at - len(ROLE) - 1)).alias("role"),
                        unescape(F.substring(p, at + len(TEXT), F.length(p))).alias("text"))
    return F.transform(_parts(formatted), turn)


def read_loss(formatted: Column, loss_parts: Column) -> Column:
    """The texts under the loss mask of a formatted text, unescaped: array of strings."""
    return let(_parts(formatted), lambda parts: F.transform(loss_parts, lambda m: unescape(
        F.substring(F.get(parts, m["turn"]), m["start"] + 1, m["end"] - m["start"]))))


def conversation_digests(conversations: DataFrame, chat: ChatFormat = ChatFormat()) -> DataFrame:
    """Per conversation, read back from its formatted text: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    rows = format_trees(reply_tree(conversations), chat).select(
        F.col("tree").alias("conv_id"), "formatted", "loss_parts", read_formatted(F.col("formatted")).alias("turns"))
    masked = F.array_join(read_loss(F.col("formatted"), F.col("loss_parts")), "")
    rows = rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        masked.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return rows.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
