"""Chat formatting of reply trees: the best branches of each tree become conversations."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import ready
from starmill.session import stage

START, END = "<|im_start|>", "<|im_end|>"
CONTROL, ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
TURN = re.compile(re.escape(START) + "(.*?)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
LEARNED = "assistant"
PART_CHARS = 1 << 20


def escape(text: str) -> str:
    """``<|`` cannot occur in the result: a backslash goes between, one more if some are there."""
    return CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def best_branches(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """The nodes on the ``keep`` best root-to-leaf paths of each tree: ``conv, leaf, node,
    position``, from ``conv, node, parent, score``.

    A path's rank is its mean score, then the smaller leaf. A node whose parent is null or not
    in its tree is a root. Self-joins double the reach of every node's link to an ancestor, so
    a tree of depth d takes log2(d) rounds; paths of the chosen leaves are then read off the
    links of all lengths, which gives one row per node on a path and never all paths at once.
    Each round is written to the shared folder. Null scores count 0. Cyclic parents are refused.
    """
    nodes = nodes.select("conv", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    there = nodes.select(F.col("conv").alias("c"), F.col("node").alias("n"))
    known = F.col("conv").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("n"))
    link = stage(
        nodes.join(there, known, "left").select(
            "conv", "node", F.col("n").alias("up"), "score", F.lit(1).cast("long").alias("depth")
        ),
        "reply-links",
    )
    total = link.count()
    # Nodes whose link has reached a root are settled; only the others are joined again.
    settled, open_ = link.where("up is null"), link.where("up is not null")
    links = [open_]
    while not open_.isEmpty():
        if 1 << (len(links) - 1) > total:
            raise ValueError("the parents of a reply tree form a cycle")
        above = settled.unionByName(open_).select(
            F.col("conv").alias("c"),
            F.col("node").alias("n"),
            F.col("up").alias("next"),
            F.col("score").alias("more"),
            F.col("depth").alias("further"),
        )
        meet = F.col("conv").eqNullSafe(F.col("c")) & (F.col("up") == F.col("n"))
        link = stage(
            open_.join(above, meet).select(
                "conv",
                "node",
                F.col("next").alias("up"),
                (F.col("score") + F.col("more")).alias("score"),
                (F.col("depth") + F.col("further")).alias("depth"),
            ),
            "reply-links",
        )
        settled = settled.unionByName(link.where("up is null"))
        open_ = link.where("up is not null")
        links.append(open_)
    settled = stage(settled, "reply-links")
    parents = nodes.select(F.col("conv").alias("c"), F.col("parent").alias("n")).distinct()
    child = F.col("conv").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))
    rank = Window.partitionBy("conv").orderBy(F.desc(F.col("score") / F.col("depth")), "node")
    path = stage(
        settled.join(parents, child, "left_anti")
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= keep)
        .select("conv", F.col("node").alias("leaf"), "node"),
        "reply-paths",
    )
    for hop in links[:-1]:
        hop = hop.select(
            F.col("conv").alias("c"), F.col("node").alias("n"), "up"
        )
        meet = F.col("conv").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))
        above = path.join(hop, meet).select("conv", "leaf", F.col("up").alias("node"))
        path = stage(path.unionByName(above), "reply-paths")
    depth = settled.select(F.col("conv").alias("c"), F.col("node").alias("n"), "depth")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))
    return path.join(depth, same).select("conv", "leaf", "node", F.col("depth").alias("position"))


def format_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order to parts of formatted text, each of whole turns; ``loss`` marks, in code
    points of the part, the texts to be learned. Only the part at hand is held."""
    key, text, loss, size, part = None, [], [], 0, 0

    def ready_part():
        return pa.RecordBatch.from_pydict(
            {
                "conv": pa.array([key[0]], pa.int64()),
                "leaf": pa.array([key[1]], pa.int64()),
                "part": pa.array([part], pa.int64()),
                "formatted": ["".join(text)],
                "loss": pa.array([loss], pa.list_(pa.int64())),
            }
        )

    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("conv", "leaf", "role", "text")), strict=True)
        for conv, leaf, role, said in rows:
            if text and (key != (conv, leaf) or size > PART_CHARS):
                yield ready_part()
                part = part + 1 if key == (conv, leaf) else 0
                text, loss, size = [], [], 0
            key = (conv, leaf)
            head, said = START + escape_role(role or "") + "\n", escape(said or "")
            if role == LEARNED:
                loss += [size + len(head), size + len(head) + len(said)]
            text.append(head + said + END + "\n")
            size += len(text[-1])
    if text:
        yield ready_part()


def format_chats(messages: DataFrame, keep: int = 1) -> DataFrame:
    """Formatted conversations: ``conv, leaf, part, formatted, loss``, in order inside
    partitions, from messages ``conv, node, parent, score, role, text``.

    Each of the ``keep`` best branches of a reply tree is one conversation. Long ones come in
    parts of about a million characters, each of whole turns, and are streamed through a task
    without being held whole. ``loss`` lists start and end of every assistant text in the part.
    Null roles and texts count as empty, null ``conv`` is a conversation like others, an empty
    table gives no rows, repeated node ids are refused by the caller's numbering, and columns
    other than those named are not read.
    """
    ready(messages.sparkSession)
    chosen = best_branches(messages, keep)
    said = messages.select(
        F.col("conv").alias("c"), F.col("node").alias("n"), "role", "text"
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))
    return (
        chosen.join(said, same)
        .select("conv", "leaf", "position", "role", "text")
        .repartition("conv", "leaf")
        .sortWithinPartitions("conv", "leaf", "position")
        .mapInArrow(
            format_turns, "conv long, leaf long, part long, formatted string, loss array<long>"
        )
    )


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted part."""
    end = 0
    for m in TURN.finditer(formatted):
        if m.start() != end:
            break
        end = m.end()
        yield unescape_role(m[1]), unescape(m[2])
    if end != len(formatted):
        raise ValueError("formatted text does not follow the template")


def digest_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read conversations back from their parts, one row each."""

    def parts():
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("conv", "leaf", "formatted", "loss"))
            yield from zip(*columns, strict=True)

    for (conv, leaf), own in groupby(parts(), key=lambda r: r[:2]):
        turns, learned = hashlib.sha256(), hashlib.sha256()
        n = learned_chars = chars = 0
        for _, _, formatted, loss in own:
            chars += len(formatted)
            for role, text in read_turns(formatted):
                n += 1
                turns.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
            for start, end in zip(loss[::2], loss[1::2], strict=True):
                text = unescape(formatted[start:end])
                learned_chars += len(text)
                learned.update(text.encode("utf-8", "replace"))
        yield pa.RecordBatch.from_pydict(
            {
                "conv_id": pa.array([conv], pa.int64()),
                "leaf": pa.array([leaf], pa.int64()),
                "n_turns": pa.array([n], pa.int64()),
                "turns_sha256": [turns.hexdigest()],
                "loss_chars": pa.array([learned_chars], pa.int64()),
                "loss_sha256": [learned.hexdigest()],
                "formatted_chars": pa.array([chars], pa.int64()),
            }
        )


def digest_chats(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations gets, one row per conversation."""
    return formatted.mapInArrow(
        digest_parts,
        "conv_id long, leaf long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )


def replies_by_turn(conversations: DataFrame) -> DataFrame:
    """Flat conversations as reply trees of one branch: each row answers the one before it, by
    turn, then role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        node.alias("node"),
        F.nullif(node - 1, F.lit(0)).alias("parent"),
        F.lit(1.0).alias("score"),
        "role",
        "text",
    )
