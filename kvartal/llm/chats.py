"""Chat formatting as a prefix tree over conversations.

Every turn is written by a template that marks its start, role and end, with control strings
inside texts escaped. Conversations that begin with the same turns share these turns' nodes:
a node is told by the hash of all turns up to it. Each node belongs to the smallest
conversation that passes through it, so a conversation owns the tail of its path, and the
nodes before are runs that earlier conversations own.

A tree holds the conversations with the same first turn. Its nodes are laid out depth-first,
each once: a conversation's own tail in one stretch, then the branches that leave it, the
deepest first. The layout gives every node its start in the tree's stream, a position (as
if its conversation stood alone) and the part under the loss mask; every conversation has its
attention: the stretches of its ancestors in the stream, before its own. Lengths and
positions count code points.

Turns are put in order by a sort that streams through a task, so a conversation of any
length needs no memory; places in a stream are sums over slices of the sorted order, so a
first turn that a third of all conversations share is laid out by many tasks.

Defined results: a null text, role or both are empty; turns go by number, then role, then
text, nulls first; a null conversation id is a conversation of its own; repeated rows are
turns of their own; an empty table has no trees; columns of other names are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from kvartal.llm.frames import NO_ID
from kvartal.llm.words import utf8
from kvartal.sources.staging import stage

START, END = "<|im_start|>", "<|im_end|>"
#: the template's own marks, and those of other templates that a text must not fake
CONTROL = re.compile(r"<\|im_start\|>|<\|im_end\|>|</?s>|\[/?INST\]|<</?SYS>>")
_PAIR = re.compile(r"\\(\\?)")
_LINE_OR_PAIR = re.compile(r"\\([\\n]?)")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)
ASSISTANT = "assistant"

#: code points of a stream in which stretches look for nodes at a time
CELL = 1024

NODES = (
    "cid long, idx int, node string, formatted string, length long, loss_start long, loss_end long"
)


# ---------------------------------------------------------------- template


def escape(text: str) -> str:
    """Backslashes doubled, and a single one after the first character of a control string."""
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _PAIR.sub(lambda m: m[1], text)


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return _LINE_OR_PAIR.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and the part of it under the loss mask."""
    head = f"{START}{_escape_role(role)}\n"
    body = escape(text)
    start = len(head)
    end = start + len(body) if role == ASSISTANT else start
    return f"{head}{body}{END}\n", start, end


def parse_turn(formatted: str) -> tuple[str, str]:
    role, text = _TURN.fullmatch(formatted).groups()
    return _unescape_role(role), unescape(text)


# ---------------------------------------------------------------- tree


@dataclass(frozen=True)
class Forest:
    """``nodes``: tree, cid (owner), idx, start, position, formatted, loss_start, loss_end.

    ``segments``: a row per conversation: tree, cid, start, position, length (of its own tail),
    attention (owner, first, last, start, end: ancestor stretches, then its own) in order.
    """

    nodes: DataFrame
    segments: DataFrame


def _formatted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted turns to nodes; only the last conversation's hash so far is held."""
    last, path, idx = None, b"", 0
    for batch in batches:
        rows = []
        for cid, role, text in zip(batch["cid"], batch["role"], batch["text"], strict=True):
            if cid != last:
                last, path, idx = cid, b"", 0
            formatted, start, end = format_turn(role, text)
            path = hashlib.blake2b(path + utf8(formatted), digest_size=16).digest()
            rows.append((cid, idx, path.hex(), formatted, len(formatted), start, end))
            idx += 1
        yield pd.DataFrame(
            rows, columns=["cid", "idx", "node", "formatted", "length", "loss_start", "loss_end"]
        )


def _sorted_turns(turns: DataFrame) -> DataFrame:
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        turns.select(
            F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("cid"),
            "turn", F.col("role").alias("_role"), F.col("text").alias("_text"),
            F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition(parts, "cid")
        .sortWithinPartitions("cid", "turn", "_role", "_text")
        .select("cid", "role", "text")
    )


def build_forest(turns: DataFrame) -> Forest:
    """The trees of turns(conv_id, turn, role, text); jobs run at once."""
    every = stage(_sorted_turns(turns).mapInPandas(_formatted, NODES), "turns")
    owners = every.groupBy("node").agg(F.min("cid").alias("owner"))
    paths = stage(
        every.select("cid", "idx", "node", "length").join(owners, "node")
        .select("cid", "idx", "length", "owner"),
        "paths",
    )
    # runs of nodes with one owner; owners only grow along a path
    runs = paths.groupBy("cid", "owner").agg(
        F.min("idx").alias("first"), F.max("idx").alias("last"), F.sum("length").alias("length")
    )
    run = F.struct("first", "last", "owner", "length")
    whole = runs.groupBy("cid").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    own = F.filter("runs", lambda r: r.owner == F.col("cid"))
    shared = F.filter("runs", lambda r: r.owner != F.col("cid"))
    zero = F.lit(0).cast("long")
    added = lambda runs: F.aggregate(runs, zero, lambda total, r: total + r.length)
    # depth-first order: by the runs of the path, those that leave an owner deeper down first
    order = F.transform(
        F.concat(shared, F.array(F.struct(
            F.coalesce(F.get(own, F.lit(0))["first"], F.aggregate(shared, F.lit(0), lambda m, r: r.last + 1)).alias("first"),
            F.lit(0).alias("last"), F.col("cid").alias("owner"), zero.alias("length"),
        ))),
        lambda r: F.struct((-r.first).alias("leaves"), r.owner.alias("owner")),
    )
    segments = whole.select(
        F.col("runs")[0]["owner"].alias("tree"), "cid", "runs", order.alias("order"),
        added(shared).alias("position"), added(own).alias("length"),
    )
    placed = _placed(segments)
    at = placed.select(
        F.col("cid").alias("owner"), F.col("start").alias("o_start"), F.col("position").alias("o_position")
    )
    # each run at its owner's place: its position along the path is the same in both
    before = Window.partitionBy("cid").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    stretches = (
        runs.withColumn("along", F.coalesce(F.sum("length").over(before), zero))
        .join(at, "owner")
        .withColumn("from", F.col("o_start") + F.col("along") - F.col("o_position"))
        .groupBy("cid")
        .agg(F.sort_array(F.collect_list(F.struct(
            "first", "last", "owner", F.col("from").alias("start"),
            (F.col("from") + F.col("length")).alias("end"),
        ))).alias("attention"))
    )
    owned = paths.filter("owner = cid").withColumn(
        "inside", F.coalesce(F.sum("length").over(
            Window.partitionBy("cid").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
        ), zero)
    )
    nodes = (
        every.drop("node", "length").join(owned.select("cid", "idx", "inside"), ["cid", "idx"])
        .join(placed.select("tree", "cid", F.col("start").alias("s_start"), "position"), "cid")
        .select(
            "tree", "cid", "idx", (F.col("s_start") + F.col("inside")).alias("start"),
            (F.col("position") + F.col("inside")).alias("position"),
            "formatted", "loss_start", "loss_end",
        )
    )
    return Forest(
        nodes,
        placed.select("tree", "cid", "start", "position", "length").join(stretches, "cid"),
    )


def _placed(segments: DataFrame) -> DataFrame:
    """Segments with their start in the tree's stream: sums inside slices of the order."""
    sliced = stage(
        segments.select("tree", "cid", "order", "position", "length")
        .repartitionByRange("tree", "order")
        .sortWithinPartitions("tree", "order")
        .withColumn("slice", F.spark_partition_id()),
        "segments",
    )
    sums = sliced.groupBy("tree", "slice").agg(F.sum("length").alias("in_slice"))
    earlier = Window.partitionBy("tree").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "tree", "slice", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("tree", "slice").orderBy("order").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return stage(
        sliced.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
        .join(before, ["tree", "slice"])
        .select("tree", "cid", "position", "length", (F.col("before") + F.col("inside")).alias("start")),
        "placed-segments",
    )


# ---------------------------------------------------------------- reading back


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted formatted turns to one row per conversation, held as running digests."""
    names = ["cid", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    last, state = None, None
    for batch in batches:
        rows = []
        for cid, formatted, start, end in zip(
            batch["cid"], batch["formatted"], batch["loss_start"], batch["loss_end"], strict=True
        ):
            if cid != last:
                if state:
                    rows.append((last, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                last, state = cid, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_turn(formatted)
            learned = unescape(formatted[start:end])
            state[0] += 1
            state[1].update(utf8(f"{role}\n{text}\n"))
            state[2] += len(learned)
            state[3].update(utf8(learned))
            state[4] += len(formatted)
        yield pd.DataFrame(rows, columns=names)
    if state:
        yield pd.DataFrame(
            [(last, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])],
            columns=names,
        )


def read_conversations(forest: Forest) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Every conversation is put together from the streams: its nodes are those that begin inside the
    stretches of its attention, in the order of their positions. Stretches and nodes meet in cells
    of a stream, of which a stretch has one per ``CELL`` code points.
    """
    parts = int(forest.nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = lambda place: F.floor(place / CELL)
    wanted = forest.segments.select("tree", "cid", F.explode("attention").alias("a")).select(
        "tree", F.col("cid").alias("reader"), F.col("a.start").alias("a_start"), F.col("a.end").alias("a_end"),
        F.explode(F.sequence(cell(F.col("a.start")), cell(F.col("a.end") - 1))).alias("cell"),
    )
    streams = forest.nodes.select(
        "tree", cell(F.col("start")).alias("cell"), "start", "position", "formatted", "loss_start", "loss_end"
    )
    found = (
        wanted.join(streams, ["tree", "cell"])
        .filter((F.col("start") >= F.col("a_start")) & (F.col("start") < F.col("a_end")))
        .select(F.col("reader").alias("cid"), "position", "formatted", "loss_start", "loss_end")
        .repartition(parts, "cid")
        .sortWithinPartitions("cid", "position")
    )
    kinds = (
        "cid long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    return found.mapInPandas(_digests, kinds).select(
        F.when(F.col("cid") != NO_ID, F.col("cid")).alias("conv_id"),
        "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
    )


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns, and conversation -7, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = turns.sparkSession.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, ASSISTANT, said)],
        "conv_id long, turn long, role string, text string",
    )
    turn: Column = F.col("turn").cast("long")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), "role", "text").unionByName(probe)


def formatted_conversations(turns: DataFrame) -> DataFrame:
    return read_conversations(build_forest(with_probe(turns)))
