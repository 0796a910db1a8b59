"""Operator 5: chat formatting as prefix trees.

Conversations that share their first turns share nodes of a tree; a tree is
emitted depth-first as one sequence, so a shared turn's tokens (code points here)
appear once.  Each node carries the position id of its first token, which is the
number of tokens on its path before it, and the intervals of the sequence that
its ancestors take, which are what its tokens may attend to besides their own
node's past.

Depth-first order is the order of whole conversations by the digests of their
turns: a node belongs to the first conversation that runs through it.  No tree is
ever gathered; hot first turns are aggregated map-side.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.numbering import prefix_sums, ranks
from quern.store import materialize, table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """No '<|' is left; ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's string, and where its text lies in it."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


_CHAINED = "conv_id long, at long, node binary, parent binary, tree binary, chunk string, position long, length long, loss_start long, loss_end long, path binary"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each turn, and after a conversation's last turn one with its path (the
    turns' digests); rows come by conversation and turn."""
    names = [x.split()[0] for x in _CHAINED.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    types = [kinds[x.split()[1]] for x in _CHAINED.split(", ")]
    last: object = names  # no conversation's id
    at = position = 0
    node = tree = b""
    path = bytearray()

    def done() -> tuple:
        return (last, at, node, None, tree, None, position, None, None, None, bytes(path))

    for batch in batches:
        out = []
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if conv != last:
                if last is not names:
                    out.append(done())
                last, at, position, node, tree = conv, 0, 0, b"", b""
                path = bytearray()
            chunk, a, b = format_turn(role, text)
            turn = hashlib.blake2b(chunk.encode(), digest_size=16).digest()
            parent, node = node, hashlib.blake2b(node + turn, digest_size=16).digest()
            tree = tree or node
            path += turn[:10]
            out.append((conv, at, node, parent, tree, chunk, position, len(chunk), a if role == "assistant" else 0, b if role == "assistant" else 0, None))
            at, position = at + 1, position + len(chunk)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=names)
    if last is not names:
        out = [done()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=names)


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_INTERVALS = "node binary, attends array<struct<start:bigint,end:bigint>>"


def _attend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node that a path owns, the intervals of its ancestors; rows come by path and depth."""
    last, spans = None, []
    for batch in batches:
        nodes, attends = [], []
        for rank, node, owner, start, end in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
            if rank != last:
                last, spans = rank, []
            if owner == rank:
                nodes.append(node)
                attends.append([{"start": a, "end": b} for a, b in spans])
            if spans and spans[-1][1] == start:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(attends, pa.list_(_SPAN))], names=["node", "attends"])


def pack(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(packed, paths).

    packed, one row for each node: tree, start, end (places in the tree's
    sequence), position (id of its first token), attends (intervals of its
    ancestors, adjacent ones joined), loss_start, loss_end (places in the chunk
    that are trained on; equal where there are none), chunk (its string).
    paths: conv_id, at, tree, start: the nodes of each conversation.

    Turns go by turn, then role and text.  A null text or role is empty; rows with
    a null conv_id are one conversation; repeated rows are turns of their own;
    equal conversations share all nodes.  An empty table gives no rows; further
    columns are ignored.  A conversation is read as a stream, one turn in memory.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    chained = materialize(rows.mapInArrow(_chain, _CHAINED), "chained")
    ends = chained.where("path IS NOT NULL").select("conv_id", "path", F.col("at").alias("turns"))
    turns = chained.where("path IS NULL").drop("path")

    one = ends.groupBy("path").agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("c")).select("path", F.col("c.conv_id").alias("conv_id"))
    ranked = materialize(ranks(one, [F.col("path")], "rank").select("rank", F.col("conv_id").alias("c")), "ranked")
    own = turns.join(ranked, turns.conv_id.eqNullSafe(F.col("c"))).drop("c")  # each different conversation once
    nodes = own.groupBy("node").agg(F.min("rank").alias("owner"), *[F.first(c).alias(c) for c in ("at", "tree", "chunk", "position", "length", "loss_start", "loss_end")])
    placed = prefix_sums(nodes, [F.col("owner"), F.col("at")], F.col("length"), "from")
    placed = materialize(placed, "placed")
    roots = placed.where("at = 0").select(F.col("tree").alias("t"), F.col("from").alias("base"))
    placed = placed.join(roots, placed.tree == roots.t).withColumn("start", F.col("from") - F.col("base")).withColumn("end", F.col("start") + F.col("length")).drop("t", "base", "from")
    placed = materialize(placed, "trees")

    spans = placed.select(F.col("node").alias("n"), "owner", "start", "end")
    walk = own.select("rank", "at", "node").join(spans, F.col("node") == F.col("n")).select("rank", "at", "node", "owner", "start", "end")
    walk = walk.repartition("rank").sortWithinPartitions("rank", "at")
    attends = walk.mapInArrow(_attend, _INTERVALS).withColumnRenamed("node", "n")
    packed = placed.join(attends, placed.node == F.col("n")).select("tree", "start", "end", "position", "attends", "loss_start", "loss_end", "chunk")
    starts = placed.select(F.col("node").alias("n"), "start")
    paths = turns.select("conv_id", "at", "tree", "node").join(starts, F.col("node") == F.col("n")).select("conv_id", "at", "tree", "start")
    return materialize(packed, "packed"), materialize(paths, "paths")


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _READ.split(", ")]
    nothing = names
    last: object = nothing
    state: list = []

    def done() -> tuple:
        turns, loss, n, chars, length = state
        return (last, n, turns.hexdigest(), chars, loss.hexdigest(), length)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string() if "sha256" in n else pa.int64()) for i, n in enumerate(names)], names=names)

    for batch in batches:
        out = []
        for conv, chunk, a, b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if conv != last:
                if last is not nothing:
                    out.append(done())
                last, state = conv, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
            for role, text in parse(chunk):
                state[0].update(f"{role}\n{text}\n".encode())
                state[2] += 1
            learned = unescape(chunk[a:b])
            state[1].update(learned.encode())
            state[3] += len(learned)
            state[4] += len(chunk)
        if out:
            yield batch_of(out)
    if last is not nothing:
        yield batch_of([done()])


def read_back(packed: DataFrame, paths: DataFrame) -> DataFrame:
    """Per conversation, from the packed trees: see ``_READ``."""
    node = packed.select(F.col("tree").alias("t"), F.col("start").alias("s"), "chunk", "loss_start", "loss_end")
    rows = paths.join(node, (paths.tree == F.col("t")) & (paths.start == F.col("s"))).select("conv_id", "at", "chunk", "loss_start", "loss_end")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "at").select("conv_id", "chunk", "loss_start", "loss_end")
    return rows.mapInArrow(_digest, _READ)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return read_back(*pack(rows))
