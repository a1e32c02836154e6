"""Conversations formatted as trees: turns that conversations share from their start are one node.

A node is a turn together with all turns before it. Conversations are sorted by their
chains of nodes; the first of those that pass through a node owns it, so nodes by owner
and depth are in depth-first order, and the running sum of their tokens is where each
stands in one packed sequence. Every node's tokens are emitted once, with

- ``position``: the position id of its first token, which is the number of tokens of its
  ancestors (the ids of its other tokens follow),
- ``attends``: the intervals of the packed sequence that its ancestors fill, those that
  touch made one; a token sees these and what stands before it in its own node,
- ``loss_from``, ``loss_to``: its tokens under the loss mask, the text of an assistant's turn.

A turn is written ``<turn ROLE>TEXT</turn>`` and a line feed. Inside roles and texts a
backslash becomes two and the angle brackets ``\\l`` and ``\\g``, so no control string can
stand there, and reading back is exact. Mark, text and end are encoded each by itself,
so a node's tokens do not depend on what follows and the mask ends with a token.

Nothing of a tree is gathered: a first turn that a third of all conversations share is
one row, joined with them by number. Only the turns of one conversation, as
the tables have them, meet in one place.

Cases: a null text is empty, a null role too; turns go by turn, a null turn first, ties
by role and text; rows that repeat are turns of their own; a null conv_id is one
conversation; equal conversations share all nodes; very long texts are encoded one by
one; an empty table gives no rows; columns other than conv_id, turn, role and text are not
looked at.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.llm.common import arrow_map, saved

# The template, and what stands for signs that control strings are made of.
OPEN, CLOSE, END = "<turn ", ">", "</turn>\n"
ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
LOSS_ROLE = "assistant"

_ESCAPE = str.maketrans(ESCAPES)
#: Characters of text that are encoded at a time.
ENCODE_CHARS = 1 << 20


def escape(text: str) -> str:
    return text.translate(_ESCAPE)


def unescape(text: str) -> str:
    parts = text.split("\\\\")
    for written, sign in (("\\l", "<"), ("\\g", ">")):
        parts = [p.replace(written, sign) for p in parts]
    return "\\".join(parts)


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    if not (formatted.startswith(OPEN) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, found, text = formatted[len(OPEN) : -len(END)].partition(CLOSE)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape(role), unescape(text)


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def chains(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, chain): every conversation's turns in order and the nodes it passes through."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role"), empty("text"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for told in batch.column("turns"):
                chain, last = [], b""
                for t in told.as_py():
                    own = f"{len(t['role'])}:{t['role']}{t['text']}".encode()
                    last = hashlib.blake2b(last + own, digest_size=16).digest()
                    chain.append(last)
                out.append(chain)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turns"), pa.array(out, pa.list_(pa.binary()))], ["conv_id", "turns", "chain"]
            )

    kind = "conv_id long, turns array<struct<turn:long,role:string,text:string>>, chain array<binary>"
    return arrow_map(held, task, kind)


class Forest:
    """The packed sequence of one table of turns; every intermediate result is written.

    ``packed`` has a row for each node, ``paths`` one for each turn of a conversation.
    """

    def __init__(self, turns: DataFrame, vocabulary: str) -> None:
        self.vocabulary = vocabulary
        told = chains(turns)
        n = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        order = [F.col("chain"), F.col("conv_id").asc_nulls_first()]
        told = told.repartitionByRange(n, *order).sortWithinPartitions(*order)
        self.told = saved(told.withColumn("rank", F.monotonically_increasing_id()), "chat-conversations")
        place = self.told.select("conv_id", "rank", F.posexplode("chain").alias("depth", "node"))
        owner = place.groupBy("node").agg(F.min("rank").alias("owner"))
        self.placed = saved(self._start(owner), "chat-nodes")
        self.paths = self._paths(place)
        self.packed = self._packed()

    def _start(self, owner: DataFrame) -> DataFrame:
        """Every node's tokens, in depth-first order, with their place in the packed sequence."""
        vocabulary = self.vocabulary

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokenizer = _tokenizer(vocabulary)
            for batch in batches:
                heads = [f"{OPEN}{escape(r)}{CLOSE}" for r in batch.column("role").to_pylist()]
                texts = [escape(t) for t in batch.column("text").to_pylist()]
                tail = tokenizer.encode(END, add_special_tokens=False).ids
                head = [x.ids for x in tokenizer.encode_batch(heads, add_special_tokens=False)]
                body, first = [], 0
                while first < len(texts):
                    last, size = first, 0
                    while last < len(texts) and (last == first or size + len(texts[last]) <= ENCODE_CHARS):
                        size, last = size + len(texts[last]), last + 1
                    body += [x.ids for x in tokenizer.encode_batch(texts[first:last], add_special_tokens=False)]
                    first = last
                loss = [r == LOSS_ROLE for r in batch.column("role").to_pylist()]
                columns = {
                    "tokens": pa.array([h + b + tail for h, b in zip(head, body)], pa.list_(pa.int32())),
                    "loss_from": pa.array([len(h) if on else 0 for h, on in zip(head, loss)], pa.int32()),
                    "loss_to": pa.array([len(h) + len(b) if on else 0 for h, b, on in zip(head, body, loss)], pa.int32()),
                }
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("node", "owner", "depth")), *columns.values()], ["node", "owner", "depth", *columns]
                )

        def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                at = []
                for size in batch.column("size").to_pylist():
                    at.append(total)
                    total += size
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], [*batch.schema.names, "local"])

        turn = self.told.select("rank", F.posexplode(F.arrays_zip("chain", "turns")).alias("depth", "at"))
        turn = turn.select(F.col("at.chain").alias("node"), "rank", "depth", "at.turns.role", "at.turns.text")
        # One row of ``turn`` for each node: that of its owner.
        own = turn.join(owner.toDF("own", "owner"), (F.col("node") == F.col("own")) & (F.col("rank") == F.col("owner")))
        kind = "node binary, owner long, depth int, tokens array<int>, loss_from int, loss_to int"
        encoded = saved(arrow_map(own.select("node", "owner", "depth", "role", "text"), encode, kind), "chat-tokens")
        n = max(1, int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        sizes = encoded.select("node", "owner", "depth", F.size("tokens").cast("long").alias("size"))
        sizes = sizes.repartitionByRange(n, "owner", "depth").sortWithinPartitions("owner", "depth")
        local = arrow_map(sizes, running, "node binary, owner long, depth int, size long, local long")
        local = saved(local.withColumn("part", F.spark_partition_id()), "chat-order")
        # One number for each partition; the partitions are in the order of the nodes.
        totals = sorted(tuple(r) for r in local.groupBy("part").agg(F.sum("size")).collect())
        base, starts = 0, []
        for part, total in totals:
            starts.append((part, base))
            base += total
        bases = local.sparkSession.createDataFrame(starts, "part int, base long")
        start = local.join(F.broadcast(bases), "part").select("node", (F.col("base") + F.col("local")).alias("start"), "size")
        return encoded.join(start, "node")

    def _paths(self, place: DataFrame) -> DataFrame:
        """(conv_id, rank, path) of every conversation: depth, start, size and owner of the nodes on its path."""
        where = self.placed.select("node", "start", "size", "owner")
        nodes = place.join(where, "node").groupBy("conv_id", "rank").agg(
            F.sort_array(F.collect_list(F.struct("depth", "start", "size", "owner"))).alias("path")
        )
        return saved(nodes, "chat-paths")

    def _packed(self) -> DataFrame:
        """(start, tokens, depth, tree, position, attends, loss_from, loss_to) of every node."""

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for rank, path in zip(batch.column("rank").to_pylist(), batch.column("path").to_pylist()):
                    position, attends = 0, []
                    for n in path:
                        if n["owner"] == rank:
                            rows.append((n["start"], path[0]["start"], position, [dict(a) for a in attends]))
                        position += n["size"]
                        end = n["start"] + n["size"]
                        if attends and attends[-1]["stop"] == n["start"]:
                            attends[-1]["stop"] = end
                        else:
                            attends.append({"start": n["start"], "stop": end})
                kinds = {"start": pa.int64(), "tree": pa.int64(), "position": pa.int64(),
                         "attends": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))}
                columns = zip(*rows) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))

        kind = "start long, tree long, position long, attends array<struct<start:long,stop:long>>"
        seen = arrow_map(self.paths.select("rank", "path"), task, kind)
        return saved(self.placed.drop("node", "size", "owner").join(seen, "start"), "chat-packed")

    def read(self) -> DataFrame:
        """Every conversation as the packed sequence gives it back."""
        vocabulary = self.vocabulary

        def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokenizer = _tokenizer(vocabulary)
            for batch in batches:
                tokens = batch.column("tokens").to_pylist()
                spans = zip(batch.column("loss_from").to_pylist(), batch.column("loss_to").to_pylist())
                whole = tokenizer.decode_batch(tokens, skip_special_tokens=False)
                loss = tokenizer.decode_batch([t[a:b] for t, (a, b) in zip(tokens, spans)], skip_special_tokens=False)
                role, text = zip(*map(read_turn, whole)) if whole else ((), ())
                strings = (role, text, [unescape(x) for x in loss])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("start"), *(pa.array(c, pa.string()) for c in strings), pa.array(map(len, whole), pa.int64())],
                    ["start", "role", "text", "loss", "size"],
                )

        kind = "start long, role string, text string, loss string, size long"
        nodes = saved(arrow_map(self.packed.select("start", "tokens", "loss_from", "loss_to"), decode, kind), "chat-read")
        path = self.paths.select("conv_id", F.explode("path").alias("at")).select("conv_id", "at.depth", "at.start")
        turn = F.struct("depth", "role", "text", "loss", "size")
        return path.join(nodes, "start").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def format_conversations(turns: DataFrame, vocabulary: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation."""
    joined = lambda f: F.array_join(F.transform("turns", f), "")
    loss = joined(lambda t: t["loss"])
    return Forest(turns, vocabulary).read().select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        _sha256(joined(lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), _sha256(loss).alias("loss_sha256"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + t["size"]).alias("formatted_chars"),
    )
