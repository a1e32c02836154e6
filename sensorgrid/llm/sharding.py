"""Shards of nearly equal bytes from a k-d tree over the documents' metadata.

The tree starts with all rows. A node that has to become k shards is cut along its
widest dimension (extent relative to the whole table's) where the rows to the left
weigh floor(k/2)/k of its bytes, until every leaf is one shard, that is, holds the
target bytes. A cut is a distributed weighted median: one aggregation puts the
bytes of all open nodes into ``BINS`` bins, the bin that holds the median is
divided again, and equal values are told apart by a hash, so that even a dimension
with a single value can be cut. The driver sees bins, cuts, and at most ``BINS`` rows
(three numbers each) of the bin that holds a median.

Cases: null text weighs its 8 bytes of overhead; null metadata sorts before all
values; rows that repeat a doc_id, or a whole row, are placed one by one; with fewer
rows than shards some shards stay empty; an empty table gives no rows; columns of the
input other than the named ones are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sensorgrid.llm.common import saved, utf8_bytes

SHARDS = 24
OVERHEAD_BYTES = 8
BINS = 2048
# A cut is close enough if it is off by this part of the node's bytes.
TOLERANCE = 1e-4
SLOT_BLOCK_ROWS = 20_000
DIMENSIONS = ("d_id", "d_size", "d_lang", "d_source")
TIE = "tie"
TIE_END = 1 << 62


@dataclass
class Node:
    shards: int
    first: int
    axis: str | None = None
    value: int = 0
    tie: int = 0
    children: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]

    def column(self) -> Column:
        """First shard of the leaf a row belongs to."""
        if not self.children:
            return F.lit(self.first)
        left, right = self.children
        goes_left = (F.col(self.axis) < self.value) | (
            (F.col(self.axis) == self.value) & (F.col(TIE) < self.tie)
        )
        return F.when(goes_left, left.column()).otherwise(right.column())


def points(docs: DataFrame) -> DataFrame:
    """One narrow row per document: its weight and its place in each dimension."""
    size = utf8_bytes() + OVERHEAD_BYTES
    category = lambda c: F.coalesce(F.crc32(F.encode(F.col(c), "UTF-8")), F.lit(-1))
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.cast("long").alias("size"),
        crc.alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("d_id"),
        (F.log2(size) * 1_000_000).cast("long").alias("d_size"),
        category("lang").alias("d_lang"),
        category("source").alias("d_source"),
    ).withColumn(
        # Fixed once written; the row's number tells whole copies apart.
        TIE, F.xxhash64("doc_id", "text_crc32", F.monotonically_increasing_id()).bitwiseAND(TIE_END - 1)
    )


def kd_tree(point: DataFrame, shards: int) -> Node:
    """The tree's cuts, found level by level; ``point`` is read a few times per level."""
    root = Node(shards, 0)
    whole: dict[str, int] = {}
    while open_nodes := {n.first: n for n in root.leaves() if n.shards > 1}:
        marked = point.withColumn("node", root.column())
        rows = (
            marked.groupBy("node")
            .agg(
                F.sum("size").alias("size"),
                *[f(d).alias(f"{f.__name__}_{d}") for d in DIMENSIONS for f in (F.min, F.max)],
            )
            .where(F.col("node").isin(list(open_nodes)))
            .collect()
        )
        whole = whole or {d: max((r[f"max_{d}"] - r[f"min_{d}"] for r in rows), default=0) or 1 for d in DIMENSIONS}
        searches = []
        for r in rows:
            node = open_nodes[r["node"]]
            node.axis = max(DIMENSIONS, key=lambda d: (r[f"max_{d}"] - r[f"min_{d}"]) / whole[d])
            searches.append(
                _Search(node, r["size"], r["size"] * (node.shards // 2) / node.shards,
                        r[f"min_{node.axis}"], r[f"max_{node.axis}"] + 1)
            )
        while unsettled := [s for s in searches if not s.settled]:
            _narrow(marked, unsettled)
        for node in open_nodes.values():
            node.axis = node.axis or DIMENSIONS[0]  # a node without rows
            left = node.shards // 2
            node.children = [Node(left, node.first), Node(node.shards - left, node.first + left)]
    return root


@dataclass
class _Search:
    """Where the weighted median of one node can still be: in [low, high) of ``by``."""

    node: Node
    total: int
    target: float
    low: int
    high: int
    by: str = ""
    before: int = 0
    rows_left: int = 1 << 62
    settled: bool = False

    def __post_init__(self) -> None:
        self.by = self.by or self.node.axis

    @property
    def step(self) -> int:
        return (self.high - self.low - 1) // BINS + 1

    def rows(self) -> Column:
        inside = (F.col(self.by) >= self.low) & (F.col(self.by) < self.high)
        if self.by == TIE:
            inside = inside & (F.col(self.node.axis) == self.node.value)
        return (F.col("node") == self.node.first) & inside

    def bin(self) -> Column:
        return ((F.col(self.by) - self.low) / self.step).cast("long")

    def close(self, weight: int, running: int) -> bool:
        """Whether this row, or bin, belongs to the left of the cut."""
        return self.target - running > running + weight - self.target

    def take_bins(self, bins: list[tuple[int, int, int]]) -> None:
        """Settles, or narrows to the bin that the target falls into."""
        step, running = self.step, self.before
        for k, weight, rows in sorted(bins):
            if running + weight < self.target:
                running += weight
                continue
            start = self.low + k * step
            off = min(self.target - running, running + weight - self.target)
            if off <= TOLERANCE * self.total:
                self._cut(start + step if self.close(weight, running) else start)
            elif step == 1 and self.by != TIE:
                self.node.value = start
                self.by, self.low, self.high = TIE, 0, TIE_END
            else:
                self.low, self.high = start, min(start + step, self.high)
            self.before, self.rows_left = running, rows
            return
        self._cut(self.high)

    def take_rows(self, rows: list[tuple[int, int, int]]) -> None:
        """Settles among the few rows that are left."""
        running = self.before
        for value, tie, weight in sorted(rows):
            if running + weight >= self.target and not self.close(weight, running):
                self.node.value, self.node.tie = value, tie
                self.settled = True
                return
            running += weight
            self.node.value, self.node.tie = value, tie + 1
        self.settled = True

    def _cut(self, at: int) -> None:
        if self.by == TIE:
            self.node.tie = at
        else:
            self.node.value, self.node.tie = at, 0
        self.settled = True


def _narrow(marked: DataFrame, searches: list[_Search]) -> None:
    """One pass over the rows that can still hold a median, for all nodes together."""
    for few in (True, False):
        some = [s for s in searches if (s.rows_left <= BINS) == few]
        if not some:
            continue
        inside, place, value = F.lit(False), F.lit(None).cast("long"), F.lit(None).cast("long")
        for s in some:
            own = F.col("node") == s.node.first
            inside = inside | s.rows()
            place = F.when(own, s.bin()).otherwise(place)
            value = F.when(own, F.col(s.node.axis)).otherwise(value)
        rows = marked.where(inside)
        if few:
            rows = rows.select("node", value.alias("value"), TIE, "size")
        else:
            rows = rows.groupBy("node", place.alias("bin")).agg(F.sum("size").alias("w"), F.count("*").alias("n"))
        found: dict[int, list[tuple]] = {s.node.first: [] for s in some}
        for r in rows.collect():
            found[r["node"]].append(tuple(r)[1:])
        for s in some:
            (s.take_rows if few else s.take_bins)(found[s.node.first])


def with_slots(placed: DataFrame, block_rows: int = SLOT_BLOCK_ROWS) -> DataFrame:
    """``slot``: gapless numbers from 0 in each shard.

    A shard is dealt into blocks by hash; rows are numbered inside a block and
    blocks by a running sum of their counts, so no task sorts a whole shard.
    """
    blocks = max(1, placed.count() // (SHARDS * block_rows) + 1)
    dealt = placed.withColumn("block", F.pmod(F.shiftright(TIE, 7), F.lit(blocks)))
    before = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", "block")
        .agg(F.count("*").alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = F.row_number().over(W.partitionBy("shard", "block").orderBy(TIE, "doc_id", "text_crc32"))
    return (
        dealt.withColumn("k", inside)
        .join(starts, ["shard", "block"])
        .withColumn("slot", F.col("start") + F.col("k") - 1)
        .drop("block", "k", "start")
    )


def shard_by_bytes(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Documents with shard and slot; give the number of shards or their bytes."""
    point = saved(points(docs), "kd-points")
    if target_bytes:
        total = point.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    root = kd_tree(point, shards or SHARDS)
    return with_slots(point.withColumn("shard", root.column().cast("int")))
