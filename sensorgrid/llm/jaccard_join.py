"""Documents whose sets of word shingles are similar, joined by trees over group counts.

A document's set is a point: its tokens are hashed into ``GROUPS`` groups, and the
coordinates are the groups' counts. Two sets overlap by no more than the sum of the
smaller coordinates, so a pair, or two pages of a tree by their largest coordinates,
can be ruled out without the sets. They also differ in no fewer tokens than there are
groups, of ``PARITIES`` finer ones, whose counts are odd in one set and even in the other.
What survives is verified on the sets.

A ball of the radius that a similarity of 0.85 allows holds most documents of like
size, so one tree over all points would compare almost all of them. The root is
therefore fanned out by token: two similar sets share one of the first
``n - ceil(0.85 n) + 1`` tokens of any common order, and below each such token stands a
tree of its documents. The order is by rarity, from a sketch of a fixed number of
counters over the shingles of all documents, so passages that many documents share
come last; any sketch gives the same links, a good one fewer candidates. All sets have
that order in common: below the first token that two sets share, they can share no more
than what follows it in either, so a token that stands late in its set meets few others.

Equal sets are one class. Every tree has a leader. A class is first compared with two
of the leaders it meets, which finds the components of near copies in linear work; what
is then left to compare are pairs of different components, page by page. A pair inside
a component needs no comparison, so no group emits all its pairs and no link between
components is lost.

Cases: null or empty text, or one without words, has an empty set, linked with nothing;
fewer words than a shingle are one shingle; a null doc_id is linked like any other and
does not name a component unless it is alone; rows that repeat are one class; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.llm.bitmap import bitmap, fitting, in_bitmap
from sensorgrid.llm.common import arrow_map, discard, fresh, saved, settle, text_digest
from sensorgrid.llm.components import components
from sensorgrid.llm.textscan import (
    LOWER, SPACE, mix, pieces, prefix_hash, rows_of, runs, segment_counts, shingle_hash, span_hash,
)

SHINGLE_WORDS = 4
SIMILAR, OF = 85, 100
GROUPS = 32
#: Groups of which only it is kept whether their counts are odd.
PARITIES = 512
PAGE_ROWS = 256
#: Up to so many classes below a token are compared by size and place before their counts are fetched.
FEW_ROWS = 16
SKETCH_BITS = 22
SLICE_BITS = 14
MERGE_FAN_IN = 64
#: The order tells counters above the mean apart by eighths of an octave.
LEVEL_STEPS = 8


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, token) of the distinct shingles of every row, sorted by both."""
    n = len(at) - 1
    sums = prefix_hash(LOWER[data])
    begin, end = runs(~SPACE[data], at)
    row = rows_of(begin, at)
    word = span_hash(sums, begin, end)
    count = segment_counts(row, n)
    token = shingle_hash(word, size)
    whole = row[: len(token)] == row[size - 1 :] if len(token) else np.zeros(0, bool)
    rows, tokens = [row[: len(token)][whole]], [token[whole]]
    head = np.concatenate(([0], np.cumsum(count)))
    for r in np.flatnonzero((count > 0) & (count < size)):
        rows.append(np.array([r]))
        tokens.append(shingle_hash(word[head[r] : head[r + 1]], int(count[r])) ^ np.uint64(count[r]))
    row, token = np.concatenate(rows), np.concatenate(tokens)
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    return row[first], token[first]


def token_sketch(docs: DataFrame, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Level of every counter: how far its count over all documents is above the mean.

    A task adds up its documents' tokens in 2**SKETCH_BITS counters and sends them in
    slices; slices are added ``MERGE_FAN_IN`` at a time, so no task holds more than that
    many. The driver gets as many counters as one task has, whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            for _, _, data, at in pieces(batch.column("text")):
                _, token = shingle_sets(data, at, size)
                held.append((token >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                if sum(map(len, held)) > 1 << SKETCH_BITS:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held = []
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        parts = total.reshape(-1, 1 << SLICE_BITS)
        if total.any():
            yield pa.RecordBatch.from_pydict(
                {"slice": pa.array(range(len(parts)), pa.int32()),
                 "counts": pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())}
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << SLICE_BITS, np.int64)
        for cell in table.column("counts"):
            total += np.frombuffer(zlib.decompress(cell.as_py()), np.int64)
        return pa.table({"slice": table.column("slice")[:1], "part": table.column("to")[:1],
                         "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    text = docs.select("text")
    tasks = max(1, text.rdd.getNumPartitions())
    parts = arrow_map(text, count, "slice int, counts binary").withColumn("part", F.spark_partition_id().cast("long"))
    while True:
        fan = (F.col("part") / MERGE_FAN_IN).cast("long") if tasks > MERGE_FAN_IN else F.lit(0).cast("long")
        parts = parts.withColumn("to", fan).groupBy("slice", "to").applyInArrow(add, "slice int, part long, counts binary")
        if tasks <= MERGE_FAN_IN:
            break
        tasks = -(-tasks // MERGE_FAN_IN)
    total = np.zeros((1 << (SKETCH_BITS - SLICE_BITS), 1 << SLICE_BITS), np.int64)
    for r in parts.select("slice", "counts").collect():
        total[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    flat = total.reshape(-1)
    above = np.log2(np.maximum(flat / max(flat.mean(), 1.0), 1.0))
    return np.minimum(LEVEL_STEPS * above, 255).astype(np.uint8)


def prefix_size(n: int, similar: int = SIMILAR, of: int = OF) -> int:
    """Tokens a set is filed under: with fewer in common than the rest, sets are not similar."""
    return n - (similar * n + of - 1) // of + 1


def set_name(members: np.ndarray) -> int:
    """A number for a set: a sum does not depend on the order of its members."""
    total = np.sum(mix(members + np.uint64(1)), dtype=np.uint64) + np.uint64(len(members))
    return int(mix(np.array([total])).view(np.int64)[0])


def points(docs: DataFrame, level: np.ndarray, size: int, similar: int, of: int) -> DataFrame:
    """Every row's class, size, group counts, parities and the tokens it is filed under, in order."""
    held = docs.sparkSession.sparkContext.broadcast(level.tobytes())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            kind, number, vector, odd, prefix = [], [], [], [], []
            for _, _, data, at in pieces(batch.column("text")):
                row, token = shingle_sets(data, at, size)
                n = len(at) - 1
                ends = np.cumsum(segment_counts(row, n))
                rank = levels[(token >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                for r in range(n):
                    own = token[(ends[r - 1] if r else 0) : ends[r]]
                    number.append(len(own))
                    if not len(own):
                        kind.append(0), vector.append(None), odd.append(None), prefix.append(None)
                        continue
                    order = np.lexsort((own, rank[(ends[r - 1] if r else 0) : ends[r]]))[: prefix_size(len(own), similar, of)]
                    kind.append(set_name(own))
                    vector.append(np.bincount((own & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS))
                    fine = np.bincount((own & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
                    odd.append(np.packbits(fine & 1).view(np.int64))
                    prefix.append(own[order].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("digest"), pa.array(kind, pa.int64()),
                    pa.array(number, pa.int64()), pa.array(vector, pa.list_(pa.int32())), pa.array(odd, pa.list_(pa.int64())),
                    pa.array(prefix, pa.list_(pa.int64())),
                ],
                ["doc_id", "digest", "class", "n", "groups", "odd", "prefix"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"), "text")
    kind = "doc_id long, digest string, class long, n long, groups array<int>, odd array<long>, prefix array<long>"
    return arrow_map(narrow, task, kind)


def set_arrays(docs: DataFrame, wanted: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(class, members) of the rows whose numbers are in the one column of ``wanted``, and of few others.

    The rows are picked where their texts lie, so neither texts nor other sets are moved.
    """
    wanted = saved(wanted, "jaccard-wanted")
    held = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, fitting(wanted.count())))
    discard(wanted)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = in_bitmap(held.value, batch.column("number").to_numpy().view(np.uint64)) if batch.num_rows else []
            names, members = [], []
            for _, _, data, at in pieces(batch.column("text").filter(pa.array(on, pa.bool_()))):
                row, token = shingle_sets(data, at, size)
                ends = np.cumsum(segment_counts(row, len(at) - 1))
                for own in np.split(token, ends[:-1]):
                    names.append(set_name(own))
                    members.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(members, pa.list_(pa.int64()))], ["class", "members"]
            )

    return arrow_map(_numbered(docs).select("number", "text"), task, "class long, members array<long>")


def _numbered(docs: DataFrame) -> DataFrame:
    """doc_id, digest and text, with a number for what is in the row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"), "text")
    return rows.withColumn("number", F.xxhash64("doc_id", "digest"))


def tokens_among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, n, place, token) of the tokens that are in the one column of ``wanted``, and of few others."""
    held = rows.sparkSession.sparkContext.broadcast(bitmap(wanted, fitting(wanted.count())))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            token = prefix.flatten().to_numpy()
            length = prefix.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(length)), length)
            place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
            on = np.flatnonzero(in_bitmap(held.value, token.view(np.uint64)))
            at = pa.array(row[on])
            yield pa.RecordBatch.from_arrays(
                [batch.column("class").take(at), batch.column("n").take(at), pa.array(place[on].astype(np.int32)), pa.array(token[on])],
                ["class", "n", "place", "token"],
            )

    return arrow_map(rows.select("class", "n", "prefix"), task, "class long, n long, place int, token long")


def minima(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)


class Join:
    """The join over one table of documents; every intermediate result is written."""

    def __init__(self, docs: DataFrame, size: int = SHINGLE_WORDS, similar: int = SIMILAR, of: int = OF) -> None:
        self.docs, self.size, self.similar, self.of = docs, size, similar, of
        self.rows = saved(points(docs, token_sketch(docs, size), size, similar, of), "jaccard-rows")
        filled = self.rows.where("n > 0")
        self.point = saved(
            filled.groupBy("class").agg(
                F.first("n").alias("n"), F.first("groups").alias("groups"), F.first("odd").alias("odd"),
                F.min(F.xxhash64("doc_id", "digest")).alias("one"),
            ),
            "jaccard-points",
        )
        self.tokens = filled.select("class", "n", F.posexplode("prefix").alias("place", "token"))
        self.temporary: list[DataFrame] = []

    def may_link(self, n1: Column, n2: Column, overlap: Column) -> Column:
        """Whether sets of these sizes that share ``overlap`` tokens are similar."""
        return (self.similar + self.of) * overlap >= self.similar * (n1 + n2)

    def near_counts(self, n1: Column, n2: Column, one: tuple[Column, Column], two: tuple[Column, Column]) -> Column:
        """Whether sets of these sizes, group counts and parities may be similar."""
        (groups1, odd1), (groups2, odd2) = one, two
        apart = F.lit(0)
        for k in range(PARITIES // 64):
            apart = apart + F.bit_count(odd1[k].bitwiseXOR(odd2[k]))
        # What the sets share is at most half of n1 + n2 - apart.
        near = self.may_link(2 * n1, 2 * n2, n1 + n2 - apart)
        # The sum over the groups is only made for pairs whose parities are near.
        return F.when(near, self.may_link(n1, n2, minima(groups1, groups2))).otherwise(False)

    def links(self) -> DataFrame:
        """Links that connect whatever is connected; not all links inside a component."""
        leaders = saved(
            self.tokens.groupBy("token").agg(F.min("class").alias("leader"), F.max("class").alias("last"))
            .where("leader != last").select("token", "leader"),
            "jaccard-leaders",
        )
        settle(self.docs.sparkSession)
        # Most tokens are in one class; only the others are sent on with their classes.
        met = tokens_among(self.rows.where("n > 0"), leaders.select("token"))
        shared = saved(met.join(leaders, "token"), "jaccard-shared")
        # Of the leaders that a class meets, the one it shares most tokens with, and the smallest.
        met = shared.where("class != leader").groupBy("class", "leader").agg(F.count("*").alias("n"))
        star = met.groupBy("class").agg(
            F.array(F.max(F.struct("n", "leader"))["leader"], F.min("leader")).alias("leaders")
        )
        discard(leaders)
        first = self.verified(star.select(F.explode(F.array_distinct("leaders")).alias("a"), F.col("class").alias("b")))
        group = saved(components(first), "jaccard-groups")
        rest = saved(self.across(shared, group), "jaccard-pairs")
        discard(shared, group, *self.temporary)
        found = first.unionByName(self.verified(rest, counted=True))
        discard(rest)
        return found

    def verified(self, pairs: DataFrame, counted: bool = False) -> DataFrame:
        """The pairs (a, b) that are similar: by size and counts, unless they are ``counted``, then by the sets."""
        near = pairs if counted else self._near(pairs)
        near = near if counted else saved(near, "jaccard-near")
        # The sets of either side are read where they are joined, and not kept.
        sets = {}
        for side in ("a", "b"):
            nodes = near.select(F.col(side).alias("class")).distinct()
            wanted = self.point.join(nodes, "class").select("one")
            sets[side] = set_arrays(self.docs, wanted, self.size).withColumnsRenamed({"class": side, "members": f"s{side}"})
        similar = self.may_link(F.size("sa"), F.size("sb"), F.size(F.array_intersect("sa", "sb")))
        linked = near.join(sets["b"], "b").join(sets["a"], "a").where(similar)
        linked = saved(linked.select("a", "b").distinct(), "jaccard-links")
        if not counted:
            discard(near)
        return linked

    def _near(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that may be similar by size and counts."""
        p = self.point.select("class", "n", "groups", "odd")
        return (
            pairs.join(p.withColumnsRenamed({"class": "a", "n": "na", "groups": "ga", "odd": "oa"}), "a")
            .join(p.withColumnsRenamed({"class": "b", "n": "nb", "groups": "gb", "odd": "ob"}), "b")
            .where(self.may_link(F.col("na"), F.col("nb"), F.least("na", "nb")))
            .where(self.near_counts(F.col("na"), F.col("nb"), (F.col("ga"), F.col("oa")), (F.col("gb"), F.col("ob"))))
            .select("a", "b")
        )

    def across(self, shared: DataFrame, group: DataFrame) -> DataFrame:
        """Pairs of classes that share a token, are of different components and may be similar.

        Trees with one component only are done. A tree of few classes is a single page.
        """
        named = shared.join(group, shared["class"] == group["node"], "left").select(
            "token", "class", "n", "place", F.coalesce("component", "class").alias("component")
        )
        mixed = saved(
            named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .where("lo != hi").select("token"),
            "jaccard-mixed",
        )
        settle(self.docs.sparkSession)
        entry = saved(named.join(mixed, "token").distinct(), "jaccard-entries")
        settle(self.docs.sparkSession)
        sizes = saved(entry.groupBy("token").agg(F.count("*").alias("rows")), "jaccard-sizes")
        self.temporary += [mixed, entry, sizes]
        rows = F.col("rows")
        few, some, many = (
            entry.join(sizes.where(on).select("token"), "token")
            for on in (rows <= FEW_ROWS, (rows > FEW_ROWS) & (rows <= PAGE_ROWS), rows > PAGE_ROWS)
        )
        met = few.groupBy("token").agg(self._rows("place").alias("rows1"))
        met = saved(self._pairs(met.withColumn("rows2", F.col("rows1")), self._may_meet), "jaccard-met")
        self.temporary.append(met)
        settle(self.docs.sparkSession)
        p = self.point.select("class", "groups", "odd")
        one = some.join(p, "class").groupBy("token").agg(self._rows("place", "groups", "odd").alias("rows1"))
        one = one.withColumn("rows2", F.col("rows1"))
        pages = one.select("rows1", "rows2").unionByName(self._opened(many.join(p, "class")))
        return self._near(met).unionByName(self._pairs(pages, self._may_be_similar)).distinct()

    @staticmethod
    def _rows(*more: str) -> Column:
        return F.collect_list(F.struct("class", "n", "component", *more))

    @staticmethod
    def _pairs(pages: DataFrame, wanted: Callable[[Column, Column], Column]) -> DataFrame:
        """The different pairs (a, b) of rows1 and rows2 that are wanted; the others never become rows."""
        found = F.flatten(F.transform("rows1", lambda x: F.transform(
            F.filter("rows2", lambda y: wanted(x, y)),
            lambda y: F.struct(F.least(x["class"], y["class"]).alias("a"), F.greatest(x["class"], y["class"]).alias("b")),
        )))
        return pages.select(F.explode(found).alias("pair")).select("pair.*").distinct()

    def _may_meet(self, x: Column, y: Column) -> Column:
        """Whether two entries of different components can be similar by size and place, each pair once in a page.

        If the token is not the first that the two sets share, the place may rule them out
        here; below the first it does not rule out similar sets.
        """
        other = (x["component"] != y["component"]) & (x["class"] < y["class"])
        left = F.least(x["n"] - x["place"], y["n"] - y["place"])
        return F.when(other, self.may_link(x["n"], y["n"], left)).otherwise(False)

    def _may_be_similar(self, x: Column, y: Column) -> Column:
        """The same by the counts as well."""
        near = self.near_counts(x["n"], y["n"], (x["groups"], x["odd"]), (y["groups"], y["odd"]))
        return F.when(self._may_meet(x, y), near).otherwise(False)

    def _opened(self, entry: DataFrame) -> DataFrame:
        """Pairs of pages (rows1, rows2) below the tokens with many classes.

        Classes are packed into pages by size and by the side of the mean on which their
        counts lie; pages whose largest counts cannot reach the overlap stay closed.
        """
        sides = F.aggregate(
            F.slice("groups", 1, 6), F.lit(0),
            lambda s, x: s * 2 + F.when(x * GROUPS > F.col("n"), F.lit(1)).otherwise(F.lit(0)),
        )
        band = F.floor(F.log("n") / float(-np.log(self.similar / self.of))).cast("int")
        entry = entry.withColumn("band", band).withColumn("side", sides)
        fill = saved(
            entry.groupBy("token", "band", "side").agg(F.ceil(F.count("*") / PAGE_ROWS).alias("pages")), "jaccard-fill"
        )
        self.temporary.append(fill)
        place = F.xxhash64("token", "band", "side", F.pmod(F.xxhash64("class"), F.col("pages")))
        largest = [F.max(F.col("groups")[g]).alias(f"g{g}") for g in range(GROUPS)]
        pages = saved(
            entry.join(fill, ["token", "band", "side"]).withColumn("page", place)
            .groupBy("token", "page")
            .agg(
                self._rows("place", "groups", "odd").alias("rows"), F.min("n").alias("least"), F.max("n").alias("most"),
                F.min("component").alias("lo"), F.max("component").alias("hi"), *largest,
            )
            .withColumn("top", F.array(*[f"g{g}" for g in range(GROUPS)])).drop(*[f"g{g}" for g in range(GROUPS)]),
            "jaccard-pages",
        )
        self.temporary.append(pages)
        one = pages.withColumnsRenamed({c: f"{c}1" for c in pages.columns if c != "token"})
        two = pages.withColumnsRenamed({c: f"{c}2" for c in pages.columns if c != "token"})
        least, most = F.col("least1") + F.col("least2"), minima(F.col("top1"), F.col("top2"))
        # Both orders of two pages are opened, as a pair of entries counts in one order only.
        return one.join(two, "token").where(
            (self.of * F.col("most1") >= self.similar * F.col("least2"))
            & (self.of * F.col("most2") >= self.similar * F.col("least1"))
            & ~((F.col("lo1") == F.col("hi1")) & (F.col("lo1") == F.col("lo2")) & (F.col("lo2") == F.col("hi2")))
            & ((self.similar + self.of) * most >= self.similar * least)
        ).select("rows1", "rows2")

    def grouped(self) -> DataFrame:
        """(doc_id, digest, n, component) of every row; component is a class, null for empty sets."""
        group = saved(components(self.links()), "jaccard-components")
        rows = self.rows.join(group, self.rows["class"] == group["node"], "left").select(
            "doc_id", "digest", "n",
            F.when(F.col("n") > 0, F.coalesce("component", "class")).alias("component"),
        )
        rows = saved(rows, "jaccard-grouped")
        discard(self.rows, self.point, group)
        return rows


def jaccard_components(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    rows = Join(docs, size).grouped()
    first = saved(
        rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id")), "jaccard-first"
    )
    return rows.join(first, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, similar: int = SIMILAR, of: int = OF) -> DataFrame:
    """One document of each group, that with the smallest doc_id; documents without words stay.

    Of rows equal in doc_id and text one stays, any of them where other columns differ.
    """
    rows = Join(docs, size, similar, of).grouped().where("component is not null")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    kept = saved(rows.groupBy("component").agg(F.min(order).alias("kept")), "jaccard-kept")
    keys = rows.join(kept, "component").where(order != F.col("kept"))
    drop = saved(keys.select("doc_id", "digest").distinct(), "jaccard-drop")
    repeats = saved(
        rows.groupBy("doc_id", "digest").agg(F.count("*").alias("times")).where("times > 1").select("doc_id", "digest"),
        "jaccard-repeats",
    )
    id_, text, *names = fresh(docs, "doc_number", "text_digest", "drop_id", "drop_digest", "twice_id", "twice_digest")
    marked = docs.withColumns({id_: F.col("doc_id").cast("long"), text: text_digest()})
    drop = drop.toDF(*names[:2])
    left = marked.join(drop, marked[id_].eqNullSafe(drop[names[0]]) & (marked[text] == drop[names[1]]), "left_anti")
    if not repeats.isEmpty():
        # Whole copies of the document that stays: one row of them does.
        twice = repeats.toDF(*names[2:])
        is_twice = left[id_].eqNullSafe(twice[names[2]]) & (left[text] == twice[names[3]])
        left = left.join(twice, is_twice, "left_anti").unionByName(
            left.join(twice, is_twice, "left_semi").dropDuplicates([id_, text])
        )
    return left.select(*docs.columns)
