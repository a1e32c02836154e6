"""Passages that repeat, byte for byte, removed wherever they stand.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too.
The suffixes of all positions are more than can be sorted, so they are sampled by
content: among the 50-byte grams of a string of ``LENGTH`` bytes the one with the
smallest hash is its anchor. Equal strings have their anchor at the same place, so a
string can only repeat where its anchor's gram repeats.

1. The grams at anchors are counted; those that occur once are done.
2. An anchor's strings start in one stretch of the text, whose bytes are its context.
   Equal contexts that stand in two places repeat as a whole.
3. One context of each kind is cut out, with the suffix at its anchor. Sampled
   splitters range-partition these by the suffix's leading bytes, gram and context;
   partitions are sorted, and the suffixes of a gram, now neighbours, are compared at
   every offset: first by leading bytes, ties by a hash of the whole string, which is
   enough to tell whether they are equal.
4. A gram at either end of a partition may go on in the next one: such grams are put
   together across the boundary and compared. One with more contexts than a task should
   hold is compared string by string, by an aggregation over all of its tasks.
5. Intervals found in a context hold wherever it stands, and are cut from the texts.

Grams and contexts that are worth keeping are told to the tasks as bitmaps of a fixed
size. A bitmap lets some others pass, which changes no result.

Cases: null text is empty; texts shorter than ``LENGTH`` lose nothing; all of an equal
text of at least that length goes, in every row that has it, also in rows that repeat a
doc_id; overlaps count, and strings are judged as they were in the input; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorgrid.llm.bitmap import bitmap, fitting, in_bitmap
from sensorgrid.llm.common import arrow_map, discard, saved
from sensorgrid.llm.textscan import pieces, prefix_hash, span_hash

LENGTH = 400
GRAM = 50
PIECE = 1 << 19
#: Contexts of one gram that are compared in one task; more are compared across tasks.
GROUP_ROWS = 4096
BATCH_BYTES = 2 << 20

_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)


class Anchors:
    """Anchors of the texts of a piece: their grams, and where their strings start."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int, gram: int) -> None:
        self.data, self.at, self.length = data, at, length
        n, span = len(data), length - gram + 1
        none = np.zeros(0, np.int64)
        self.gram, self.row, self.start, self.count, self.offset = none.view(np.uint64), none, none, none, none
        if n < length or not (np.diff(at) >= length).any():
            return
        self.sums = prefix_hash(data)
        place = np.arange(n - gram + 1)
        hashes = span_hash(self.sums, place, place + gram)
        # High half of the hash, then the position: the first of the smallest wins.
        key = (hashes & _HIGH) | place.astype(np.uint64)
        blocks = -(-len(key) // span)
        padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(key)] = key
        grid = padded.reshape(blocks, span)
        upto = np.minimum.accumulate(grid, axis=1).reshape(-1)
        since = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        strings = n - length + 1
        least = np.minimum(since[:strings], upto[span - 1 : span - 1 + strings])
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        start = np.flatnonzero(row[:strings] == row[length - 1 :])
        if not len(start):
            return
        anchor = (least[start] & _LOW).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        self.start = start[first]
        self.count = np.diff(np.append(first, len(start)))
        self.gram = hashes[anchor[first]]
        self.offset = anchor[first] - self.start
        self.row = row[self.start]

    def contexts(self) -> np.ndarray:
        """Hashes of the bytes from the first string's start to the last string's end."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        return span_hash(self.sums, self.start, self.start + self.count + self.length - 1) ^ (
            self.offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        )


def _occurrence(gram: np.ndarray, context: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A number for one place of one context, for the bitmap; ``key`` has one value per text."""
    x = gram ^ (context * np.uint64(3)) ^ (key * np.uint64(5)) ^ (start.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("key"), text.alias("text"))


def _key_numbers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(k.as_py()[:8] for k in column), np.uint64)


class Dedup:
    """The removal over one table; ``length`` and ``gram`` are smaller in tests."""

    def __init__(self, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> None:
        self.docs, self.length, self.gram, self.group_rows = docs, length, gram, group_rows
        self.text = _keyed(docs)
        self.temporary: list[DataFrame] = []

    def repeated_grams(self) -> DataFrame:
        length, gram = self.length, self.gram

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, _, data, at in pieces(batch.column("text"), PIECE):
                    values, n = np.unique(Anchors(data, at, length, gram).gram, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["gram", "n"])

        grams = arrow_map(self.text.select("text"), task, "gram long, n long")
        return grams.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")

    def places(self) -> DataFrame:
        """(gram, context, size, key, start) of the anchors whose gram repeats."""
        length, gram = self.length, self.gram
        grams = saved(self.repeated_grams(), "suffix-repeated")
        held = self.text.sparkSession.sparkContext.broadcast(bitmap(grams, fitting(grams.count())))
        discard(grams)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, last, data, at in pieces(batch.column("text"), PIECE):
                    found = Anchors(data, at, length, gram)
                    if not len(found.gram):
                        continue
                    on = np.flatnonzero(in_bitmap(held.value, found.gram))
                    keys = batch.column("key").slice(first, last - first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found.gram[on].view(np.int64)), pa.array(found.contexts()[on].view(np.int64)),
                            pa.array((found.count[on] + length - 1).astype(np.int32)), keys.take(pa.array(found.row[on])),
                            pa.array((found.start - at[found.row])[on].astype(np.int32)),
                        ],
                        ["gram", "context", "size", "key", "start"],
                    )

        schema = "gram long, context long, size int, key binary, start int"
        return arrow_map(self.text, task, schema)

    def cut_out(self, chosen: DataFrame) -> DataFrame:
        """(lead, gram, context, bytes) of the places in ``chosen``, and of few others."""
        length, gram = self.length, self.gram
        held = self.text.sparkSession.sparkContext.broadcast(bitmap(_occurrence_numbers(chosen), fitting(chosen.count())))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, last, data, at in pieces(batch.column("text"), PIECE):
                    found = Anchors(data, at, length, gram)
                    if not len(found.gram):
                        continue
                    keys = _key_numbers(batch.column("key").slice(first, last - first))
                    context, start = found.contexts(), found.start - at[found.row]
                    on = np.flatnonzero(in_bitmap(held.value, _occurrence(found.gram, context, keys[found.row], start)))
                    begin, size = found.start[on], found.count[on] + length - 1
                    anchor = begin + found.offset[on]
                    lead = np.zeros(len(on), np.uint64)
                    for k in range(8):
                        lead = (lead << np.uint64(8)) | data[anchor + k].astype(np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            # Order of bytes as order of signed numbers.
                            pa.array((lead ^ np.uint64(1 << 63)).view(np.int64)),
                            pa.array(found.gram[on].view(np.int64)), pa.array(context[on].view(np.int64)),
                            pa.array([data[a : a + s].tobytes() for a, s in zip(begin, size)], pa.binary()),
                        ],
                        ["lead", "gram", "context", "bytes"],
                    )

        return arrow_map(self.text, task, "lead long, gram long, context long, bytes binary")

    def compared(self, cuts: DataFrame) -> DataFrame:
        """(gram, context, start, stop): the stretches of contexts whose strings repeat.

        ``self.temporary`` has the tables that these are read from.
        """
        order = ["lead", "gram", "context"]
        n = max(1, int(cuts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        placed = cuts.repartitionByRange(n, *order).sortWithinPartitions(*order)
        first = saved(self._in_buckets(placed, whole=False), "suffix-compared")
        # Grams that a splitter or the limit has cut: put together again, or, if they
        # have too many contexts for one task, compared string by string.
        cut = first.where("bytes is not null").select("gram", "context", "bytes")
        counts = saved(cut.groupBy("gram").agg(F.count("*").alias("n")), "suffix-cut")
        few = cut.join(counts.where(F.col("n") <= self.group_rows).select("gram"), "gram")
        few = self._in_buckets(few.repartition("gram").sortWithinPartitions("gram", "context"), whole=True)
        many = cut.join(counts.where(F.col("n") > self.group_rows).select("gram"), "gram")
        strings = saved(self._strings(many), "suffix-strings")
        again = saved(
            strings.groupBy("string").agg(F.min("context").alias("lo"), F.max("context").alias("hi"))
            .where("lo != hi").select("string"),
            "suffix-again",
        )
        self.temporary += [first, counts, strings, again]
        found = ["gram", "context", "start", "stop"]
        return (
            first.where("bytes is null").select(*found)
            .unionByName(few.select(*found)).unionByName(strings.join(again, "string").select(*found))
        )

    def _in_buckets(self, placed: DataFrame, whole: bool) -> DataFrame:
        length, limit = self.length, self.group_rows

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _Bucket(length, limit, whole).run(batches)

        schema = "gram long, context long, start int, stop int, bytes binary"
        return arrow_map(placed.select("gram", "context", "bytes"), task, schema)

    def _strings(self, contexts: DataFrame) -> DataFrame:
        """(gram, context, start, stop, string) of every string of the contexts."""
        length = self.length

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = list(zip(*(batch.column(c).to_pylist() for c in ("gram", "context", "bytes"))))
                for k in range(0, len(rows), 256):
                    row, offset, string = _hashed(rows[k : k + 256], length)
                    yield _found(rows[k : k + 256], row, offset, offset + length, string=pa.array(string.view(np.int64)))

        return arrow_map(contexts, task, "gram long, context long, start int, stop int, string long")

    def intervals(self) -> DataFrame:
        """(key, spans): the repeated stretches of every text that has any."""
        places = saved(self.places(), "suffix-places")
        here = F.struct("key", "start")
        kinds = saved(
            places.groupBy("gram", "context", "size").agg(F.min(here).alias("one"), F.max(here).alias("other")),
            "suffix-contexts",
        )
        several = saved(kinds.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "suffix-grams")
        chosen = saved(kinds.join(several, "gram").select("gram", "context", "one"), "suffix-chosen")
        parts = self.compared(self.cut_out(chosen))
        whole = kinds.where("one != other").select("gram", "context", F.lit(0).alias("start"), F.col("size").alias("stop"))
        spans = saved(
            whole.unionByName(parts).groupBy("gram", "context").agg(
                F.collect_set(F.struct("start", "stop")).alias("spans")
            ),
            "suffix-spans",
        )
        discard(kinds, several, chosen, *self.temporary)
        copies = (
            self.text.groupBy("key").agg(F.count("*").alias("n"), F.first(F.octet_length("text")).alias("size"))
            .where((F.col("n") > 1) & (F.col("size") >= self.length))
            .select("key", F.lit(0).alias("start"), F.col("size").alias("stop"))
        )
        moved = places.join(spans, ["gram", "context"]).select("key", F.col("start").alias("at"), F.explode("spans").alias("s"))
        moved = moved.select("key", (F.col("at") + F.col("s.start")).alias("start"), (F.col("at") + F.col("s.stop")).alias("stop"))
        found = moved.unionByName(copies).groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
        found = saved(found, "suffix-intervals")
        discard(places, spans)
        return found

    def removed(self) -> DataFrame:
        """doc_id, key, text and the spans to remove, null where there are none."""
        spans = self.intervals().withColumnRenamed("key", "span_key")
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        keyed = self.docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
            F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("key"),
        )
        return keyed.join(spans, keyed["key"] == spans["span_key"], "left").select("doc_id", "text", "spans")


def _occurrence_numbers(chosen: DataFrame) -> DataFrame:
    """``_occurrence`` of the rows of (gram, context, one)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, context = (batch.column(c).to_numpy().view(np.uint64) for c in ("gram", "context"))
            if len(gram):
                number = _occurrence(gram, context, _key_numbers(batch.column("key")), batch.column("start").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(number.view(np.int64))], ["number"])

    rows = chosen.select("gram", "context", F.col("one.key").alias("key"), F.col("one.start").alias("start"))
    return arrow_map(rows, task, "number long")


def _hashed(rows: list, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset, hash) of every string of the rows' contexts."""
    data = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
    ends = np.cumsum([len(r[2]) for r in rows])
    counts = np.array([len(r[2]) - length + 1 for r in rows])
    row = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.concatenate(([0], ends[:-1]))[row] + offset
    return row, offset, span_hash(prefix_hash(data), begin, begin + length)


def _found(rows: list, row: np.ndarray, start: np.ndarray, stop: np.ndarray, **last: pa.Array) -> pa.RecordBatch:
    gram, context = (np.array([r[k] for r in rows], np.int64)[row] for k in (0, 1))
    spans = [pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))]
    return pa.RecordBatch.from_arrays(
        [pa.array(gram), pa.array(context), *spans, *last.values()], ["gram", "context", "start", "stop", *last]
    )


class _Bucket:
    """Compares the contexts of one sorted partition, gram by gram, in batches of grams.

    Unless ``whole`` says that no gram is in two partitions, the first and the last gram
    are handed back with their contexts, as is one with more than ``limit``.
    """

    def __init__(self, length: int, limit: int, whole: bool) -> None:
        self.length, self.limit, self.whole = length, limit, whole
        self.held: list[tuple[int, int, bytes]] = []  # whole grams, to be compared
        self.size = 0
        self.group: list[tuple[int, int, bytes]] = []  # the gram that is being read
        self.open = not whole  # whether that gram may have rows elsewhere

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for gram, context, data in zip(*(batch.column(c).to_pylist() for c in ("gram", "context", "bytes"))):
                if (gram, context) == last:
                    continue  # the same context, let through by the bitmap
                if last and gram != last[0]:
                    yield from self._close()
                    self.open = False
                last = gram, context
                self.group.append((gram, context, data))
                if not self.whole and len(self.group) > self.limit:
                    self.open = True
                    yield from self._close()
        self.open = self.open or not self.whole
        yield from self._close()
        yield from self._compare()

    def _close(self) -> Iterator[pa.RecordBatch]:
        """Ends a gram, or a part of it: keeps it for comparison, or hands it back."""
        if self.open and self.group:
            gram, context, data = zip(*self.group)
            none = pa.nulls(len(gram), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram, pa.int64()), pa.array(context, pa.int64()), none, none, pa.array(data, pa.binary())],
                ["gram", "context", "start", "stop", "bytes"],
            )
        elif self.group:
            self.held += self.group
            self.size += sum(len(r[2]) for r in self.group)
        self.group = []
        if self.size > BATCH_BYTES:
            yield from self._compare()

    def _compare(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            row, offset, string = _hashed(self.held, self.length)
            order = np.argsort(string, kind="stable")
            equal = string[order][1:] == string[order][:-1]
            twice = np.zeros(len(string), bool)
            twice[order[1:][equal]] = True
            twice[order[:-1][equal]] = True
            # Offsets that follow each other make one interval.
            on = np.flatnonzero(twice)
            new = np.ones(len(on), bool)
            new[1:] = (on[1:] != on[:-1] + 1) | (row[on[1:]] != row[on[:-1]])
            heads = np.flatnonzero(new)
            if len(heads):
                first, last = on[heads], on[np.append(heads[1:], len(on)) - 1]
                none = pa.nulls(len(first), pa.binary())
                yield _found(self.held, row[first], offset[first], offset[last] + self.length, bytes=none)
        self.held, self.size = [], 0


def _cut(data: bytes, spans: list[dict] | None) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left)."""
    if not spans:
        return 0, 0, data
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, [s["start"] for s in spans], 1)
    np.add.at(edges, [s["stop"] for s in spans], -1)
    gone = np.cumsum(edges)[:-1] > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])) if len(gone) else 0
    return int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS,
                   with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_repeats of every document (and ``kept``)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                data = text.as_py().encode()
                gone, runs, kept = _cut(data, spans.as_py())
                rows.append((len(data), gone, runs, hashlib.sha256(kept).hexdigest(), kept))
            size, gone, runs, digest, kept = zip(*rows) if rows else ((),) * 5
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (size, gone, runs)), pa.array(digest, pa.string())]
            columns.append(pa.array([n > 0 for n in gone], pa.bool_()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "has_repeats"]
            if with_bytes:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, has_repeats boolean"
    return arrow_map(Dedup(docs, length, gram, group_rows).removed(), task, schema + (", kept binary" if with_bytes else ""))
