"""What filters remove alone, together and in every order, from sorted posting lists.

Every row gets a number when its verdicts are written. For each part and each range of
``RANGE`` numbers, a filter's posting list holds the sorted numbers of the rows that
fail it; two more lists hold the rows labelled good and toxic. A task takes one range at
a time, merges its lists into the union of every subset of filters and counts what the
unions share with the labels. Counts of ranges are added, so a part of any size is
never in one place, and all that the orders need follows from the counts of subsets.

Merges gallop: the numbers of the shorter list are searched in the longer one, whose
stretches between them are copied whole. Lists are merged shortest first.

Filters, on whole texts: A fewer than 50 words; B fewer distinct words than 65 in 100;
C more than 5 capitals A-Z in 100 code points; D a sign of ``#$%&*|``; E a text that a
smaller doc_id has too, anywhere in the table.

Cases: a null text is an empty one, which fails A and, beside a smaller doc_id with an
empty text, E; a null source is the part of the empty string; a null doc_id is neither
smaller nor larger than another, so E never fails it, and it has no label; rows that
repeat a doc_id are counted one by one, and none is E's because of the other; a doc_id
labelled more than once is good if any label says so, toxic likewise; texts of any
length are judged whole, one text at a time where it is long; no documents give no
rows; columns other than doc_id, text and source are not looked at, nor columns of
``labels`` other than doc_id, quality and toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.llm.common import arrow_map, saved, text_digest
from sensorgrid.llm.textscan import SPACE, pieces, prefix_hash, rows_of, runs, segment_counts, span_hash

FILTERS = "ABCDE"
#: Numbers of rows that one posting list may cover, a power of two.
RANGE = 1 << 13
#: Parts whose counts a task holds before it hands them on.
HELD_PARTS = 4096

_SIGNS = np.isin(np.arange(256), [ord(c) for c in "#$%&*|"])


def failing(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that each text of a piece fails."""
    n = len(at) - 1
    row_of_byte = lambda marked: segment_counts(rows_of(np.flatnonzero(marked), at), n)
    begin, end = runs(~SPACE[data], at)
    row = rows_of(begin, at)
    words = segment_counts(row, n)
    order = np.lexsort((word := span_hash(prefix_hash(data), begin, end), row))
    row, word = row[order], word[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1])
    distinct = segment_counts(row[new], n)
    capitals, points = row_of_byte((data >= 0x41) & (data <= 0x5A)), row_of_byte((data & 0xC0) != 0x80)
    fails = (words < 50, 100 * distinct < 65 * words, 100 * capitals > 5 * points, row_of_byte(_SIGNS[data]) > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, part, fails, good, toxic) of every row; ``fails`` has a bit for each filter."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [failing(data, at) for _, _, data, at in pieces(batch.column("text"))]
            fails = pa.array(np.concatenate(bits) if bits else [], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("digest"), fails],
                ["doc_id", "part", "digest", "fails"],
            )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.unhex(text_digest()).alias("digest"), "text",
    )
    own = arrow_map(narrow, task, "doc_id long, part string, digest binary, fails int")
    own = saved(own.withColumn("row", F.monotonically_increasing_id()), "audit-rows")
    first = saved(
        own.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").select("digest", "first"),
        "audit-copies",
    )
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return own.join(first, "digest", "left").join(said, "doc_id", "left").select(
        "row", "part", (F.col("fails") + 16 * copy).alias("fails"),
        *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")),
    )


def posting_lists(verdict: DataFrame) -> DataFrame:
    """(part, range, total, A..E, good, toxic): the sorted numbers of each list."""
    ids = lambda on: F.sort_array(F.collect_list(F.when(on, F.col("row"))))
    fails: dict[str, Column] = {f: F.col("fails").bitwiseAND(1 << k) != 0 for k, f in enumerate(FILTERS)}
    where = F.shiftright("row", RANGE.bit_length() - 1).alias("range")
    return verdict.groupBy("part", where).agg(
        F.count("*").alias("total"),
        *(ids(on).alias(c) for c, on in {**fails, "good": F.col("good"), "toxic": F.col("toxic")}.items()),
    )


def _found(few: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the numbers of ``few`` in ``many``, and which of them are there."""
    place = np.searchsorted(many, few)
    there = np.zeros(len(few), bool)
    inside = place < len(many)
    there[inside] = many[place[inside]] == few[inside]
    return place, there


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sorted union of two sorted lists."""
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    place, there = _found(few, many)
    return np.insert(many, place[~there], few[~there])


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Numbers that two sorted lists share."""
    return int(_found(a, b)[1].sum() if len(a) <= len(b) else _found(b, a)[1].sum())


def subset_counts(lists: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """For every subset of the lists: size of the union, and what it shares with the labels."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    union = {0: np.zeros(0, np.int64)}
    out = np.zeros((1 << len(lists), 3), np.int64)
    # The longest list of a subset comes last, so what is merged into it is short.
    for k in order:
        for s, held in list(union.items()):
            union[s | 1 << k] = merged(held, lists[k])
    for s, held in union.items():
        out[s] = len(held), shared(held, good), shared(held, toxic)
    return out


def union_sizes(postings: DataFrame) -> DataFrame:
    """(part, total, unions): for every part the counts of all subsets of filters, one after the other."""
    size = 3 << len(FILTERS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = [(p, k, int(n)) for p, counts in held.items() for k, n in enumerate(counts)]
            columns = zip(*rows) if rows else ((), (), ())
            kinds = (pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "place", "n"])
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                lists = {c: np.asarray(batch.column(c)[i].values, np.int64) for c in (*FILTERS, "good", "toxic")}
                counts = subset_counts([lists[f] for f in FILTERS], lists["good"], lists["toxic"])
                total = batch.column("total")[i].as_py()
                part = batch.column("part")[i].as_py()
                held[part] = held.get(part, 0) + np.append(counts.reshape(-1), total)
                if len(held) > HELD_PARTS:
                    yield from out()
        yield from out()

    added = arrow_map(postings.drop("range"), task, "part string, place int, n long").groupBy("part", "place").agg(F.sum("n").alias("n"))
    counts = F.transform(F.sort_array(F.collect_list(F.struct("place", "n"))), lambda x: x["n"])
    return added.groupBy("part").agg(counts.alias("counts")).select(
        "part", F.col("counts")[size].alias("total"), F.slice("counts", 1, size).alias("unions")
    )


def orders(filters: str = FILTERS) -> Iterator[tuple[str, int, int, int]]:
    """(order, step, the step's filter, bits of the filters before it)."""
    for order in permutations(range(len(filters))):
        before = 0
        for step, k in enumerate(order, 1):
            yield "".join(filters[j] for j in order), step, k, before
            before |= 1 << k


def audit_part(total: int, unions: np.ndarray) -> Iterator[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    size, n = unions[:, 0], len(FILTERS)
    every = (1 << n) - 1
    shapley = [
        sum(
            factorial(s.bit_count()) * factorial(n - 1 - s.bit_count()) * int(size[s | 1 << k] - size[s])
            for s in range(1 << n) if not s >> k & 1
        )
        for k in range(n)
    ]
    for order, step, k, before in orders():
        after = before | 1 << k
        removed, good, toxic = (int(x) for x in unions[after] - unions[before])
        yield (
            order, step, total - int(size[after]), removed, int(size[1 << k]) - removed,
            int(size[every] - size[every ^ 1 << k]), good, toxic, shapley[k],
        )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does in every part, order and step."""
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, total, unions in zip(*(batch.column(c).to_pylist() for c in ("part", "total", "unions"))):
                columns = list(zip(*audit_part(total, np.array(unions, np.int64).reshape(-1, 3))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(columns[0]), pa.string()), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                    ["part", *names],
                )

    postings = saved(posting_lists(verdicts(docs, labels)), "audit-postings")
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return arrow_map(union_sizes(postings), task, schema)
