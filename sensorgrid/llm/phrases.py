"""Phrases whose words stand together more often than chance, counted in HAT-tries.

A trie here is shallow: its first level are word ids (at the first round languages),
below them stand hash containers from the rest of a path to its count. A container with
more than ``BURST`` paths bursts into containers by the next id. When a task holds
more than ``HELD`` paths, whole subtrees, the largest first, are spilled as sorted runs,
each path with its count; runs are merged by prefix, where equal paths are added.

Three rounds over the texts, each with what the last one found worth following:

1. words of each language; those found ``LEAST`` times get an id, a hash of both,
2. pairs of such words,
3. paths of up to five words whose neighbours are all such pairs. A sorted run gives the
   counts of its paths' beginnings by adding up, so one trie counts three to five words.

A phrase cannot be more frequent than a part of it, so nothing frequent is left out, and
the counts of what is found are exact. What is worth following is told to the tasks as
bitmaps of a bounded size, which let some others pass; those fall to the limit later.

A candidate is dropped if a longer phrase around it is as frequent; as a phrase between
the two is then as frequent too, only phrases longer by one word are looked at.

Cases: a null text is empty; a null lang is ``und`` and one with the language of that
name; a piece is never joined with the next; words of any length and very long texts are
taken whole; rows that repeat count each time; ties in rank go by phrase, so the result
is the same in any order; an empty table gives no rows; columns other than text and lang
are not looked at. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorgrid.llm.bitmap import bitmap, fitting, in_bitmap
from sensorgrid.llm.common import arrow_map, saved
from sensorgrid.llm.textscan import LOWER, MULTIPLIER, mix, pieces, prefix_hash, rows_of, runs, span_hash

LEAST = 100
LONGEST = 5
TOP = 2000
UNKNOWN = "und"
#: Paths of a container before it bursts, and of all containers of a task before it spills.
BURST, HELD = 1 << 14, 400_000
#: Paths that are sorted and counted before they go into the trie.
GATHERED = 1 << 20
#: Rows of spilled runs that are handed on together.
RUN_ROWS = 1 << 16
ID = 8

_END = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\v\f\r"])
_BLANK = np.isin(np.arange(256), [ord(c) for c in " \t"])


class Words:
    """The words of a piece of texts: id, place, and whether the next one follows in the same piece of its text."""

    def __init__(self, data: np.ndarray, at: np.ndarray, code: np.ndarray) -> None:
        self.data = LOWER[data]
        self.begin, self.end = runs(~(_END | _BLANK)[data], at)
        self.row = rows_of(self.begin, at)
        own = span_hash(prefix_hash(self.data), self.begin, self.end)
        self.id = np.maximum(mix(own ^ code[self.row]), 1)  # 0 stands for no word
        ends = np.concatenate(([0], np.cumsum(_END[data])))
        self.next = np.zeros(len(self.id), bool)
        self.next[:-1] = (self.row[1:] == self.row[:-1]) & (ends[self.begin[1:]] == ends[self.end[:-1]])

    def text(self, k: int) -> bytes:
        return self.data[self.begin[k] : self.end[k]].tobytes()


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(MULTIPLIER) + second)


class Burst(dict):
    """A container that has burst: containers by the next part of the path."""


class HatTrie:
    """Counts of paths, the first part of which is a key and the rest bytes."""

    def __init__(self, width: int, burst: int = BURST, held: int = HELD) -> None:
        self.width, self.burst, self.held = width, burst, held
        self.top: dict = {}
        self.size: dict = {}
        self.total = 0

    def add(self, head: object, tails: list[bytes], counts: list[int]) -> None:
        """Counts paths below ``head``."""
        box = self.top.setdefault(head, {})
        before = len(box)
        if isinstance(box, Burst):
            new = self._add_apart(box, tails, counts)
        else:
            get = box.get
            for tail, n in zip(tails, counts):
                box[tail] = get(tail, 0) + n
            new = len(box) - before
            if len(box) > self.burst and len(tails[0]) > self.width:
                self.top[head] = Burst()
                self._add_apart(self.top[head], list(box), list(box.values()))
        self.size[head] = self.size.get(head, 0) + new
        self.total += new

    def _add_apart(self, box: Burst, tails: list[bytes], counts: list[int]) -> int:
        new, width = 0, self.width
        for tail, n in zip(tails, counts):
            below = box.setdefault(tail[:width], {})
            rest = tail[width:]
            new += rest not in below
            below[rest] = below.get(rest, 0) + n
        return new

    def spilled(self, all_of_it: bool = False) -> Iterator[tuple[object, list[bytes], list[int]]]:
        """Sorted runs of whole subtrees, the largest first, until half the room is free."""
        if not all_of_it and self.total <= self.held:
            return
        for head in sorted(self.size, key=self.size.get, reverse=True):
            if not all_of_it and self.total <= self.held // 2:
                break
            box = self.top.pop(head)
            self.total -= self.size.pop(head)
            if isinstance(box, Burst):
                run = [(k + rest, n) for k in sorted(box) for rest, n in sorted(box[k].items())]
            else:
                run = sorted(box.items())
            yield head, [r[0] for r in run], [r[1] for r in run]


def _coded(column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Language of every row as a place in a list, the list, and a hash of every row's language."""
    names = column.dictionary_encode()
    known = names.dictionary.to_pylist()
    place = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    code = np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in known], np.uint64)
    return place, known, code[place]


class Phrases:
    """The counting over one table; every intermediate result is written."""

    def __init__(self, docs: DataFrame, least: int = LEAST, longest: int = LONGEST, burst: int = BURST, held: int = HELD) -> None:
        self.least, self.longest, self.burst, self.held = least, longest, burst, held
        self.docs = docs.select("text", F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"))
        merged = self._words().groupBy("lang", "word", "path").agg(F.sum("n").alias("n"))
        found = saved(merged.where((F.col("n") >= least) | F.col("word").isNull()), "phrase-words")
        self.totals = found.where("word is null").select("lang", F.col("n").alias("total"))
        self.words = found.where("word is not null")
        pairs = self._merged(self._pairs(self._follow(self.words)), "phrase-pairs")
        longer = self._merged(self._longer(self._follow(pairs)), "phrase-longer")
        counts = self.words.select("path", "n").unionByName(pairs).unionByName(longer)
        self.counts = counts.withColumn("words", (F.octet_length("path") / ID).cast("int"))

    def _merged(self, parts: DataFrame, label: str) -> DataFrame:
        return saved(parts.groupBy("path").agg(F.sum("n").alias("n")).where(F.col("n") >= self.least), label)

    def _follow(self, paths: DataFrame):
        """What is worth following, as a bitmap that tasks can look at."""

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = np.frombuffer(b"".join(batch.column("path").to_pylist()), np.uint64)
                if len(ids):
                    key = ids if len(ids) == batch.num_rows else pair_key(ids[::2], ids[1::2])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

        keys = bitmap(arrow_map(paths.select("path"), task, "key long"), fitting(paths.count()))
        return self.docs.sparkSession.sparkContext.broadcast(keys)

    def _words(self) -> DataFrame:
        """(lang, word, path, n) of the tasks' runs; without a word, all words of the language."""
        burst, held = self.burst, self.held

        def batch_of(lang: list, word: list, path: list, n: list) -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((lang, word, path, n), kinds)], ["lang", "word", "path", "n"])

        def run(head: str, tails: list[bytes], counts: list[int]) -> pa.RecordBatch:
            return batch_of([head] * len(tails), [t[:-ID].decode() for t in tails], [t[-ID:] for t in tails], counts)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie, totals = HatTrie(1, burst, held), {}
            for batch in batches:
                place, known, code = _coded(batch.column("lang"))
                for first, last, data, at in pieces(batch.column("text")):
                    found = Words(data, at, code[first:last])
                    ids, some, n = np.unique(found.id, return_index=True, return_counts=True)
                    lang = place[first:last][found.row[some]]
                    for k in np.unique(lang):
                        own = np.flatnonzero(lang == k)
                        # The id goes with the word: it is made of the word and its language.
                        tails = [found.text(j) + i for j, i in zip(some[own], _split(ids[own].tobytes(), ID))]
                        trie.add(known[k], tails, n[own].tolist())
                        totals[known[k]] = totals.get(known[k], 0) + int(n[own].sum())
                    for part in trie.spilled():
                        yield run(*part)
            for part in trie.spilled(True):
                yield run(*part)
            yield batch_of(list(totals), [None] * len(totals), [None] * len(totals), list(totals.values()))

        return arrow_map(self.docs, task, "lang string, word string, path binary, n long")

    def _counted(self, paths: Callable[[Words], np.ndarray], sizes: Sequence[int]) -> DataFrame:
        """Runs (path, n) of the paths that ``paths`` gives for the words of a piece, and of their beginnings of the given sizes."""
        burst, held = self.burst, self.held

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie = HatTrie(ID, burst, held)
            waiting: list[np.ndarray] = []

            def counted(least: int) -> Iterator[pa.RecordBatch]:
                # Equal paths are counted at once, then added below their first word.
                if sum(map(len, waiting)) <= least:
                    return
                found, n = _unique(np.concatenate(waiting))
                waiting.clear()
                heads = np.flatnonzero(np.append(True, found[1:, 0] != found[:-1, 0]))
                tails, counts = _split(found[:, 1:].tobytes(), ID * (found.shape[1] - 1)), n.tolist()
                ends = [*heads[1:].tolist(), len(found)]
                for head, a, b in zip(found[heads, 0].tolist(), heads.tolist(), ends):
                    trie.add(head, tails[a:b], counts[a:b])
                yield from runs_of(trie.spilled())

            def runs_of(spilled: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
                # Many subtrees to a batch, as most are small.
                held_, size = [], 0
                for run in spilled:
                    held_.append(run)
                    size += len(run[1])
                    if size >= RUN_ROWS:
                        yield _paths(held_, sizes)
                        held_, size = [], 0
                if held_:
                    yield _paths(held_, sizes)

            for batch in batches:
                _, _, code = _coded(batch.column("lang"))
                for first, last, data, at in pieces(batch.column("text")):
                    waiting.append(paths(Words(data, at, code[first:last])))
                    yield from counted(GATHERED)
            yield from counted(0)
            yield from runs_of(trie.spilled(True))

        return arrow_map(self.docs, task, "path binary, n long")

    def _pairs(self, held) -> DataFrame:
        def paths(words: Words) -> np.ndarray:
            known = in_bitmap(held.value, words.id)
            on = np.flatnonzero(words.next[:-1] & known[:-1] & known[1:])
            return np.column_stack((words.id[on], words.id[on + 1]))

        return self._counted(paths, (2,))

    def _longer(self, held) -> DataFrame:
        longest = self.longest

        def paths(words: Words) -> np.ndarray:
            n = len(words.id)
            go = np.zeros(n, bool)
            go[:-1] = words.next[:-1] & in_bitmap(held.value, pair_key(words.id[:-1], words.id[1:]))
            start = np.flatnonzero(go[:-1] & go[1:])
            out = np.zeros((len(start), longest), np.uint64)
            out[:, 0] = words.id[start]
            on = np.ones(len(start), bool)
            for k in range(1, longest):
                at = np.minimum(start + k, n - 1)
                on &= go[at - 1] & (start + k < n)
                out[on, k] = words.id[at[on]]
            return out

        return self._counted(paths, range(3, longest + 1))

    def candidates(self) -> DataFrame:
        """(path, a): frequent phrases of two words and more, without parts of others as frequent."""
        several = self.counts.where("words > 1")
        size = F.octet_length("path")
        ends = F.array(F.substring("path", F.lit(1), size - ID), F.substring("path", F.lit(ID + 1), size - ID))
        inside = several.where("words > 2").select(F.explode(ends).alias("path"), "n").distinct()
        return several.join(inside, ["path", "n"], "left_anti").select("path", F.col("n").alias("a"), "words")

    def scored(self) -> DataFrame:
        """(lang, path, a, l, r, n, score) of the candidates, by their lowest-scoring cut."""
        size = F.octet_length("path")
        cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
        cuts = self.candidates().select("path", "a", cut).select(
            "path", "a", "cut", F.substring("path", F.lit(1), F.col("cut") * ID).alias("first"),
            F.substring("path", F.col("cut") * ID + 1, size - F.col("cut") * ID).alias("rest"),
            F.substring("path", F.lit(1), F.lit(ID)).alias("word"),
        )
        held = saved(self.counts.select("path", "n"), "phrase-counts")
        words = self.words.join(self.totals, "lang").select(F.col("path").alias("word"), "lang", F.col("total").alias("n"))
        rows = cuts.join(held.toDF("first", "l"), "first").join(held.toDF("rest", "r"), "rest").join(words, "word")
        # Whole numbers of up to 38 digits: counts of up to 10 ** 15 leave room for all products.
        whole = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
        rows = rows.withColumns({"over": whole("a", 16) * (whole("n", 16) * F.lit(1000).cast("decimal(4,0)")), "under": whole("l", 16) * whole("r", 16)})
        rows = rows.withColumn("score", F.expr("over div under"))
        best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
        return rows.groupBy("lang", "path", "a", "n").agg(best).select("lang", "path", "a", "best.l", "best.r", "n", "best.score")

    def top(self, most: int = TOP) -> DataFrame:
        """lang, rank, phrase, a, l, r, n, score of each language's first phrases."""
        order = [F.col("score").desc(), F.col("a").desc()]
        by_lang = Window.partitionBy("lang")
        # Ties go by the phrase; so all that tie with the last one get their words first.
        near = self.scored().withColumn("place", F.rank().over(by_lang.orderBy(*order))).where(F.col("place") <= most)
        near = saved(near.drop("place"), "phrase-near")
        at = F.explode(F.expr(f"transform(sequence(0, octet_length(path) div {ID} - 1), k -> struct(k as k, substring(path, k * {ID} + 1, {ID}) as id))"))
        told = near.select("path", at.alias("at")).join(self.words.select(F.col("path").alias("id"), "word"), F.col("at.id") == F.col("id"))
        spoken = told.groupBy(told["path"]).agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at.k", "word"))), lambda x: x["word"]), " ").alias("phrase")
        )
        rank: Column = F.row_number().over(by_lang.orderBy(*order, "phrase"))
        ranked = near.join(spoken, "path").withColumn("rank", rank.cast("long")).where(F.col("rank") <= most)
        return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _split(data: bytes, width: int) -> list[bytes]:
    return [data[k : k + width] for k in range(0, len(data), width)]


def _unique(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, sorted, and how often each is there."""
    order = np.lexsort(paths.T[::-1])
    paths = paths[order]
    first = np.flatnonzero(np.append(True, (paths[1:] != paths[:-1]).any(axis=1)))
    return paths[first], np.diff(np.append(first, len(paths)))


def _paths(runs: list[tuple[int, list[bytes], list[int]]], sizes: Sequence[int]) -> pa.RecordBatch:
    """Sorted runs' paths of the given sizes, where longer paths count for their beginnings."""
    lengths = [len(tails) for _, tails, _ in runs]
    head = np.repeat(np.array([h for h, _, _ in runs], np.uint64), lengths)
    ids = np.frombuffer(b"".join(t for _, tails, _ in runs for t in tails), np.uint64).reshape(len(head), -1)
    ids = np.column_stack((head, ids))
    n = np.array([c for _, _, counts in runs for c in counts], np.int64)
    path, count = [], []
    for size in sizes:
        there = ids[:, size - 1] != 0
        own, some = ids[there, :size], n[there]
        if len(own):
            first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(axis=1)))
            path += _split(np.ascontiguousarray(own[first]).tobytes(), ID * size)
            count.append(np.add.reduceat(some, first))
    counts = np.concatenate(count) if count else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(path, pa.binary()), pa.array(counts, pa.int64())], ["path", "n"])


def collocations(docs: DataFrame, least: int = LEAST, most: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first phrases of each language."""
    return Phrases(docs, least).top(most)
