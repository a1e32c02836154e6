"""Quality rules whose thresholds follow the data of each language and source.

A pass over the texts counts words, symbols, repeated lines and repeated windows.
Each signal of a (lang, source) group goes into a quantile sketch, and a document is
rejected if a signal lies further outside its group's quartiles than ``FENCE`` times
the group's spread: the distance of the quartiles or, if larger, that from a quartile to
the first of the quantiles in ``TAILS`` that differs from it, on either side for itself.
Where there is no spread at all, the quartile is the fence. Fixed cutoffs are only left
in the base rule. Sketches are counts in logarithmic buckets: merging is adding, so
partial sketches of tasks, groups or days combine in any order to the same result, a
retried task changes nothing, and a quantile is within ``ACCURACY`` of the true one.
The fences of a group of n documents count n parts and those of its language ``BLEND``
parts, and a language's are blended with those of all documents likewise, so a small
group has its language's fences, a large one its own, and none jumps as it grows. The
wider groups' sketches are merges of the same ones.

Thresholds are written as a table, whose size Spark knows: it is broadcast to the
documents if it is small; if not, a sort-merge join splits hot sources.

Cases: null or empty text has no words and fails the base rule; null lang or source is
a group of its own; rows that repeat are judged alike; ties with a fence are kept; very
long texts are counted whole; an empty table gives no rows; columns of the input with other names are carried by
``keep_good`` and not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sensorgrid.llm.common import arrow_map, saved, set_aside
from sensorgrid.llm.textscan import (
    SPACE, mix, pieces, prefix_hash, rows_of, runs, segment_counts, shingle_hash, span_hash,
)

WINDOW_WORDS = 5
SYMBOLS = "#*$%&|<>"
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
#: Documents of a group that weigh as much as the wider group it belongs to.
BLEND = 20
FENCE = 3.0
#: Shares of a group beyond a quantile that its spread is taken from.
TAILS = (0.1, 0.05, 0.01)
SIGNALS = ("word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
MARKS = tuple(f"q5_{c}" for c in COUNTS)
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of keys that occur again, positions that are not the first), any order."""
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[1:] = equal
    any_[1:] |= equal
    any_[:-1] |= equal
    return order[any_], order[later]


def text_counts(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The columns of ``COUNTS`` for the rows of a piece."""
    n = len(at) - 1
    solid = ~SPACE[data]
    begin, end = runs(solid, at)
    row = rows_of(begin, at)
    sums = prefix_hash(data)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = np.bincount(row, points[end] - points[begin], n).astype(np.int64)
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))

    # Lines: from a row's start or behind a line feed, to the next line feed or the row's end.
    feed = np.flatnonzero(data == 10)
    first = np.unique(np.concatenate((at[:-1], feed + 1)))
    first = first[first < len(data)]
    last = np.append(first[1:], len(data))
    last = np.where((last > 0) & (data[np.maximum(last - 1, 0)] == 10), last - 1, last)
    last = np.maximum(last, first)
    filled = np.concatenate(([0], np.cumsum(solid)))
    has_word = filled[last] > filled[first]
    first, last = first[has_word], last[has_word]
    line_row = rows_of(first, at)
    salt = mix(line_row.astype(np.uint64) + np.uint64(1))
    _, again = _repeated(span_hash(sums, first, last) ^ salt)

    word = span_hash(sums, begin, end)
    window = shingle_hash(word, WINDOW_WORDS)
    start = np.flatnonzero(row[: len(window)] == row[WINDOW_WORDS - 1 :]) if len(window) else np.zeros(0, np.int64)
    salt = mix(row[start].astype(np.uint64) + np.uint64(1))
    twice, _ = _repeated(window[start] ^ salt)
    cover = np.zeros(len(row) + 1, np.int64)
    np.add.at(cover, start[twice], 1)
    np.add.at(cover, start[twice] + WINDOW_WORDS, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return [
        segment_counts(row, n),
        chars,
        symbols[at[1:]] - symbols[at[:-1]],
        segment_counts(line_row[again], n),
        segment_counts(row[covered], n),
        segment_counts(line_row, n),
    ]


def with_counts(docs: DataFrame) -> DataFrame:
    """The rows with the counts as columns named in ``MARKS``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_counts(data, at) for _, _, data, at in pieces(batch.column("text"))]
            columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0, np.int64)] * len(MARKS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.int64()) for c in columns)], [*batch.schema.names, *MARKS]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return arrow_map(docs, task, fields + "".join(f", {m} long" for m in MARKS))


def base_failed() -> Column:
    words, repeated = F.col("q5_n_words"), F.col("q5_n_repeat_words")
    return (words < 10) | (100 * repeated > 20 * words)


def signals() -> dict[str, Column]:
    """Signals of a row with counts; 0 where there is nothing to divide by."""
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "word_length": ratio("q5_word_chars", "q5_n_words"),
        "symbol_ratio": ratio("q5_n_symbols", "q5_n_words"),
        "dup_line_ratio": ratio("q5_n_dup_lines", "q5_n_lines"),
        "repeat_ratio": ratio("q5_n_repeat_words", "q5_n_words"),
    }


def sketch(counted: DataFrame) -> DataFrame:
    """(lang, source, signal, bucket, n): documents per bucket; bucket null is value 0.

    Documents that fail the base rule are no measure of what is usual.
    """
    values = F.array(*[F.struct(F.lit(k).alias("signal"), v.alias("value")) for k, v in signals().items()])
    one = F.when(F.col("s.value") > 0, F.ceil(F.log(F.col("s.value")) / math.log(GAMMA)))
    return (
        counted.where(~base_failed())
        .select("lang", "source", F.explode(values).alias("s"))
        .groupBy("lang", "source", F.col("s.signal").alias("signal"), one.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merged(one: DataFrame, *others: DataFrame) -> DataFrame:
    """The sketch of all documents of several sketches."""
    for other in others:
        one = one.unionByName(other)
    return one.groupBy("lang", "source", "signal", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, signal, documents, q1, q3, and both ``TAILS``) of sketches merged over the other keys."""
    group = W.partitionBy(*keys, "signal")
    counts = sketches.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))
    value = F.coalesce(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1), F.lit(0.0))
    ranked = counts.select(
        *keys, "signal", value.alias("value"),
        F.sum("n").over(group).alias("documents"),
        F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first())).alias("upto"),
    )
    at = lambda q: F.min(F.when(F.col("upto") > q * (F.col("documents") - 1), F.col("value")))
    return ranked.groupBy(*keys, "signal").agg(
        F.first("documents").alias("documents"), at(0.25).alias("q1"), at(0.75).alias("q3"),
        F.array(*[at(t) for t in TAILS]).alias("below"), F.array(*[at(1 - t) for t in TAILS]).alias("above"),
    )


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, signal, documents, low, high) of sketches merged over the other keys."""
    q1, q3 = F.col("q1"), F.col("q3")
    first = lambda spreads: F.coalesce(F.get(F.filter(spreads, lambda s: s > 0), F.lit(0)), F.lit(0.0))
    down = F.greatest(q3 - q1, first(F.transform("below", lambda v: q1 - v)))
    up = F.greatest(q3 - q1, first(F.transform("above", lambda v: v - q3)))
    # A quantile stands for its bucket: the fence leaves the whole bucket inside.
    bottom, top = q1 * ((GAMMA + 1) / (2 * GAMMA) - 1e-9), q3 * ((GAMMA + 1) / 2 + 1e-9)
    return quartiles(sketches, keys).select(
        *keys, "signal", "documents", (bottom - FENCE * down).alias("low"), (top + FENCE * up).alias("high")
    )


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source): lower and upper fence of every signal."""
    own = fences(sketches, ["lang", "source"])
    language = fences(sketches, ["lang"]).withColumnsRenamed({"documents": "ld", "low": "l_low", "high": "l_high"})
    whole = fences(sketches, []).withColumnsRenamed({"documents": "wd", "low": "w_low", "high": "w_high"})
    language = language.withColumnsRenamed({"lang": "l_lang", "signal": "l_signal"})
    whole = whole.withColumnRenamed("signal", "w_signal")
    joined = own.join(
        language, own["lang"].eqNullSafe(language["l_lang"]) & (own["signal"] == language["l_signal"])
    ).join(whole, F.col("signal") == F.col("w_signal"))
    blend = lambda own, n, wide: (own * F.col(n) + wide * BLEND) / (F.col(n) + BLEND)
    pick = lambda side: blend(
        F.col(side), "documents", blend(F.col(f"l_{side}"), "ld", F.col(f"w_{side}"))
    )
    picked = joined.select("lang", "source", "signal", pick("low").alias("low"), pick("high").alias("high"))
    return picked.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("signal") == s, F.col(side))).alias(f"q5_{side}_{s}")
          for s in SIGNALS for side in ("low", "high")]
    )


def verdict() -> Column:
    """Of counts joined with thresholds. A group without thresholds has no base-good documents."""
    good = ~base_failed()
    for name, value in signals().items():
        inside = (value >= F.col(f"q5_low_{name}")) & (value <= F.col(f"q5_high_{name}"))
        good = good & F.coalesce(inside, F.lit(True))
    return good


def _judged(counted: DataFrame, fences: DataFrame) -> DataFrame:
    fences = fences.withColumnsRenamed({"lang": "q5_lang", "source": "q5_source"})
    condition = counted["lang"].eqNullSafe(fences["q5_lang"]) & counted["source"].eqNullSafe(fences["q5_source"])
    return counted.join(fences, condition, "left").withColumn("q5_kept", verdict())


def _fences(counted: DataFrame) -> DataFrame:
    return saved(thresholds(saved(sketch(counted), "quality-sketch")), "quality-fences")


def quality(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document."""
    counted = saved(
        with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")).drop("text"),
        "quality-counts",
    )
    return _judged(counted, _fences(counted)).select(
        "doc_id", *[F.col(m).alias(c) for m, c in zip(MARKS, COUNTS)],
        base_failed().alias("base_failed"), F.col("q5_kept").alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with.

    Counts are taken again rather than joined, so texts are not shuffled.
    """
    fences = _fences(with_counts(docs.select("text", "lang", "source")).drop("text"))
    # Columns named as the counts and fences step aside meanwhile.
    named, back = set_aside(docs, "q5_")
    return _judged(with_counts(named), fences).where("q5_kept").select(*back)
