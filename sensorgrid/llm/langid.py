"""Languages of a document as a mixture, inferred from n-gram likelihoods.

Training counts the letter trigrams of every labelled training document per language
(all of them, no sample). A word's likelihood under a language is the product of its
trigrams' smoothed frequencies. A document is a mixture: expectation-maximisation
finds the proportions of the languages that explain its words best, first over all
languages, then over the one, two, ... largest, as long as a further one adds more than
its penalty; the set with the best penalised likelihood is the document's, and the
largest of it its language.

The model is ``languages x buckets`` numbers. Buckets shrink with the number of
languages so that it never has more than ``MODEL_CELLS``, whatever the corpus; that
bound is what allows to broadcast it.

Cases: a text that is null or has no letter is ``und`` with score 0; without any
training document everything is; a null doc_id has no remainder, is not held out and
not learned from; null lang is not learned from; rows that repeat count again; ties go
to the language that sorts first; texts of any length are read whole, one by one where
they are long; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.llm.common import arrow_map
from sensorgrid.llm.textscan import LOWER, pieces, rows_of, runs

BUCKETS = 1 << 16
MODEL_CELLS = 1 << 23
SMOOTHING = 0.1
ROUNDS = 8
#: Sizes that are tried in any case; beyond, a document is done when a further language adds nothing.
LEAST_SIZES = 3
#: What a further language must add to the log-likelihood, times log(words).
PENALTY = 6.0
FOLDS, HELD_OUT = 4, 2

_LETTER = np.zeros(256, bool)
_LETTER[list(range(ord("a"), ord("z") + 1)) + list(range(ord("A"), ord("Z") + 1))] = True
_LETTER[0x80:] = True
_FACTOR = np.uint32(2654435761)  # fixed value: multiplicative hashing by the golden ratio


def fold() -> Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % FOLDS


def trigrams(data: np.ndarray, at: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram around each byte, whether the byte is in a word)."""
    letter = _LETTER[data]
    clean = np.where(letter, LOWER[data], 0x20).astype(np.uint32)
    before, after = np.full(len(data), 0x20, np.uint32), np.full(len(data), 0x20, np.uint32)
    before[1:], after[:-1] = clean[:-1], clean[1:]
    before[at[:-1][at[:-1] < len(data)]] = 0x20
    after[at[1:][at[1:] > 0] - 1] = 0x20
    code = (before << np.uint32(16)) | (clean << np.uint32(8)) | after
    bits = buckets.bit_length() - 1
    return ((code * _FACTOR) >> np.uint32(32 - bits)).astype(np.int32), letter


def trigram_counts(labelled: DataFrame, buckets: int) -> DataFrame:
    """(lang, bucket, n) of all rows; each task sends one row per bucket it has seen."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first, last, data, at in pieces(batch.column("text")):
                bucket, letter = trigrams(data, at, buckets)
                for lang in set(langs[first:last]):
                    rows = langs[first:last] == lang
                    mine = letter & np.repeat(rows, np.diff(at))
                    total = held.setdefault(lang, np.zeros(buckets, np.int64))
                    total += np.bincount(bucket[mine], minlength=buckets)
        for lang, total in held.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())],
                ["lang", "bucket", "n"],
            )

    counts = arrow_map(labelled.select("lang", "text"), task, "lang string, bucket int, n long")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log-frequencies of trigram buckets, one row per language in sorted order."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        smooth = counts + SMOOTHING
        self.log = np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32)

    def word_scores(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of each word, log-likelihood of each word under each language)."""
        bucket, letter = trigrams(data, at, self.log.shape[1])
        begin, end = runs(letter, at)
        scores = np.empty((len(begin), len(self.languages)))
        for k, table in enumerate(self.log):
            sums = np.concatenate(([0.0], np.cumsum(table[bucket] * letter, dtype=np.float64)))
            scores[:, k] = sums[end] - sums[begin]
        return rows_of(begin, at), scores


def proportions(weight: np.ndarray, heads: np.ndarray, words: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(mixture of each document, its log-likelihood) by expectation-maximisation.

    ``weight``: likelihood of each word under each candidate; ``heads``: first word
    of each document; ``words``: their numbers.
    """
    share = np.full((len(heads), weight.shape[1]), 1 / weight.shape[1], np.float32)
    for _ in range(rounds):
        part = weight * np.repeat(share, words, axis=0)
        part /= part.sum(1, keepdims=True) + np.float32(1e-30)
        share = np.add.reduceat(part, heads, axis=0) / words[:, None].astype(np.float32)
    total = (weight * np.repeat(share, words, axis=0)).sum(1)
    return share, np.add.reduceat(np.log(total + 1e-30), heads)


def mixtures(model: Model, data: np.ndarray, at: np.ndarray) -> list[tuple[list[int], np.ndarray] | None]:
    """For each row the languages it has, largest first, and its proportions of all."""
    out: list[tuple[list[int], np.ndarray] | None] = [None] * (len(at) - 1)
    row, scores = model.word_scores(data, at)
    if not len(row):
        return out
    weight = np.exp(scores - scores.max(1, keepdims=True)).astype(np.float32)
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    words = np.diff(np.append(heads, len(row)))
    share, _ = proportions(weight, heads, words)
    order = np.argsort(-share, axis=1, kind="stable")
    best, size = np.full(len(heads), -np.inf), np.zeros(len(heads), np.int64)
    going, k = np.arange(len(heads)), 0
    while len(going) and k < len(model.languages):
        k += 1
        mine = np.repeat(np.isin(np.arange(len(heads)), going), words)
        own = words[going]
        chosen = np.take_along_axis(weight[mine], np.repeat(order[going, :k], own, axis=0), 1)
        _, likelihood = proportions(chosen, np.cumsum(own) - own, own, ROUNDS if k > 1 else 0)
        value = likelihood - (k - 1) * PENALTY * np.log(own + 1)
        better = value > best[going]
        best[going[better]], size[going[better]] = value[better], k
        going = going[better | (k < LEAST_SIZES)]
    for i, r in enumerate(row[heads]):
        out[r] = order[i, : size[i]].tolist(), share[i]
    return out


def train(labelled: DataFrame) -> Model | None:
    """A model from all rows that have a language; None if there are none."""
    languages = labelled.select("lang").distinct().count()
    if not languages:
        return None
    buckets = min(BUCKETS, 1 << (max(2, MODEL_CELLS // languages).bit_length() - 1))
    rows = trigram_counts(labelled, buckets).toArrow()  # languages x buckets rows at most
    names = sorted(set(rows.column("lang").unique().to_pylist()))
    counts = np.zeros((len(names), buckets))
    coded = rows.column("lang").combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    place = np.array([names.index(x) for x in coded.dictionary.to_pylist()], np.int64)
    counts[place[coded.indices.to_numpy()], rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return Model(names, counts) if names else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows' doc_id with ``lang_pred``, ``score``, and all their ``languages``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            found: list = []
            for _, _, data, at in pieces(batch.column("text")):
                found += mixtures(own, data, at) if own else [None] * (len(at) - 1)
            known = batch.column("has_letter").to_pylist()
            rows = [f if ok else None for f, ok in zip(found, known)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([own.languages[f[0][0]] if f else "und" for f in rows], pa.string()),
                    pa.array([min(1.0, float(f[1][f[0][0]])) if f else 0.0 for f in rows], pa.float64()),
                    pa.array([[own.languages[k] for k in f[0]] if f else [] for f in rows], pa.list_(pa.string())),
                ],
                ["doc_id", "lang_pred", "score", "languages"],
            )

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", letter.alias("has_letter"))
    return arrow_map(narrow, task, "doc_id long, lang_pred string, score double, languages array<string>")


def identify_documents(docs: DataFrame) -> DataFrame:
    """Learned from three quarters of the labelled documents, predicted for all."""
    model = train(docs.where(F.col("lang").isNotNull() & (fold() != HELD_OUT)))
    return identify(docs, model).select(
        "doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages"
    )
