"""Benchmark passages in documents, by a prefix-filtered join over rare word shingles.

A benchmark item is a set of windows of 13 words (one window if it is shorter). A
document contains a window only if it contains every shingle of it, so one shingle
per window is enough to look for: the rarest one in the documents, its necessary
prefix. Documents' shingles are joined with those anchors where the text lies. A match
fixes the window's place (anchor's position less its offset), the place must fit
between the text's ends, and the words there must be the window's words.

One pass over the texts finds where the benchmark's shingles stand, which says how rare
they are; only the anchors' places are followed up. The table that the texts' shingles
are joined with holds the benchmark only; its rows are counted, and beyond
``MAX_BROADCAST_ROWS`` it is shuffled instead of broadcast. Equal texts are looked up
once. Only built-in functions are used.

Cases: null text has no words; an item without words matches nothing; an item without an
id is looked for, and its words are hits, but it is not listed; an item of fewer
words than a shingle is looked for as a whole; texts of any length are looked through
whole; equal texts have equal results, as have
rows that repeat; empty tables give no rows, or documents without hits; other columns
are not looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.llm.common import saved, set_aside, text_digest

WINDOW_WORDS = 13
SHINGLE_WORDS = 5
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 16 << 20
#: A document is contaminated if hit words are at least one in so many.
HIT_SHARE = 20
# Fixed value: what a word is, after lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    """Words after lower-casing A to Z and nothing else."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # lower() changes other letters too, so it will do for ASCII texts only.
    lowered = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(
        F.translate(t, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _digest() -> Column:
    return F.unhex(text_digest())


def shingles(word: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, composed from the words' hashes."""
    one = F.transform(word, lambda w: F.xxhash64(w))

    def joined(a: Column, na: int, b: Column, nb: int) -> Column:
        """Runs of na + nb words: run i of a followed by run i + na of b."""
        n = F.greatest(F.size(word) - F.lit(na + nb - 1), F.lit(0))
        return F.zip_with(F.slice(a, 1, n), F.slice(b, na + 1, n), lambda x, y: F.xxhash64(x, y))

    runs, have = one, 1
    while have < size:
        if 2 * have <= size:
            runs, have = joined(runs, have, runs, have), 2 * have
        else:
            runs, have = joined(runs, have, one, 1), have + 1
    return F.when(F.size(word) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, window, n_words, k, tokens): windows with the shingles of k words in them."""
    item = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words().alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(WINDOW_WORDS))
    parts = []
    for k in range(1, SHINGLE_WORDS + 1):
        fits = F.size("w") == k if k < SHINGLE_WORDS else F.size("w") >= k
        parts.append(item.where(fits).select("item_id", "w", F.lit(k).alias("k"), shingles(F.col("w"), k).alias("t")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.select(
        "item_id", "w", "k", "t", F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("at")
    ).select(
        "item_id", "k", F.slice("w", F.col("at"), length).alias("window"),
        F.slice("t", F.col("at"), length - F.col("k") + 1).alias("tokens"),
    )


def _small(frame: DataFrame) -> DataFrame:
    """Marked for broadcast if its rows are few enough; else left to be shuffled."""
    return F.broadcast(frame) if frame.count() <= MAX_BROADCAST_ROWS else frame


def postings(text: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """(digest, pos, k, token): where the windows' shingles stand in the texts.

    The texts' own words stay behind: a row that is made for every shingle must not
    carry its text.
    """
    parts = []
    for k in sizes:
        wanted = saved(
            windows.where(F.col("k") == k).select(F.explode("tokens").alias("token")).distinct(), "benchmark-tokens"
        )
        every = text.select("digest", F.posexplode(shingles(F.col("w"), k)).alias("pos", "token"))
        parts.append(every.join(_small(wanted), "token").select("digest", "pos", F.lit(k).alias("k"), "token"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.distinct()


def anchors(windows: DataFrame, found: DataFrame) -> DataFrame:
    """(k, token, offset, window, items): the rarest shingle of each window, and whose it is.

    A window with a shingle that no text has cannot occur and gets none.
    """
    counts = found.groupBy("k", "token").agg(F.count("*").alias("n"))
    each = windows.groupBy("k", "window", "tokens").agg(F.collect_set("item_id").alias("items")).select(
        "k", "window", "items", F.size("tokens").alias("of"), F.posexplode("tokens").alias("offset", "token")
    )
    return (
        each.join(counts, ["k", "token"])
        .groupBy("k", "window", "items", "of")
        .agg(F.min(F.struct("n", "offset", "token")).alias("rarest"), F.count("*").alias("present"))
        .where(F.col("present") == F.col("of"))
        .select("k", "window", "items", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"))
    )


def candidates(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(q2_digest, q2_found): the windows that may stand in a text, and where."""
    windows = saved(item_windows(benchmark), "benchmark-windows")
    sizes = sorted(r["k"] for r in windows.select("k").distinct().collect())  # five at most
    kind = "array<struct<start:int,window:array<string>,items:array<string>>>"
    if not sizes:
        return docs.limit(0).select(_digest().alias("q2_digest"), F.lit(None).cast(kind).alias("q2_found"))
    text = docs.select(_digest().alias("digest"), words().alias("w"))
    found = saved(postings(text, windows, sizes), "benchmark-postings")
    anchor = saved(anchors(windows, found), "benchmark-anchors")
    start = F.col("pos") - F.col("offset")
    place = found.join(anchor, ["k", "token"]).where(start >= 0)
    rows = place.groupBy("digest").agg(F.collect_list(F.struct(start.alias("start"), "window", "items")).alias("q2_found"))
    return saved(rows.withColumnRenamed("digest", "q2_digest"), "benchmark-candidates")


def with_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows with ``q2_words`` and ``q2_hit``, numbers of words, and ``q2_items``, a sorted list.

    Candidates are written and measured: they may be broadcast to the texts up to
    ``MAX_BROADCAST_BYTES``; if there are more, texts are shuffled once, and those with many copies are split.
    """
    found = candidates(docs, benchmark)
    # A small file can hold many equal windows; what counts is what they are in memory.
    one = lambda c: 32 + 16 * F.size(c["window"]) + F.octet_length(F.array_join(c["window"], "")) + F.octet_length(
        F.array_join(c["items"], "")) + 16 * F.size(c["items"])
    size = F.aggregate("q2_found", F.lit(0).cast("long"), lambda n, c: n + one(c))
    if (found.agg(F.sum(size)).first()[0] or 0) > MAX_BROADCAST_BYTES:
        found = found.hint("merge")
    marked = docs.withColumn("q2_key", _digest())
    marked = marked.join(found, marked["q2_key"] == found["q2_digest"], "left").withColumn("q2_w", words())
    end = lambda c: c["start"] + F.size(c["window"])
    real = F.filter(
        "q2_found", lambda c: (end(c) <= F.size("q2_w")) & (F.slice("q2_w", c["start"] + 1, F.size(c["window"])) == c["window"])
    )
    marked = marked.withColumns({"q2_words": F.size("q2_w").cast("long"), "q2_real": F.array_sort(real)})
    # In order of their starts each adds what lies behind the furthest end so far.
    hit = F.aggregate(
        "q2_real", F.struct(F.lit(0).alias("reach"), F.lit(0).alias("hit")),
        lambda s, c: F.struct(
            F.greatest(s["reach"], end(c)).alias("reach"),
            (s["hit"] + F.greatest(end(c) - F.greatest(c["start"], s["reach"]), F.lit(0))).alias("hit"),
        ),
        lambda s: s["hit"],
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("q2_real", lambda c: c["items"]))))
    return marked.withColumns(
        {
            "q2_hit": F.coalesce(hit, F.lit(0)).cast("long"),
            "q2_items": F.coalesce(items, F.array().cast("array<string>")),
        }
    )


def contaminated() -> Column:
    return (F.col("q2_hit") > 0) & (HIT_SHARE * F.col("q2_hit") >= F.col("q2_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words, hit words, items and verdict of every document."""
    return with_hits(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", F.col("q2_words").alias("n_words"), F.col("q2_hit").alias("n_hit"),
        F.size("q2_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "q2_items"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they came."""
    named, back = set_aside(docs, "q2_")
    return with_hits(named, benchmark).where(~contaminated()).select(*back)
