"""Phrases against counting every run of words."""

from __future__ import annotations

import random
import re
from collections import Counter

import brute
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from sensorgrid.llm import phrases
from sensorgrid.llm.queries import ORACLES, QUERIES

CLASHES = ["word", "path", "n", "a", "l", "r", "score", "rank", "phrase", "cut", "first", "rest", "total", "words", "key", "at", "id", "k", "place"]


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def expected(rows, least: int, most: int) -> list[tuple]:
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(brute.ASCII_LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            count.update((lang, *words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang in total:
        own = {p[1:]: a for p, a in count.items() if p[0] == lang and a >= least and len(p) > 2}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        scored = []
        for p, a in own.items():
            if any(len(q) > len(p) and own[q] >= a and inside(p, q) for q in own):
                continue
            cuts = []
            for k in range(1, len(p)):
                l, r = count[lang, *p[:k]], count[lang, *p[k:]]  # noqa: E741
                cuts.append((1000 * a * total[lang] // (l * r), k, l, r))
            score, _, l, r = min(cuts)  # noqa: E741
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def awkward() -> list[tuple]:
    rng = random.Random(10)
    vocabulary = ["the", "The", "of", "é", "x y", "#1", "ok", " ", "a-b", "New", "York", "city"]
    rows = [(None, "en"), ("", None), (" \t ", "en"), ("...", "en"), ("one", None)]
    for _ in range(120):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",", "\n", "  ", "\t"]) for _ in range(rng.randint(1, 60))]
        rows.append((" ".join(words), rng.choice(["en", "en", "fr", None, "und"])))
    rows += [("new york city hall is big", "en")] * 9 + [("a a a a a a a", "fr")] * 3 + [("w" * 5000 + " " + "v" * 3000, "en")] * 6
    return rows


@pytest.mark.parametrize("burst, held", [(1 << 14, 400_000), (4, 20)])
def test_awkward_rows(spark, burst, held):
    """The same with containers that burst and subtrees that are spilled again and again."""
    rows = awkward()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumns({c: F.lit(7) for c in CLASHES})
    got = phrases.Phrases(docs, 5, burst=burst, held=held).top(40)
    want = expected(rows, 5, 40)
    assert len(want) > 60
    assert sorted(map(tuple, got.collect())) == want


def test_ranks_end_within_ties(spark):
    rows = [(f"p{k} q{k}", "en") for k in range(30) for _ in range(3)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, phrases.collocations(docs, 3, 10).collect())) == expected(rows, 3, 10)


def test_products_beyond_64_bits(spark):
    """Counts as large as a corpus has; the score is exact."""
    n = 7 * 10**14 + 3
    row = spark.createDataFrame([(n - 1, n, n - 2, n - 5)], "a long, n long, l long, r long")
    whole = lambda c: F.col(c).cast("decimal(16,0)")
    row = row.withColumns({"over": whole("a") * (whole("n") * F.lit(1000).cast("decimal(4,0)")), "under": whole("l") * whole("r")})
    assert row.select(F.expr("over div under")).first()[0] == 1000 * (n - 1) * n // ((n - 2) * (n - 5))


def test_spilled_subtrees_are_whole_and_sorted():
    trie = phrases.HatTrie(1, burst=3, held=10)
    want: Counter = Counter()
    rng = random.Random(11)
    runs = []
    for _ in range(60):
        head, tails = rng.choice("xyz"), ["".join(rng.choice("abc") for _ in range(rng.randint(2, 4))).encode() for _ in range(5)]
        counts = [rng.randint(1, 3) for _ in tails]
        for t, n in zip(tails, counts):
            want[head, t] += n
        trie.add(head, tails, counts)
        runs += list(trie.spilled())
        assert trie.total <= 10
    runs += list(trie.spilled(True))
    got: Counter = Counter()
    for head, tails, counts in runs:
        assert tails == sorted(set(tails))
        for t, n in zip(tails, counts):
            got[head, t] += n
    assert got == want and trie.total == 0 and not trie.top


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_table(spark, sf_dir):
    name = "op12_hat_trie_phrases"
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
