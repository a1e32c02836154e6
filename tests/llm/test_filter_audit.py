"""The filter audit against filters applied one after the other."""

from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from sensorgrid.llm import filter_audit
from sensorgrid.llm.queries import ORACLES, QUERIES

CLASHES = ["row", "part", "digest", "fails", "good", "toxic", "first", "last", "range", "total", "place", "n", "unions", "A", "E"]


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def expected(rows, labels) -> list[tuple]:
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}

    def fails(i, text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in rows)
        out = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        out += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        return set(out + "E" * copy)

    judged = [(s or "", i, fails(i, t)) for i, t, s in rows]
    out = []
    for part in {p for p, _, _ in judged}:
        own = [(i, f) for p, i, f in judged if p == part]
        told, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, c in enumerate(order, 1):
                gone = [(i, f) for i, f in left if c in f]
                left = [(i, f) for i, f in left if c not in f]
                shapley[c] += len(gone)
                told.append((
                    part, order, step, len(left), len(gone), sum(c in f for _, f in own) - len(gone),
                    sum(f == {c} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ))
        out += [(*t, shapley[t[1][t[2] - 1]]) for t in told]
    return sorted(out)


def awkward() -> tuple[list, list]:
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    texts = [None, "", " \n", "A", "x# y", "word " * 60, "É" * 80]
    texts += [" ".join(word() for _ in range(rng.choice([10, 49, 50, 51, 80]))) for _ in range(30)]
    texts += [" ".join(word().upper() if rng.random() < 0.1 else word() for _ in range(70)) + rng.choice(["", "|", "%"]) for _ in range(20)]
    rows = [(k, t, rng.choice(["a", "b", None, ""])) for k, t in enumerate(texts)]
    rows += [(100 + k, rng.choice(texts), rng.choice(["a", "c"])) for k in range(40)]
    rows += [(None, texts[10], "a"), (None, None, "b"), rows[12], rows[12], (rows[13][0], "other text", "a")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in rows[::2]] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def test_awkward_rows(spark):
    rows, labels = awkward()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    docs = docs.withColumns({c: F.lit(7) for c in CLASHES})
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(5))
    assert sorted(map(tuple, filter_audit.audit(docs, told).collect())) == expected(rows, labels)


def test_empty_tables(spark):
    docs, labels = "doc_id long, text string, source string", "doc_id long, quality int, toxic int"
    assert filter_audit.audit(spark.createDataFrame([], docs), spark.createDataFrame([], labels)).collect() == []
    one = spark.createDataFrame([(1, "x", None)], docs)
    assert filter_audit.audit(one, spark.createDataFrame([], labels)).count() == 600


def test_lists_cover_a_range_each(spark):
    """However many rows a part has, no list is longer than a range."""
    docs = spark.range(40_000, numPartitions=2).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("hot").alias("source"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lists = filter_audit.posting_lists(filter_audit.verdicts(docs, labels))
    sizes = lists.select("part", "total", F.size("A").alias("a"), F.size("E").alias("e")).collect()
    assert len(sizes) >= 5 and max(r["total"] for r in sizes) <= filter_audit.RANGE
    assert sum(r["a"] for r in sizes) == 40_000 and sum(r["e"] for r in sizes) == 39_999


def test_merges_equal_sets():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 50))) for _ in range(2))
        assert filter_audit.merged(a, b).tolist() == sorted({*a.tolist(), *b.tolist()})
        assert filter_audit.shared(a, b) == len({*a.tolist()} & {*b.tolist()})


def test_table(spark, sf_dir):
    name = "op13_posting_list_audit"
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
