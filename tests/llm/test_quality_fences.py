"""Fences follow the sketches: every signal rejects what is unusual in its group only."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sensorgrid.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _lines(rng: random.Random, longest: int = 8) -> list[list[str]]:
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, longest)))
    return [[word() for _ in range(6)] for _ in range(40)]


def _marked(kind: str, rng: random.Random) -> str:
    lines = _lines(rng, 12 if kind == "word_length" else 8)
    if kind == "symbol_ratio":
        for line in lines[::5]:
            line[0] += "#"
    elif kind == "dup_line_ratio":
        for k in range(6):
            lines.insert(5 * k + 3, ["Share", "this"])
    elif kind == "repeat_ratio":
        lines[30], lines[31] = lines[3], lines[4]
        lines[30] = [*lines[3][:-1], *lines[3][-1:]]
        lines[31] = [*lines[4], "end"]
    return "\n".join(" ".join(line) for line in lines)


@pytest.mark.parametrize("kind", quality.SIGNALS)
def test_every_signal_rejects_an_outlier_of_its_group(spark, kind):
    rng = random.Random(7)
    rows = [(k, _marked("", rng), "en", "clean") for k in range(150)]
    rows += [(1000 + k, _marked(kind, rng), "en", "marked") for k in range(150)]
    rows.append((500, _marked(kind, rng), "en", "clean"))
    out = quality.quality(spark.createDataFrame(rows, SCHEMA))
    assert out.where("base_failed").count() == 0
    gone = {r["doc_id"] for r in out.where("not kept").collect()}
    assert 500 in gone
    # What is an outlier of one group is usual in the other; few go of either.
    assert len([i for i in gone if i < 150]) <= 3 and len([i for i in gone if i >= 1000]) <= 3


def test_most_of_every_group_is_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = quality.quality(docs).where("not base_failed")
    share = judged.agg(F.avg(F.col("kept").cast("int")).alias("kept")).first()["kept"]
    print("kept of those that pass the base rule:", share)
    assert share >= 0.9
