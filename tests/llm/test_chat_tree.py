"""Conversations as trees: read back exactly, shared tokens once, intervals of ancestors only."""

from __future__ import annotations

import hashlib
import random

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from sensorgrid.llm import chat_tree
from sensorgrid.llm.queries import CONTROL_TEXT, ORACLES, QUERIES, vocabulary_path

COLUMNS = "conv_id long, turn long, role string, text string"
CLASHES = ["turns", "chain", "rank", "depth", "node", "owner", "start", "size", "path", "tokens", "position", "attends", "loss", "part", "local"]
HARD = ["\\", "\\\\", "<", ">", "\\<", "<\\", "\\l", "\\\\l", "</turn>\n", "<turn assistant>", CONTROL_TEXT, "<|endoftext|>", "é́ \U0001f600 ", "\r\n\0", " "]


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def conversations() -> list[tuple]:
    rng = random.Random(8)
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(HARD)]
    rows += [(2, k, None, t) for k, t in enumerate(HARD[:3])] + [(3, 0, "assistant", None), (3, 1, "assistant", "")]
    rows += [(4, None, "user", "first"), (4, 0, "<turn x>", "second"), (4, 0, "assistant", "tie b"), (4, 0, "assistant", "tie a")]
    rows += [(None, 0, "user", "nobody"), (None, 1, "assistant", "none")] + [(5, 0, "user", "same")] * 2
    # A tree of shared beginnings, with equal conversations and beginnings of others among them.
    for conv in range(10, 80):
        depth = rng.randint(1, 6)
        rows += [(conv, k, ("system", "user", "assistant")[k % 3], f"turn {k} {rng.randint(0, 1) if k else 0}") for k in range(depth)]
    rows += [(90, 0, "user", "long " * 40000)]
    return rows


def ordered(rows) -> dict:
    out: dict = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_escapes_are_reversible():
    rng = random.Random(9)
    for text in HARD + ["".join(rng.choice("\\<>lg a") for _ in range(12)) for _ in range(500)]:
        assert chat_tree.unescape(chat_tree.escape(text)) == text
        assert "<" not in chat_tree.escape(text) and ">" not in chat_tree.escape(text)


def test_conversations_come_back(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, COLUMNS).repartition(4).withColumns({c: F.lit(7) for c in CLASHES})
    got = {r["conv_id"]: tuple(r)[1:] for r in chat_tree.format_conversations(turns, vocabulary_path()).collect()}
    want = {}
    for conv, told in ordered(rows).items():
        loss = "".join(t for r, t in told if r == "assistant")
        formatted = "".join(f"<turn {chat_tree.escape(r)}>{chat_tree.escape(t)}</turn>\n" for r, t in told)
        want[conv] = (len(told), sha("".join(f"{r}\n{t}\n" for r, t in told)), len(loss), sha(loss), len(formatted))
    assert got == want


def test_shared_turns_stand_once(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, COLUMNS).repartition(4)
    forest = chat_tree.Forest(turns, vocabulary_path())
    packed = sorted(forest.packed.collect(), key=lambda r: r["start"])
    told = ordered(rows)
    beginnings = {tuple(t[: k + 1]) for t in told.values() for k in range(len(t))}
    assert len(packed) == len(beginnings)
    # The sequence has no gaps, and every node comes after its ancestors and before what follows them.
    end, open_nodes = 0, []
    for r in packed:
        assert r["start"] == end
        end += len(r["tokens"])
        del open_nodes[r["depth"] :]
        assert r["depth"] == len(open_nodes) and r["tree"] == (open_nodes[0]["start"] if open_nodes else r["start"])
        ancestors = [(n["start"], n["start"] + len(n["tokens"])) for n in open_nodes]
        assert r["position"] == sum(b - a for a, b in ancestors)
        seen = [i for a in r["attends"] for i in range(a["start"], a["stop"])]
        assert seen == [i for a, b in ancestors for i in range(a, b)]
        assert all(a["stop"] < b["start"] for a, b in zip(r["attends"], r["attends"][1:]))
        open_nodes.append(r)
    # Every conversation is the path to one of the nodes.
    at = {r["start"]: r for r in packed}
    for r in forest.paths.collect():
        assert [p["depth"] for p in r["path"]] == list(range(len(told[r["conv_id"]])))
        assert [at[p["start"]]["depth"] for p in r["path"]] == list(range(len(r["path"])))


def test_empty_table(spark):
    assert chat_tree.format_conversations(spark.createDataFrame([], COLUMNS), vocabulary_path()).collect() == []


def test_table(spark, sf_dir):
    name = "op11_prefix_tree_chat"
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
