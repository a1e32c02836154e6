"""Fences, mixtures and the k-d tree against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import brute
import numpy as np
import pytest

from sensorgrid.llm import blob_ledger, langid, quality, sharding


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


# Quality

def _signals(text: str) -> list[float] | None:
    """None for a text that fails the base rule."""
    words, chars, symbols, again, repeated, failed = brute.quality(text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (text or "").split("\n"))
    return None if failed else [chars / words, symbols / words, again / lines, repeated / words]


def _fence(values: list[float]) -> tuple[float, float]:
    gamma = quality.GAMMA
    seen = sorted(0.0 if v == 0 else 2 * gamma ** math.ceil(math.log(v) / math.log(gamma)) / (gamma + 1) for v in values)
    at = lambda q: next(v for k, v in enumerate(seen, 1) if k > q * (len(seen) - 1))
    q1, q3 = at(0.25), at(0.75)
    first = lambda spreads: next((s for s in spreads if s > 0), 0.0)
    down = max(q3 - q1, first(q1 - at(t) for t in quality.TAILS))
    up = max(q3 - q1, first(at(1 - t) - q3 for t in quality.TAILS))
    low, high = q1 * ((gamma + 1) / (2 * gamma) - 1e-9), q3 * ((gamma + 1) / 2 + 1e-9)
    return low - quality.FENCE * down, high + quality.FENCE * up


def expected_kept(rows) -> list[bool]:
    judged = [(lang, source, _signals(text)) for _, text, lang, source in rows]
    groups: dict = defaultdict(list)
    for lang, source, found in judged:
        if found:
            for key in ((lang, source), (lang,), ()):
                groups[key].append(found)
    blend = lambda own, n, wide: (own * n + wide * quality.BLEND) / (n + quality.BLEND)
    out = []
    for lang, source, found in judged:
        good = found is not None
        for k in range(4) if found else ():
            own, language, whole = ([f[k] for f in groups[key]] for key in ((lang, source), (lang,), ()))
            edges = [
                blend(a, len(own), blend(b, len(language), c)) for a, b, c in zip(_fence(own), _fence(language), _fence(whole))
            ]
            good = good and edges[0] <= found[k] <= edges[1]
        out.append(good)
    return out


def test_fences_and_verdicts(spark):
    rng = random.Random(21)
    rows = []
    for k in range(400):
        longest = rng.choice([4, 8]) if k % 9 else 14
        words = ["".join(rng.choice("abcdefg#") if rng.random() < 0.02 else rng.choice("hilmno") for _ in range(rng.randint(1, longest)))
                 for _ in range(rng.randint(5, 80))]
        text = "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words) + ("\nagain and again" * rng.randint(0, 3))
        rows.append((k, text, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "a", "b", None])))
    rows += [(900, None, "en", "a"), (901, "", "xx", "only"), (902, " ".join(f"w{k}" for k in range(30)), "xx", "only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
    want = dict(zip((r[0] for r in rows), expected_kept(rows)))
    assert got == want and 20 < sum(want.values()) < len(rows) - 20


def test_a_growing_group_moves_its_fences_without_a_jump(spark):
    """One document more in a group changes a fence by no more than its weight."""
    rng = random.Random(22)
    wide = [(k, " ".join("x" * rng.randint(1, 9) for _ in range(40)), "en", "wide") for k in range(300)]
    highs = []
    for n in (98, 99, 100, 101, 102):
        own = [(1000 + k, " ".join(f"{j:02d}{k:03d}" for j in range(40)), "en", "narrow") for k in range(n)]
        docs = spark.createDataFrame(wide + own, "doc_id long, text string, lang string, source string")
        counted = quality.with_counts(docs).drop("text")
        fence = quality.thresholds(quality.sketch(counted)).where("source = 'narrow'").first()
        highs.append(fence["q5_high_word_length"])
    steps = [abs(a - b) for a, b in zip(highs, highs[1:])]
    assert max(steps) < 0.02 * highs[0]


# Languages

def _word_logs(model: langid.Model, text: str) -> list[list[float]]:
    buckets = model.log.shape[1]
    bits = buckets.bit_length() - 1
    out = []
    for word in re.findall(rb"[a-z\x80-\xff]+", text.translate(brute.ASCII_LOWER).encode()):
        padded = b" " + word + b" "
        codes = [int.from_bytes(padded[k : k + 3], "big") for k in range(len(word))]
        places = [((c * 2654435761) & 0xFFFFFFFF) >> (32 - bits) for c in codes]
        out.append([sum(float(row[p]) for p in places) for row in model.log])
    return out


def _em(weights: list[list[float]], rounds: int) -> tuple[list[float], float]:
    n = len(weights[0])
    share = [1 / n] * n
    for _ in range(rounds):
        total = [0.0] * n
        for w in weights:
            part = [a * b for a, b in zip(w, share)]
            for k in range(n):
                total[k] += part[k] / (sum(part) + 1e-30)
        share = [t / len(weights) for t in total]
    return share, sum(math.log(sum(a * b for a, b in zip(w, share)) + 1e-30) for w in weights)


def test_mixtures_equal_plain_expectation_maximisation():
    rng = random.Random(23)
    alphabets = ["abcde", "fghij", "klmno", "pqrst", "éèñüß"]
    word = lambda k: "".join(rng.choice(alphabets[k]) for _ in range(rng.randint(2, 6)))
    counts = np.zeros((5, 1 << 12))
    for k in range(5):
        data = np.frombuffer(" ".join(word(k) for _ in range(3000)).encode(), np.uint8)
        bucket, letter = langid.trigrams(data, np.array([0, len(data)]), 1 << 12)
        counts[k] = np.bincount(bucket[letter], minlength=1 << 12)
    model = langid.Model(list("vwxyz"), counts)
    texts = [" ".join(word(rng.choice(kinds)) for _ in range(n)) for kinds in ([0], [1, 2], [0, 3, 4], [0, 1, 2, 3], [0, 1, 2, 3, 4])
             for n in (1, 5, 40, 200)]
    data = [t.encode() for t in texts]
    at = np.cumsum([0] + [len(d) for d in data])
    found = langid.mixtures(model, np.frombuffer(b"".join(data), np.uint8), at)
    sizes = set()
    for text, (languages, share) in zip(texts, found):
        logs = _word_logs(model, text)
        weights = [[math.exp(x - max(row)) for x in row] for row in logs]
        want, _ = _em(weights, langid.ROUNDS)
        assert np.allclose(share, want, atol=1e-3)
        order = sorted(range(5), key=lambda k: -want[k])
        values = []
        for k in range(1, 6):
            _, likelihood = _em([[w[j] for j in order[:k]] for w in weights], langid.ROUNDS if k > 1 else 0)
            values.append(likelihood - (k - 1) * langid.PENALTY * math.log(len(weights) + 1))
        best = max(range(5), key=lambda k: (values[k], -k))
        assert len(languages) == best + 1, (text[:40], values)
        sizes.add(len(languages))
    # Documents of four and five languages have them all.
    assert {4, 5} <= sizes


# Shards

def _weighted(rows, axis: str) -> list[int]:
    """Bytes to the left of every possible cut."""
    out, total = [0], 0
    for r in sorted(rows, key=lambda r: (r[axis], r["tie"])):
        total += r["size"]
        out.append(total)
    return out


def test_every_cut_is_a_weighted_median_of_the_widest_dimension(spark):
    rng = random.Random(24)
    rows = [(rng.choice([k, k, 7, None]), "x" * rng.choice([0, 1, 50, rng.randint(0, 3000)]), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c"]))
            for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    point = sharding.saved(sharding.points(docs), "test-points")
    held = [r.asDict() for r in point.collect()]
    whole = {d: max(r[d] for r in held) - min(r[d] for r in held) or 1 for d in sharding.DIMENSIONS}
    checked = 0

    def walk(node: sharding.Node, mine: list) -> None:
        nonlocal checked
        if not node.children:
            return
        extent = {d: (max(r[d] for r in mine) - min(r[d] for r in mine)) / whole[d] for d in sharding.DIMENSIONS} if mine else {}
        left = [r for r in mine if (r[node.axis], r["tie"]) < (node.value, node.tie)]
        right = [r for r in mine if (r[node.axis], r["tie"]) >= (node.value, node.tie)]
        if mine:
            assert extent[node.axis] == max(extent.values())
            total = sum(r["size"] for r in mine)
            target = total * (node.shards // 2) / node.shards
            best = min(abs(w - target) for w in _weighted(mine, node.axis))
            assert abs(sum(r["size"] for r in left) - target) <= best + sharding.TOLERANCE * total + 1e-6
            checked += 1
        walk(node.children[0], left)
        walk(node.children[1], right)

    walk(sharding.kd_tree(point, sharding.SHARDS), held)
    assert checked == sharding.SHARDS - 1


# Secrets

def test_secrets_of_a_text_with_very_many_matches(spark):
    import time

    n = 100_000
    text = " ".join(f"{k:032x}é" for k in range(n))
    begin = time.perf_counter()
    row = blob_ledger.secret_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    took = time.perf_counter() - begin
    print("seconds for 100,000 matches:", took)
    assert row["n_hex"] == n and took < 60
    places = [p.split(":") for p in row["spans"].split(",")]
    assert [(int(a), int(b)) for _, a, b in places] == [(34 * k, 34 * k + 32) for k in range(n)]
    assert row["base_sha256"] == brute.sha256(row["spans"])


def test_key_files_are_spans_of_their_own(spark):
    texts = ["-----BEGIN PRIVATE KEY-----", "é -----BEGIN RSA PRIVATE KEY----- token=abcdefgh1 -----BEGIN EC PRIVATE KEY-----",
             "-----BEGIN PUBLIC KEY-----", "-----BEGIN rsa PRIVATE KEY-----", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["spans"], r["base_sha256"]) for r in blob_ledger.secret_spans(docs).collect()}
    for k, text in enumerate(texts):
        pem = [(m.start(), f"pem:{m.start()}:{m.end()}") for m in re.finditer(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", text or "")]
        base = [(m.start(), f"assign:{m.start()}:{m.end()}") for m in re.finditer(r"token=[A-Za-z0-9+/_.=-]+", text or "")]
        assert got[k] == (",".join(x for _, x in sorted(pem + base)), brute.sha256(",".join(x for _, x in sorted(base))))
