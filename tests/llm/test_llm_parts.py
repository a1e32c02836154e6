"""Parts of the operators that need no Spark."""

from __future__ import annotations

import gzip
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import edit_distance as slow_distance

from sensorgrid.llm import bpe, langid, line_dedup, suffix_dedup, textscan, warc
from sensorgrid.llm.queries import vocabulary_path


DATE = "2024-01-01T00:00:00Z"


@pytest.fixture(scope="module")
def encoder():
    with open(vocabulary_path(), encoding="utf-8") as f:
        return bpe.Encoder(json.load(f))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


PIECES = [
    "a", " the", "ing", " ", "  ", "\n", "\t", "\r\n", "'s", "'re", "'ll", "'", "''", "!", "...", "-", "é", "É", "ñ", "ß",
    " ", " ", "　", "\u0085", "\x1c", "中文", "👍", "1", "23", "²", "½", "×", "÷", "​", "﻿", "\x00",
    "\x7f", "<|endoftext|>", "<|endof", "WORLD", "_", "#", "ǅ", "ʰ", "٣", "Ⅷ", "𝒳", "é", "ſ",
]


def test_fragments_encode_as_the_whole(encoder, library):
    random.seed(5)
    texts = ["".join(random.choice(PIECES) for _ in range(random.randint(0, 12))) for _ in range(8000)]
    texts += ["", "a" * 3000, "ab" * 2000, " " * 999 + "x", "\n" * 500 + "a", "é" * 700, "''''" * 300]
    texts.append("".join(random.choice("ABCDabcd0123+/") for _ in range(20000)))
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == want, text[:80]
        back = encoder.decode(want).decode("utf-8", "replace")
        assert back == library.decode(want, skip_special_tokens=False)


def test_long_and_short_merges_agree(encoder):
    random.seed(6)
    for _ in range(300):
        word = bytes(random.choice(b"etaoin shrdlu") for _ in range(random.randint(1, 90)))
        parts = [word[i : i + 1] for i in range(len(word))]
        long = [encoder.vocabulary.id_of[p] for p in encoder.vocabulary._merged_long(parts)]
        assert encoder.vocabulary.merged(word) == long


def test_edit_distance():
    random.seed(7)
    for _ in range(400):
        a, b = ("".join(random.choice("abé") for _ in range(random.randint(0, 14))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == slow_distance(a, b)


def test_hashes_do_not_depend_on_the_place():
    data = np.frombuffer(b"one two one two three", np.uint8)
    sums = textscan.prefix_hash(data)
    begin, end = textscan.runs(~textscan.SPACE[data], np.array([0, len(data)]))
    word = textscan.span_hash(sums, begin, end)
    assert word[0] == word[2] and word[1] == word[3] and len(set(word.tolist())) == 3
    lines = textscan.sequence_hash(word, np.array([0, 2]), np.array([2, 4]))
    assert lines[0] == lines[1]


def test_pieces_cover_sliced_columns_with_nulls():
    column = pa.array(["x", None, "", "long text", "é"]).slice(1)
    rows = [data[a:b].tobytes().decode() for _, _, data, at in textscan.pieces(column, 4) for a, b in zip(at, at[1:])]
    assert rows == ["", "", "long text", "é"]


def test_equal_strings_have_equal_anchors():
    random.seed(8)
    shared = bytes(random.choice(b"abcdef ") for _ in range(64))
    texts = [bytes(random.choice(b"abcdef ") for _ in range(n)) + shared + b"z" * n for n in (5, 90, 33)]
    offsets = set()
    for text in texts:
        found = suffix_dedup.Anchors(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 40, 8)
        start = text.index(shared)
        for a, n, o in zip(found.start, found.count, found.offset):
            if a <= start < a + n:
                offsets.add(int(a + o - start))
    assert len(offsets) == 1


def _page(n: int, html: bytes, **other) -> dict:
    import hashlib

    page = {"page_id": n, "url": f"http://x/{n}\r\n%0A", "payload": html, "payload_bytes": len(html),
            "payload_digest": hashlib.sha1(html).hexdigest(), "record_type": "response", "refers_to": None}
    return page | other


def test_archive_is_one_gzip_member_per_record():
    pages = [_page(1, b"<a>" * 50000), _page(2, b""), _page(3, b"\r\n\r\nx"), _page(4, b"q", record_type="revisit", refers_to=1)]
    members = [warc.record_member(p, DATE) for p in pages]
    for member in members:
        assert gzip.decompress(member).startswith(b"WARC/1.1\r\n")
    back = list(warc.sequential_records(b"".join(members)))
    assert [r["page_id"] for r in back] == [1, 2, 3, 4]
    assert [r["payload"] for r in back] == [b"<a>" * 50000, b"", b"\r\n\r\nx", None]
    assert [r["url"] for r in back] == [p["url"] for p in pages]
    assert back[3]["refers_to"] == 1 and [r["digest_ok"] for r in back] == [True] * 3 + [None]
    assert {r["date"] for r in back} == {DATE}
    # A whole file in one member is read as well.
    one = gzip.compress(b"".join(gzip.decompress(m) for m in members))
    assert [r["page_id"] for r in warc.sequential_records(one)] == [1, 2, 3, 4]


def test_reader_finds_damage():
    good = gzip.decompress(warc.record_member(_page(1, b"payload"), DATE))
    changed = gzip.compress(good.replace(b"payload\r\n", b"paYload\r\n"))
    assert [r["digest_ok"] for r in warc.sequential_records(changed)] == [False]
    with pytest.raises(ValueError):
        list(warc.sequential_records(gzip.compress(good[:-6])))
    with pytest.raises(ValueError):
        list(warc.sequential_records(gzip.compress(b"no record")))


def test_mixture_finds_both_languages():
    text = {"x": b"aba bab abab baba " * 40, "y": b"cdc dcd cdcd dcdc " * 40}
    counts = np.zeros((2, 1 << 10))
    for k, data in enumerate(text.values()):
        data = np.frombuffer(data, np.uint8)
        bucket, letter = langid.trigrams(data, np.array([0, len(data)]), 1 << 10)
        counts[k] = np.bincount(bucket[letter], minlength=1 << 10)
    model = langid.Model(["x", "y"], counts)
    rows = [text["x"], text["x"] + text["y"][:360], b"", b"... 12"]
    at = np.cumsum([0, *map(len, rows)])
    found = langid.mixtures(model, np.frombuffer(b"".join(rows), np.uint8), at)
    assert found[0][0] == [0] and found[1][0] == [0, 1] and found[2] is None and found[3] is None
    assert abs(found[1][1][1] - 1 / 3) < 0.05
