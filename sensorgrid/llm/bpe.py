"""Byte-pair encoding of whole texts, cut where no token can reach across.

A pair of neighbouring bytes that occurs inside no token of the vocabulary is a
certain cut: no merge ever joins across it. ``Splitter`` finds all cuts of a text
with one table look-up per byte; the fragments between them are short, most of
them were seen before, and each is encoded by itself. Their ids, put together, are
the ids of the whole text.

The vocabulary first splits text by a pattern of classes, and that pattern may look
across a cut. A cut is therefore used only where the pattern would start anew
anyway: not after white space (its look-ahead decides there), not next to an
apostrophe that follows other punctuation or precedes anything (contractions), and
only between whole characters. Everything else about a fragment is decided inside it.

Cases: null text is empty; an empty text has no ids; the string of a special token in a
text becomes that token, and the parts around it are encoded apart; texts of any length are encoded piece
by piece; a memory bound holds for the fragments remembered; repeated rows are encoded
alike; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from sensorgrid.llm.common import arrow_map
from sensorgrid.llm.textscan import pieces

# Fixed value: the pattern by which byte-level vocabularies split text first.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 400_000
MAX_REMEMBERED_BYTES = 48
LONG_WORD = 100
MAX_VOCABULARY_CHARS = 64 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in vocabulary files.

    Printable Latin-1 stands for itself; the others follow from U+0100 in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, their ids, and the rank of every merge."""

    def __init__(self, file: dict) -> None:
        alphabet = byte_alphabet()
        self.id_of = {bytes(alphabet[c] for c in t): i for t, i in file["model"]["vocab"].items()
                      if all(c in alphabet for c in t)}
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens") or ()}
        self.bytes_of = {i: t for t, i in self.id_of.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for k, pair in enumerate(file["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[bytes(alphabet[c] for c in left), bytes(alphabet[c] for c in right)] = k

    def merged(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the lowest-ranked pair is merged first, the leftmost of equals."""
        parts = [word[i : i + 1] for i in range(len(word))]
        if len(parts) > LONG_WORD:
            parts = self._merged_long(parts)
        else:
            get, never = self.rank.get, len(self.rank)
            ranks = [get(pair, never) for pair in zip(parts, parts[1:])]
            while ranks and (least := min(ranks)) < never:
                i = ranks.index(least)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((parts[i - 1], parts[i]), never)
                if i < len(ranks):
                    ranks[i] = get((parts[i], parts[i + 1]), never)
        return [self.id_of[p] for p in parts]

    def _merged_long(self, parts: list[bytes]) -> list[bytes]:
        """The same with a heap of pairs, for words that are too long to be searched each time."""
        n, get = len(parts), self.rank.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j] = left + right, b""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (r := get((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
        return [p for p in parts if p]


class Splitter:
    """Cuts of a text, from the byte pairs of the vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        joined = np.zeros((256, 256), bool)
        for token in vocabulary.id_of:
            codes = np.frombuffer(token, np.uint8)
            joined[codes[:-1], codes[1:]] = True
        cut = ~joined
        # Contractions are single pre-tokens even if no token spells them whole.
        for tail in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"):
            codes = np.frombuffer(tail.encode(), np.uint8)
            cut[codes[:-1], codes[1:]] = False
        cut[:, 0x80:0xC0] = False  # inside a character
        cut[list(b" \t\n\r\v\f\x1c\x1d\x1e\x1f"), :] = False  # white space before the cut
        cut[0x80:, :] = cut[0x80:, :] & (np.arange(256) != ord("'"))  # it may be punctuation
        cut[ord("'"), :] = False
        letters = [*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]
        others = np.setdiff1d(np.arange(128), letters)
        cut[others, ord("'")] = False
        # A character of several bytes can be white space too: only cut behind it where
        # the next byte is an ASCII space, which begins a new pre-token unless white
        # space precedes; so behind such characters no cut is certain.
        cut[0x80:, :] = False
        self.cut = cut.reshape(-1)
        # Behind a letter of two or more bytes the table above says nothing; a
        # second table allows cuts there for the letters that are known to be letters.
        self.after_wide = (~joined).copy()
        self.after_wide[:, 0x80:0xC0] = False
        self.after_wide[:, ord("'")] = False
        self.after_wide = self.after_wide.reshape(-1)

    def places(self, data: np.ndarray) -> np.ndarray:
        """Positions at which a fragment may begin."""
        if len(data) < 2:
            return np.zeros(0, np.int64)
        pair = data[:-1].astype(np.uint16) * 256 + data[1:]
        at = self.cut[pair]
        # Two-byte letters U+00C0 to U+024F but for the two signs among them: C3 and C4..C8.
        if len(data) > 2:
            lead, trail = data[:-2], data[1:-1]
            letter = (lead == 0xC3) & (trail >= 0x80) & (trail != 0x97) & (trail != 0xB7)
            letter |= (lead >= 0xC4) & (lead <= 0xC8) & (trail >= 0x80)
            at[1:] |= letter & self.after_wide[pair[1:]]
        return np.flatnonzero(at) + 1


class Encoder:
    """Ids and decoded bytes of texts; remembers fragments up to a bound."""

    def __init__(self, file: dict) -> None:
        self.vocabulary = Vocabulary(file)
        self.splitter = Splitter(self.vocabulary)
        self.pattern = regex.compile(PRETOKEN)
        names = sorted((t.encode() for t in self.vocabulary.special), key=len, reverse=True)
        self.special = re.compile(b"(" + b"|".join(map(re.escape, names)) + b")") if names else None
        self.known: dict[bytes, tuple[str, int, bytes]] = {}

    def ids(self, fragment: bytes) -> list[int]:
        if self.special and self.special.fullmatch(fragment):
            return [self.vocabulary.special[fragment.decode()]]
        words = self.pattern.findall(fragment.decode())
        return [i for w in words for i in self.vocabulary.merged(w.encode())]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids; what is no UTF-8 becomes U+FFFD when it is made text."""
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def fragment(self, piece: bytes) -> tuple[str, int, bytes]:
        """(ids as decimal text, their number, the bytes they decode to)."""
        ids = self.ids(piece)
        entry = ",".join(map(str, ids)), len(ids), self.decode(ids)
        if len(piece) <= MAX_REMEMBERED_BYTES:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = entry
        return entry

    def fragments(self, data: np.ndarray) -> list[bytes]:
        text = data.tobytes()
        if self.special and self.special.search(text):
            parts = [p for p in self.special.split(text) if p]
            return [f for p in parts for f in ([p] if self.special.fullmatch(p) else self._cut(p))]
        return self._cut(text) if text else []

    def _cut(self, text: bytes) -> list[bytes]:
        at = [0, *self.splitter.places(np.frombuffer(text, np.uint8)).tolist(), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    def encode(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode(), np.uint8)
        return [i for f in self.fragments(data) for i in self.ids(f)]

    def digest(self, data: np.ndarray) -> tuple[int, str, str]:
        """(number of ids, digest of the ids, digest of the decoded text)."""
        known, fragment = self.known, self.fragment
        found = [known.get(f) or fragment(f) for f in self.fragments(data)]
        ids = ",".join([e[0] for e in found])
        back = b"".join([e[2] for e in found]).decode("utf-8", "replace").encode()
        return sum(e[1] for e in found), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back).hexdigest()


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    """One per worker and vocabulary, from the text of the vocabulary's file."""
    key = hashlib.md5(file.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(json.loads(file))
    return _ENCODERS[key]


def _shipped(docs: DataFrame, path: str) -> Broadcast[str]:
    """The vocabulary's file for all workers, which need not have it on their disks."""
    with open(path, encoding="utf-8") as f:
        file = f.read(MAX_VOCABULARY_CHARS + 1)
    if len(file) > MAX_VOCABULARY_CHARS:
        raise ValueError(f"{path} is no vocabulary: longer than {MAX_VOCABULARY_CHARS} characters")
    return docs.sparkSession.sparkContext.broadcast(file)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; nothing is moved."""
    vocabulary = _shipped(docs, path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary.value)
        for batch in batches:
            rows = []
            for _, _, data, at in pieces(batch.column("text")):
                rows += [own.digest(data[a:b]) for a, b in zip(at[:-1], at[1:])]
            counts, ids, back = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(_texts(docs), task, schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` of every row."""
    vocabulary = _shipped(docs, path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary.value)
        for batch in batches:
            ids = [own.encode(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return arrow_map(_texts(docs), task, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the ``text`` of its ``ids``."""
    vocabulary = _shipped(encoded, path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary.value)
        for batch in batches:
            texts = [own.decode(i.as_py() or []).decode("utf-8", "replace") for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return arrow_map(encoded.select("doc_id", "ids"), task, "doc_id long, text string")
