"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

The root of a pre-token's tree holds its lowest-rank pair, the leftmost of equal ones. Merging it changes
three leaves, each carried to the root in logarithmic time, until no pair can be merged. Pre-tokens of up
to WIDEST bytes are merged many at a time, one tree for each row of an array; longer ones one by one.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from genoframe.llm.shared import PART_ROWS

#: How byte-level BPE splits a text before merging (fixed value).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Bytes of the longest pre-token that is merged together with others.
WIDEST = 128
#: Characters of text, and distinct pre-tokens, held at a time by a task.
HELD_CHARS, HELD_TOKENS = 1 << 21, 1 << 17

_SAFE = regex.compile(r"(?<=\S) (?=\S)")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: itself where printable, else the next code point from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens and merges of a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        as_byte = _byte_alphabet()
        ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.token_bytes[i] = bytes(as_byte[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for char, byte in as_byte.items():
            self.of_byte[byte] = ids[char]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        self.base = len(self.token_bytes)
        #: Above every rank.
        self.never = len(spec["model"]["merges"])
        keys = np.array([a * self.base + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array([r for r, _ in self.merges.values()], np.int64)[order], self.never)
        self.merged = np.append(np.array([m for _, m in self.merges.values()], np.int64)[order], -1)
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (never, if there is none) and merged token of each pair; a negative token is in no pair."""
        key = left * self.base + right
        at = np.searchsorted(self.keys, key)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], self.never), self.merged[at]

    # -- one pre-token ------------------------------------------------------------------------------------

    def encode_long(self, data: bytes) -> list[int]:
        """Tokens of one pre-token of any length, in about 70 bytes of memory for each of its own."""
        ids = self.of_byte[np.frombuffer(data, np.uint8)]
        n, merges = len(ids), self.merges
        size = 1 << max(1, (n - 1).bit_length())
        # A node is rank * size + place, so that the least is the leftmost of the lowest rank.
        never = self.never * size
        first = np.full(2 * size, never, np.int64)
        for i in range(0, n - 1, 1 << 16):
            ranks, _ = self.rank(ids[i : min(i + (1 << 16), n - 1)], ids[i + 1 : i + 1 + (1 << 16)])
            first[size + i : size + i + len(ranks)] = np.where(ranks < self.never, ranks * size + np.arange(i, i + len(ranks)), never)
        k = size
        while k := k >> 1:
            first[k : 2 * k] = np.minimum(first[2 * k : 4 * k : 2], first[2 * k + 1 : 4 * k : 2])
        as_array = lambda x: array("q", x.astype(np.int64).tobytes())
        tree, ids = as_array(first), as_array(ids)
        nxt, prv = as_array(np.arange(1, n + 1)), as_array(np.arange(-1, n - 1))
        del first

        def put(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    return
                tree[k] = value

        def leaf(i: int) -> None:
            pair = merges.get((ids[i], ids[nxt[i]])) if nxt[i] < n else None
            put(i, pair[0] * size + i if pair else never)

        while tree[1] < never:
            i = tree[1] % size
            j = nxt[i]
            ids[i], ids[j], nxt[i] = merges[ids[i], ids[j]][1], -1, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            put(j, never)
            leaf(i)
            if prv[i] >= 0:
                leaf(prv[i])
        return [i for i in ids if i >= 0]

    # -- many pre-tokens ----------------------------------------------------------------------------------

    def _encode_rows(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens (else -1) of pre-tokens of up to `width` bytes, a row each; width is a power of two."""
        count, width = rows.shape
        ids = np.where(np.arange(width) < lengths[:, None], self.of_byte[rows], -1)
        nxt = np.tile(np.arange(1, width + 1), (count, 1))
        prv = np.tile(np.arange(-1, width - 1), (count, 1))
        # A node is rank * width + place, so that the least is the leftmost of the lowest rank.
        never = self.never * width
        tree = np.full((count, 2 * width), never, np.int64)
        ranks, _ = self.rank(ids[:, :-1], ids[:, 1:])
        tree[:, width : 2 * width - 1] = np.where(ranks < self.never, ranks * width + np.arange(width - 1), never)
        k = width
        while k := k >> 1:
            tree[:, k : 2 * k] = np.minimum(tree[:, 2 * k : 4 * k : 2], tree[:, 2 * k + 1 : 4 * k : 2])

        def put(r: np.ndarray, place: np.ndarray, value: np.ndarray | int) -> None:
            k = place + width
            tree[r, k] = value
            for _ in range(width.bit_length() - 1):
                k = k >> 1
                tree[r, k] = np.minimum(tree[r, 2 * k], tree[r, 2 * k + 1])

        def leaf(r: np.ndarray, i: np.ndarray) -> None:
            after = nxt[r, i]
            rank, _ = self.rank(ids[r, i], np.where(after < width, ids[r, np.minimum(after, width - 1)], -1))
            put(r, i, np.where(rank < self.never, rank * width + i, never))

        live = np.flatnonzero(tree[:, 1] < never)
        while len(live):
            i = tree[live, 1] % width
            j = nxt[live, i]
            ids[live, i] = self.rank(ids[live, i], ids[live, j])[1]
            ids[live, j] = -1
            after = nxt[live, j]
            nxt[live, i] = after
            inside = after < width
            prv[live[inside], after[inside]] = i[inside]
            put(live, j, never)
            leaf(live, i)
            before = prv[live, i]
            has = before >= 0
            leaf(live[has], before[has])
            live = live[tree[live, 1] < never]
        return ids

    def encode_many(self, tokens: list[bytes]) -> list[list[int]]:
        """Tokens of each pre-token."""
        out: list = [None] * len(tokens)
        lengths = np.array([len(t) for t in tokens], np.int64)
        for i in np.flatnonzero(lengths > WIDEST):
            out[i] = self.encode_long(tokens[i])
        low, width = 0, 4
        while width <= WIDEST:
            mine = np.flatnonzero((lengths > low) & (lengths <= width))
            for start in range(0, len(mine), (1 << 18) // width):
                part = mine[start : start + (1 << 18) // width]
                rows = np.frombuffer(b"".join(tokens[i].ljust(width, b"\0") for i in part), np.uint8).reshape(-1, width)
                found = self._encode_rows(rows, lengths[part])
                kept = found >= 0
                flat, ends = found[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
                for i, a, b in zip(part.tolist(), [0, *ends], ends):
                    out[i] = flat[a:b]
            low, width = width, width * 2
        return [[] if o is None else o for o in out]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def segments(text: str, size: int = 1 << 20):
    """Parts of a long text, cut only at a single space between other characters: there a pre-token always begins."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Encoder:
    """Encodes texts; what it knows of pre-tokens is kept up to HELD_TOKENS and then begun anew."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        #: Of each pre-token its ids as 32-bit integers, and what they decode to.
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def pieces(self, text: str):
        """Lists of the pre-tokens of a text, part by part; a special token is a list of its own."""
        for part in self.vocab.split.split(text) if self.vocab.split else [text]:
            if part in self.vocab.special:
                yield [part]
            elif part:
                for segment in segments(part):
                    yield PATTERN.findall(segment)

    def learn(self, lists: list[list[str]]) -> None:
        """Encode and decode all pre-tokens that are not known yet."""
        if len(self.known) > HELD_TOKENS:
            self.known = {}
        new = list(set().union(*lists).difference(self.known))
        ids = self.vocab.encode_many([p.encode() for p in new])
        for piece, own in zip(new, ids):
            if piece in self.vocab.special:
                own = [self.vocab.special[piece]]
            self.known[piece] = np.array(own, np.int32).tobytes(), b"".join(map(self.vocab.token_bytes.__getitem__, own))

    def coded(self, texts: Iterable[str]):
        """Lists of (ids as 32-bit integers, decoded text) of the texts in turn; a list holds about HELD_CHARS of them at most."""
        held, chars = [], 0
        for text in texts:
            held.append([p for p in self.pieces(text) if p])
            chars += len(text)
            if chars > HELD_CHARS:
                yield self._held(held)
                held, chars = [], 0
        yield self._held(held)

    def _held(self, held: list[list[list[str]]]) -> list[tuple[bytes, str]]:
        self.learn([p for lists in held for p in lists])
        found = []
        for lists in held:
            both = [self.known[p] for pieces in lists for p in pieces]
            found.append((b"".join([b[0] for b in both]), b"".join([b[1] for b in both]).decode("utf-8", "replace")))
        return found

    def encode(self, text: str) -> list[int]:
        return [i for found in self.coded([text]) for ids, _ in found for i in np.frombuffer(ids, np.int32).tolist()]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.vocab.token_bytes[i] for i in ids).decode("utf-8", "replace")


def coded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """id, the columns to keep, ids (array of int) and decoded of every row: its whole text encoded, and the tokens decoded again.

    A null text is empty: no tokens. Rows, repeated ones too, stay as many as they are; an empty table returns
    none; other columns are not looked at. path: a tokenizers JSON file that all executors can open.
    """

    def run(batches):
        encoder = Encoder(vocabulary(path))
        for batch in batches:
            texts = ((t or b"").decode("utf-8", "replace") for k in range(0, batch.num_rows, PART_ROWS) for t in batch.column(1).slice(k, PART_ROWS).to_pylist())
            at = 0
            for found in encoder.coded(texts):
                ends = np.cumsum([0, *(len(ids) // 4 for ids, _ in found)]).astype(np.int32)
                flat = np.frombuffer(b"".join(ids for ids, _ in found), np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(found)), lists, pa.array([t for _, t in found], pa.string())], names=["row", "ids", "decoded"])
                at += len(found)
            del batch
        pa.default_memory_pool().release_unused()

    names = [id_col, *keep]
    rows = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.col(text_col).cast("binary").alias("text"))
    schema = StructType([rows.schema["row"], StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
    return rows.mapInArrow(run, schema).select(*[F.col("row")[c].alias(c) for c in names], "ids", "decoded")


def with_digests(found: DataFrame) -> DataFrame:
    """coded() with n_tokens, ids_sha256 (of the ids joined by commas) and decoded_sha256 in place of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(*[c for c in found.columns if c not in ("ids", "decoded")], F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of what coded() returns."""
    return with_digests(coded(docs, path, id_col, text_col)).drop("ids")
