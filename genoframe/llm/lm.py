"""Log-probabilities of texts under an n-gram model: a weighted automaton with failure arcs, walked once from left to right.

A history that the training texts hold is a state. Its arcs are the n-grams that go on from it, with smoothed probabilities;
any other word takes the failure arc to the history without its first word, which weighs what the smoothing leaves for it.
The arc is P(w|h) = (c(hw) + s P(w|h')) / (c(h) + s), h' being h without its first word and s the pseudo-count of that order;
the failure arc is s / (c(h) + s). Below all stand single words, (c + 0.1) / (N + 0.1 (V + 1)).

A model of a large corpus fits in no task, so none holds it. Texts are cut into blocks; a block's automaton has just the n-grams
that the block holds, as no other arc can be taken there. Their counts in all training texts come from one exchange: each block sends
its distinct n-grams with counts, dealt into ranges of their hashes, a task for each range adds them up, and each block gets the totals of what it
has sent. No n-gram is sent more than once by a block, so frequent ones are no hot keys.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.llm.shared import partitions
from genoframe.scratch import written

#: Pseudo-counts of the next shorter history for bigrams, trigrams and so on; the last one holds for longer ones too.
STRENGTHS = (300.0, 5.0)
#: What is added to the count of a word, and of one unknown word.
ADDED = 0.1
#: Tokens from which a block is full. A text is never cut, so a block may exceed that by one text.
BLOCK_TOKENS = 1 << 19
#: N-grams, about, that a task adds up; the number of ranges follows from all tokens.
RANGE_GRAMS = 1 << 22
#: Bits of an n-gram's hash beyond those that number all n-grams: two share a hash with a chance of 2^-24 for each n-gram.
SPARE_BITS = 24
#: Tokens of a part of a text; all parts of a block are walked side by side.
PART_TOKENS = 256

BLOCK_SCHEMA = "block long, ids array<{kind}>, train array<boolean>, sizes array<int>, tokens binary, words binary, many long, known long"
GRAM_SCHEMA = "size int, range int, block long, keys binary, counts binary"
TOTAL_SCHEMA = "block long, size int, range int, totals binary, words_seen long"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, how many each has): ASCII letters lower-cased, split at ASCII white space; both leave other bytes of UTF-8 alone."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0)
    text = np.repeat(np.arange(len(sizes)), sizes)[full.to_numpy(zero_copy_only=False)]
    return words.filter(full), np.bincount(text, minlength=len(sizes))


def _one(values: pa.Array | np.ndarray) -> pa.Array:
    """One row whose value is the list of all values."""
    values = pa.array(values) if isinstance(values, np.ndarray) else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(x: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second bytes and so on, compressed."""
    data = x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _numbers(x: bytes) -> np.ndarray:
    n = int.from_bytes(x[:8], "little")
    data = pa.decompress(x[8:], 8 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def _joined(words: pa.Array) -> bytes:
    """Words hold no white space."""
    data = b"\n".join(words.cast(pa.binary()).to_pylist())
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _parted(x: bytes) -> list[bytes]:
    n = int.from_bytes(x[:8], "little")
    return pa.decompress(x[8:], n, "zstd", asbytes=True).split(b"\n") if n else []


def _block_row(number: int, held: list[tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]]) -> pa.RecordBatch:
    """A row of BLOCK_SCHEMA for held (ids, train, words, how many each has)."""
    ids, words = (pa.concat_arrays([h[k] for h in held]) for k in (0, 2))
    train, sizes = (np.concatenate([h[k] for h in held]) for k in (1, 3))
    coded = words.dictionary_encode()
    columns = [
        pa.array([number], pa.int64()), _one(ids), _one(train), _one(sizes.astype(np.int32)), pa.array([_packed(coded.indices.to_numpy())], pa.binary()),
        pa.array([_joined(coded.dictionary)], pa.binary()), pa.array([int(sizes.sum())], pa.int64()), pa.array([int(sizes[train].sum())], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "train", "sizes", "tokens", "words", "many", "known"])


def blocks(docs: DataFrame, train: Column, id_col: str, text_col: str) -> DataFrame:
    """Texts as numbers of their block's words, a row for each block, written to the shared folder."""

    def run(batches):
        first, held, many, n = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in batches:
            words, sizes = words_of(batch.column(1))
            learn, ends, at = batch.column(2).to_numpy(zero_copy_only=False).astype(bool), np.concatenate([[0], np.cumsum(sizes)]), 0
            # A text counts as one more for its end.
            full = ends + np.arange(len(ends))
            while at < len(sizes):
                to = min(len(sizes), max(at + 1, int(np.searchsorted(full, full[at] + BLOCK_TOKENS - many))))
                held.append((batch.column(0).slice(at, to - at), learn[at:to], words.slice(ends[at], ends[to] - ends[at]), sizes[at:to]))
                many, at = many + int(full[to] - full[at]), to
                if many >= BLOCK_TOKENS:
                    yield _block_row(first + n, held)
                    held, many, n = [], 0, n + 1
        if held:
            yield _block_row(first + n, held)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), train.alias("train"))
    return written(rows.mapInArrow(run, BLOCK_SCHEMA.format(kind=dict(docs.dtypes)[id_col])))


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes, for each code the number of it among them). Codes and their places are sorted as one number where both fit."""
    bits = max(1, int(len(codes) - 1).bit_length())
    if not len(codes) or int(codes.max()).bit_length() + bits > 62:
        return np.unique(codes, return_inverse=True)
    both = np.sort((codes << bits) | np.arange(len(codes)))
    place, both = both & ((1 << bits) - 1), both >> bits
    new = np.append(True, both[1:] != both[:-1])
    number = np.empty(len(codes), np.int32)
    number[place] = np.cumsum(new, dtype=np.int32) - 1
    return both[new], number


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Level:
    """The distinct n-grams of one size: number of the first words' gram, last word, number of the last words' gram, hash, count
    in the block's training texts. of: for each position the number of the gram that ends there, -1 where there is none."""

    prefix: np.ndarray
    last: np.ndarray
    suffix: np.ndarray
    key: np.ndarray
    count: np.ndarray
    of: np.ndarray


class Grams:
    """The n-grams of a block, by size; texts begin with a token of their own, W, and end with another, W + 1."""

    def __init__(self, words: list[bytes], sizes: np.ndarray, tokens: np.ndarray, train: np.ndarray, order: int):
        self.begin, self.end, self.kinds = len(words), len(words) + 1, len(words) + 2
        self.lengths = sizes + 2
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.text = np.repeat(np.arange(len(sizes), dtype=np.int32), self.lengths)
        self.depth = (np.arange(len(self.text)) - np.repeat(self.starts, self.lengths)).astype(np.int32)
        self.sequence = np.full(len(self.text), self.end, np.int32)
        inside = np.ones(len(self.text), bool)
        inside[self.starts] = inside[self.starts + self.lengths - 1] = False
        self.sequence[inside] = tokens
        self.sequence[self.starts] = self.begin
        learn = train[self.text]
        hashes = np.array([*(xxhash.xxh64_intdigest(w, 1) for w in words), xxhash.xxh64_intdigest(b"", 2), xxhash.xxh64_intdigest(b"", 3)], np.uint64)
        none = np.zeros(0, np.int64)
        count = np.bincount(self.sequence[learn], minlength=self.kinds)
        self.levels = [Level(none, np.arange(self.kinds), none, hashes, count, self.sequence)]
        for size in range(2, order + 1):
            below = self.levels[-1]
            at = np.flatnonzero(self.depth >= size - 1)
            codes, number = _distinct(below.of[at - 1] * np.int64(self.kinds) + self.sequence[at])
            prefix, last = codes // self.kinds, codes % self.kinds
            suffix = np.empty(len(codes), np.int32)
            suffix[number] = below.of[at]
            of = np.full(len(self.text), -1, np.int32)
            of[at] = number
            count = np.bincount(number[learn[at]], minlength=len(codes))
            self.levels.append(Level(prefix, last, suffix, _mixed(below.key[prefix], hashes[last]), count, of))


def _block(row: dict, order: int) -> Grams:
    return Grams(_parted(row["words"]), np.array(row["sizes"], np.int64), _numbers(row["tokens"]), np.array(row["train"], bool), order)


def _borders(bits: int, ranges: int) -> np.ndarray:
    """Keys at which the ranges but the first begin."""
    return np.array([-(-(r << bits) // ranges) for r in range(1, ranges)], np.uint64)


def _dealt(key: np.ndarray, bits: int, borders: np.ndarray, stable: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the keys, keys of so many bits in that order, where the ranges begin and end in it)."""
    short = key >> np.uint64(64 - bits)
    # Grams of one hash get the same total, so their order is of no matter; words of one hash do not, and are sorted stably.
    order = np.argsort(short, kind="stable" if stable else None)
    short = short[order]
    return order, short, np.concatenate([[0], np.searchsorted(short, borders), [len(short)]])


def _sent(order: int, bits: int, ranges: int):
    """Rows of GRAM_SCHEMA of each block; of single words the words themselves, so that their counts are exact."""
    borders = _borders(bits, ranges)

    def run(batches):
        for row in (b.slice(i, 1).to_pylist()[0] for b in batches for i in range(b.num_rows)):
            grams = _block(row, order)
            words = pa.array(_parted(row["words"]), pa.binary())
            for size, level in enumerate(grams.levels, 1):
                key = level.key[: len(words)] if size == 1 else level.key
                by, short, at = _dealt(key, bits, borders, size == 1)
                for r in np.flatnonzero(np.diff(at)).tolist():
                    mine = slice(at[r], at[r + 1])
                    keys = _joined(words.take(pa.array(by[mine]))) if size == 1 else _packed(np.diff(short[mine], prepend=np.uint64(0)))
                    values = (size, r, row["block"], keys, _packed(level.count[by[mine]]))
                    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=["size", "range", "block", "keys", "counts"])

    return run


def _added(sent: pa.Table) -> pa.Table:
    """Totals of the grams of one size and range, for each block in the order in which it has sent them."""
    size, own = sent["size"][0].as_py(), sent["range"][0].as_py()
    counts = [_numbers(c) for c in sent["counts"].to_pylist()]
    if size == 1:
        number = pa.array([w for k in sent["keys"].to_pylist() for w in _parted(k)], pa.binary()).dictionary_encode().indices.to_numpy()
    else:
        keys = np.concatenate([np.cumsum(_numbers(k), dtype=np.uint64) for k in sent["keys"].to_pylist()])
        order = np.argsort(keys)
        number = np.empty(len(keys), np.int64)
        number[order] = np.cumsum(np.append(False, keys[order][1:] != keys[order][:-1]))
    # Sums of longs below 2^53 are exact as doubles.
    totals = np.bincount(number, weights=np.concatenate(counts)).astype(np.uint64)
    ends = np.cumsum([len(c) for c in counts])
    back = [_packed(part) for part in np.split(totals[number], ends[:-1])]
    seen = [int((totals > 0).sum()) if size == 1 and i == 0 else 0 for i in range(len(back))]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
    columns = (sent["block"].to_pylist(), [size] * len(back), [own] * len(back), back, seen)
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "size", "range", "totals", "words_seen"])


class Automaton:
    """States are histories, 0 the empty one. Arcs in ascending order of state x kinds + word; the empty history has one for every word."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, kinds_seen: int, strengths: tuple[float, ...]):
        """counts: of each level's grams in all training texts; that of the beginning is the number of those texts."""
        strength = lambda size: strengths[min(size - 2, len(strengths) - 1)]
        order = len(grams.levels)
        self.kinds = grams.kinds
        chance = (counts[0] + ADDED) / (tokens + ADDED * (kinds_seen + 1))
        states, many = [], 1
        for size in range(1, order):
            seen = counts[size - 1] > 0
            state = np.zeros(len(seen), np.int64)
            state[seen] = many + np.arange(int(seen.sum()))
            many += int(seen.sum())
            states.append(state)
        self.root = np.log10(chance)
        self.root_to = states[0] if order > 1 else np.zeros(grams.kinds, np.int64)
        self.fail, self.fail_weight = np.zeros(many, np.int64), np.zeros(many)
        keys, weights, targets = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        for size in range(1, order):
            own, state = counts[size - 1] > 0, states[size - 1]
            self.fail_weight[state[own]] = np.log10(strength(size + 1) / (counts[size - 1][own] + strength(size + 1)))
            if size > 1:
                self.fail[state[own]] = states[size - 2][grams.levels[size - 1].suffix[own]]
        for size in range(2, order + 1):
            level, s = grams.levels[size - 1], strength(size)
            chance = (counts[size - 1] + s * chance[level.suffix]) / (counts[size - 2][level.prefix] + s)
            own = counts[size - 1] > 0
            keys.append(states[size - 2][level.prefix[own]] * self.kinds + level.last[own])
            weights.append(np.log10(chance[own]))
            targets.append(states[size - 1][own] if size < order else states[size - 2][level.suffix[own]])
        keys = np.concatenate(keys)
        by = np.argsort(keys)
        self.keys, self.weights, self.targets = np.append(keys[by], np.iinfo(np.int64).max), np.concatenate(weights)[by], np.concatenate(targets)[by]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, weights of the arcs taken, failure arcs included), one for each state and word."""
        state, weight = state.copy(), np.zeros(len(state))
        open_ = np.flatnonzero(state)
        at_root = state == 0
        while len(open_):
            wanted = state[open_] * self.kinds + word[open_]
            arc = np.searchsorted(self.keys, wanted)
            hit = self.keys[arc] == wanted
            going, arc = open_[hit], arc[hit]
            weight[going] += self.weights[arc]
            state[going] = self.targets[arc]
            open_ = open_[~hit]
            weight[open_] += self.fail_weight[state[open_]]
            state[open_] = self.fail[state[open_]]
            down = state[open_] == 0
            at_root[open_[down]] = True
            open_ = open_[~down]
        weight[at_root] += self.root[word[at_root]]
        state[at_root] = self.root_to[word[at_root]]
        return state, weight

    def scores(self, grams: Grams) -> np.ndarray:
        """Sum of the weights for each text. Long texts are walked in parts; a part first reads as many words before it as a state can tell apart."""
        before = len(grams.levels) - 1
        parts = -(-(grams.lengths - 1) // PART_TOKENS)
        text = np.repeat(np.arange(len(parts)), parts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = grams.starts[text] + 1 + nth * PART_TOKENS
        end = np.minimum(first + PART_TOKENS, grams.starts[text] + grams.lengths[text])
        at = np.maximum(first - before, grams.starts[text])
        by = np.argsort(-(end - at), kind="stable")
        text, first, end, at = text[by], first[by], end[by], at[by]
        state, total = np.zeros(len(text), np.int64), np.zeros(len(text))
        active = len(text)
        while active:
            state[:active], weight = self.step(state[:active], grams.sequence[at[:active]])
            total[:active] += np.where(at[:active] >= first[:active], weight, 0.0)
            at[:active] += 1
            active = int((at[:active] < end[:active]).sum())
        return np.bincount(text, weights=total, minlength=len(parts))


def _scored(order: int, bits: int, ranges: int, tokens: int, kinds_seen: int, texts: int, strengths: tuple[float, ...]):
    borders = _borders(bits, ranges)

    def run(own: pa.Table, totals: pa.Table) -> pa.Table:
        row = own.drop_columns(["ids"]).to_pylist()[0]
        grams = _block(row, order)
        back = {(s, r): _numbers(t) for s, r, t in zip(*(totals[c].to_pylist() for c in ("size", "range", "totals")))}
        counts = []
        for size, level in enumerate(grams.levels, 1):
            count = np.full(len(level.key), texts, np.int64)
            key = level.key[: grams.begin] if size == 1 else level.key
            by, _, at = _dealt(key, bits, borders, size == 1)
            if len(by):
                count[by] = np.concatenate([back[size, r] for r in np.flatnonzero(np.diff(at)).tolist()]).astype(np.int64)
            counts.append(count)
        automaton = Automaton(grams, counts, tokens, kinds_seen, strengths)
        read = grams.depth > 0
        text, word = grams.text[read], grams.sequence[read]
        by_text = lambda values: np.bincount(text, weights=values, minlength=len(grams.lengths))
        columns = [
            own["ids"].combine_chunks().flatten(), pa.array([not t for t in row["train"]]), pa.array(grams.lengths - 1), pa.array(by_text(counts[0][word] > 0).astype(np.int64)),
            pa.array(np.full(len(grams.lengths), tokens)), pa.array(by_text(automaton.root[word])), pa.array(automaton.scores(grams)),
        ]
        return pa.table(columns, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def scored(docs: DataFrame, train: Column | None = None, order: int = 3, strengths: tuple[float, ...] = STRENGTHS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row; scores are log10 probabilities.

    train: which rows the model learns from, by default those whose crc32(doc_id as text) mod 10 is not 0; a null id, and a condition that is null,
    are held out. Null and empty texts are the end alone. Repeated rows are rows of their own, and count as often. Without training rows
    every word has the chance of the unknown word. An empty table returns no rows; other columns are not looked at.
    A text is held whole by one task, at about 150 bytes for each token of its block.
    """
    if order < 1 or not all(s > 0 for s in strengths):
        raise ValueError("order must be 1 at least, strengths over 0")
    train = F.crc32(F.col(id_col).cast("string")) % 10 != 0 if train is None else train
    own = blocks(docs, F.coalesce(train, F.lit(False)), id_col, text_col)
    known, texts, all_tokens = own.agg(F.sum("known"), F.sum(F.size(F.filter("train", lambda t: t))), F.sum(F.col("many") + F.size("ids"))).first()
    known, texts, grams = known or 0, texts or 0, int(all_tokens or 0) * order
    bits = min(64, SPARE_BITS + max(1, math.ceil(math.log2(grams + 1))))
    ranges = max(partitions(docs.sparkSession), math.ceil(grams / order / RANGE_GRAMS))
    sent = own.mapInArrow(_sent(order, bits, ranges), GRAM_SCHEMA)
    totals = written(sent.groupBy("size", "range").applyInArrow(_added, TOTAL_SCHEMA))
    seen = (totals.agg(F.sum("words_seen")).first()[0] or 0) + (texts > 0)
    kind = dict(docs.dtypes)[id_col]
    run = _scored(order, bits, ranges, known + texts, seen, texts, strengths)
    out = own.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(run, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
