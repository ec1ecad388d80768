"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Words are invented in part, so n-grams are taken of words and of their shapes. Each indicator is scaled by the
log ratio of its smoothed counts in the two classes; a linear hinge-loss model is fitted by dual coordinate
descent, and its margins are turned into probabilities by a logistic curve fitted on rows kept aside.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from genoframe.llm.shared import parts

#: Indicators are hashed to so many features.
FEATURES = 1 << 18
#: Most labelled rows, about, that a model is fitted on, and most features of them all.
FIT_ROWS, FIT_FEATURES = 16_000, 1 << 25
#: Shares of a text's words (1/2, 1/4, ...) from which a shape counts as frequent in it.
SHARES = 7

_SPACE = re.compile(r"\s")
_RUN = re.compile(r"(.)\1+")
#: Characters beyond which the shape of a word is worked out as an array.
LONG_WORD = 1 << 12


class _Shapes(dict):
    """Upper-case letters to A, other letters to a, digits to 9; anything else stays."""

    def __missing__(self, code: int) -> int:
        char = chr(code)
        self[code] = ord("A" if char.isupper() else "a" if char.isalpha() else "9" if char.isdigit() else char)
        return self[code]


_SHAPES = _Shapes()


def shape(word: str) -> str:
    """The word's kinds of characters, each run of one kind once."""
    if len(word) <= LONG_WORD:
        return _RUN.sub(r"\1", word.translate(_SHAPES))
    codes = np.frombuffer(word.translate(_SHAPES).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes[np.append(True, codes[1:] != codes[:-1])].tobytes().decode("utf-32-le", "surrogatepass")


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(*parts: np.ndarray) -> np.ndarray:
    out = parts[0]
    for p in parts[1:]:
        out = (out * _MIX) ^ (p + _MIX + (out >> np.uint64(29)))
    return out


class Indicators:
    """Features of texts: word n-grams of one and two, shape n-grams of one to three, and frequent shapes."""

    def __init__(self, most_known: int = 1 << 17):
        self.most_known = most_known
        self._forget(most_known)

    def _forget(self, room: int) -> None:
        self.known: dict[str, int] = {}
        self.hashes, self.shapes = np.zeros(room, np.uint64), np.zeros(room, np.uint64)

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the hash and the shape of each word are kept; what is kept is begun anew when there is no room."""
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > len(self.hashes):
            new = set(words)
            self._forget(max(self.most_known, len(new)))
        known = self.known
        for w in new:
            known[w] = at = len(known)
            self.hashes[at] = xxhash.xxh64_intdigest(w)
            self.shapes[at] = xxhash.xxh64_intdigest(shape(w))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def of(self, text: str | None, part: int = 1 << 20) -> np.ndarray:
        """Sorted features of a text, whatever `part` is: long texts are taken part by part, cut between words. Every text has the feature 0."""
        text, at = text or "", 0
        found, counts, total = [np.zeros(1, np.uint64)], {}, 0
        # The words before a part: its n-grams begin with them.
        w, s = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        while at < len(text):
            end = min(at + part, len(text))
            if found_space := _SPACE.search(text, end):
                end = found_space.start()
            else:
                end = len(text)
            places = self._places(text[at:end].split())
            at, held = end, len(w)
            w, own = np.concatenate([w, self.hashes[places]]), self.shapes[places]
            again = np.zeros(len(w), bool)
            again[1:] = w[1:] == w[:-1]
            own = np.where(again[held:], np.uint64(1), own)  # a repeated word has a shape of its own
            s = np.concatenate([s, own])
            kinds = [np.uint64(k) for k in range(5)]
            found.append(np.unique(np.concatenate([_mixed(w, kinds[0]), _mixed(w[:-1], w[1:], kinds[1]), _mixed(s, kinds[2]), _mixed(s[:-1], s[1:], kinds[3]), _mixed(s[:-2], s[1:-1], s[2:], kinds[4])])))
            w, s = w[-2:], s[-2:]
            total += len(own)
            for value, n in zip(*np.unique(own, return_counts=True)):
                counts[value] = counts.get(value, 0) + int(n)
        values = np.array(list(counts), np.uint64)
        share = np.array(list(counts.values()), float) / max(total, 1)
        for k in range(1, SHARES + 1):
            found.append(_mixed(values[share >= 2.0**-k], np.uint64(16 + k)))
        every = np.concatenate(found)
        return np.unique((_mixed(every, np.uint64(7)) >> np.uint64(40)) % np.uint64(FEATURES)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, features: np.ndarray) -> float:
        return float(self.weights[features].sum())

    def score(self, features: np.ndarray) -> float:
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.slope * self.margin(features) + self.shift, -30, 30))))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of each feature's share of its class's counts, positive over negative."""
    counts = [np.full(FEATURES, smooth) for _ in range(2)]
    for x, y in zip(rows, labels):
        counts[int(y)][x] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float, rounds: int, seed: int = 7) -> np.ndarray:
    """Weights of hinge loss with an L2 penalty over rows of scaled indicators; each class's losses weigh half."""
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.maximum(np.array([(sign < 0).mean(), (sign > 0).mean()]), 1e-9)
    most = np.where(sign > 0, cost / (2 * share[1]), cost / (2 * share[0]))
    alpha, w, order = np.zeros(len(rows)), np.zeros(FEATURES), np.random.default_rng(seed)
    norms = [float(scale[x] @ scale[x]) or 1.0 for x in rows]
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            values = scale[rows[i]]
            gradient = sign[i] * float(w[rows[i]] @ values) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), most[i])
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * sign[i] * values
                moved = max(moved, abs(new - alpha[i]) * norms[i] ** 0.5)
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 0.1, rounds: int = 20, smooth: float = 1.0, aside: int = 5) -> Model:
    """Every `aside`-th row is kept for the logistic curve. With one class alone the score is the share of positives."""
    labels = np.asarray(labels)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(FEATURES), 1.0, 30.0 if len(labels) and labels[0] else -30.0 if len(labels) else 0.0)
    held = np.arange(len(rows)) % aside == aside - 1
    if len(set(labels[held].tolist())) < 2 or len(set(labels[~held].tolist())) < 2:
        held = np.zeros(len(rows), bool)
    own = [x for x, h in zip(rows, held) if not h]
    ratio = log_count_ratio(own, labels[~held], smooth)
    model = Model(dual_coordinate_descent(own, labels[~held], ratio, cost, rounds) * ratio)
    use = held if held.any() else ~held
    margins, y = np.array([model.margin(x) for x, u in zip(rows, use) if u]), labels[use].astype(float)
    # Newton's method on the two parameters; both classes weigh the same.
    weigh = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    target, theta, design = np.where(y > 0, 1 - 1 / (y.sum() + 2), 1 / ((1 - y).sum() + 2)), np.array([1.0, 0.0]), np.column_stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (weigh * p * (1 - p) + 1e-6)[:, None]) + 1e-6 * np.eye(2), design.T @ (weigh * (p - target)))
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    return Model(model.weights, max(float(theta[0]), 1e-6), float(theta[1]))


def held_out(id_col: Column, parts: int = 3, kept: int = 1) -> Column:
    """Whether crc32 of the id as text leaves that remainder; null ids are not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == kept, F.lit(False))


def bounded(rows, most_rows: int, most_features: int) -> list[tuple[int, int, bytes]]:
    """(hash, label, features) of rows(id, label, features) by hash, the least hashes of all that keep within both bounds. No more is held."""
    held, size, end = [], 0, 1 << 64
    for own, label, features in rows:
        h = xxhash.xxh64_intdigest(features, xxhash.xxh64_intdigest(str(own)))
        if h >= end:
            continue
        heapq.heappush(held, (-h, label, features))
        size += len(features) // 4
        while len(held) > most_rows or (size > most_features and len(held) > 1):
            out = heapq.heappop(held)
            size, end = size - len(out[2]) // 4, min(end, -out[0])
    return sorted((-h, label, features) for h, label, features in held)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    """A model of the labelled rows that are not held out.

    Fitted in one task on about fit_rows of them, chosen by 64 bits of a hash of the id (all, if they are fewer); the
    ids and labels of these alone are broadcast, and only features leave the texts' tasks. Rows of one id may be many:
    of what comes, the task keeps a quarter more than fit_rows at most, and no more than FIT_FEATURES features. Null
    labels are left out; of several labels of an id the least counts.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    ids = usable.count()
    chosen = usable if ids <= fit_rows else usable.where(F.xxhash64("id", F.lit("fit")) < (fit_rows << 64) // ids - (1 << 63))

    def features(batches):
        of = Indicators()
        for batch in parts(batches):
            rows = [of.of(t).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["id", "label", "features"])

    def fitted(batches):
        rows = bounded((r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))), fit_rows * 5 // 4, FIT_FEATURES)
        model = fit([np.frombuffer(x, np.int32) for _, _, x in rows], np.array([y for _, y, _ in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype(np.float32).tobytes()]), pa.array([model.slope]), pa.array([model.shift])], names=["weights", "slope", "shift"])

    kind = dict(chosen.dtypes)["id"]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "label", "text")
    found = texts.mapInArrow(features, f"id {kind}, label int, features binary").repartition(1).mapInArrow(fitted, "weights binary, slope double, shift double").first()
    return Model(np.frombuffer(found["weights"], np.float32), found["slope"], found["shift"])


def scored(docs: DataFrame, model: Model, text_col: str = "text", least: float | None = None) -> DataFrame:
    """doc (each row of docs as a struct) with the model's score (0 to 1) of its whole text; null is empty.

    least: leave out rows that score less.
    """

    def run(batches):
        of = Indicators()
        for batch in parts(batches):
            texts = batch.column(0).field(at) if at is not None else batch.column(1)
            scores = np.array([model.score(of.of(t)) for t in texts.to_pylist()], np.float64)
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc", "score"])
            yield out if least is None else out.filter(pa.array(scores >= least))

    # A text that is a column of docs is sent once, as a part of doc.
    at = docs.columns.index(text_col) if docs.columns.count(text_col) == 1 else None
    rows = docs.select(F.struct("*").alias("doc"), *([F.col(text_col).alias("text")] if at is None else []))
    return rows.mapInArrow(run, StructType([rows.schema["doc"], StructField("score", DoubleType())]))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, held_out, score, predicted. A text of any length is scored whole.

    Labels, and nothing else but texts, teach the model, and only of rows that are not held out. Empty and null
    texts get a score too. Without labels all scores are one half. Repeated rows stay; an empty table returns none.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    found = scored(docs.select(F.col(id_col), F.col(text_col)), model, text_col).select(F.col(f"doc.{id_col}"), "score")
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that a model of the labels scores at `least` or more."""
    return scored(docs, train(docs, labels, id_col=id_col, text_col=text_col), text_col, least).select("doc.*")
