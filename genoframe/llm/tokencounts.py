"""Token counts of a unigram vocabulary, with forward scores shared in a trie of pre-tokens.

The best segmentation of a prefix does not depend on what follows, so distinct pre-tokens are put in a trie and
the forward score of each node is worked out once: the best of its pieces' scores plus the score of the
node at which the piece begins. A pre-token's count is that of its last node.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = re.compile(r"\s")
#: What stands for the space before a word in vocabulary files.
SPACE = "▁"
#: Nodes, about, that a task holds before it begins a new trie.
HELD_NODES = 400_000
#: Characters of the longest pre-token that is put in the trie.
TRIE_CHARS = 256
#: Zipf-Mandelbrot shift of the ranks, and the score of a byte of an unknown character below the last rank's.
SHIFT, PENALTY = 2.7, 10.0


class Pieces:
    """Scores of pieces, and the pieces read backwards as a trie."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = min(scores.values(), default=0.0) - PENALTY
        self.longest = max(map(len, scores), default=0)
        self.backwards: list[dict[str, int]] = [{}]
        self.score_at: list[float | None] = [None]
        for piece, score in scores.items():
            at = 0
            for char in reversed(piece):
                nxt = self.backwards[at].get(char)
                if nxt is None:
                    nxt = self.backwards[at][char] = len(self.backwards)
                    self.backwards.append({})
                    self.score_at.append(None)
                at = nxt
            self.score_at[at] = score


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """Of a sentencepiece model. Its file ranks pieces by merges, not by probability; rank r counts as log 1 / (r + SHIFT)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ranked = sorted(normal, key=lambda i: (-model.get_score(i), i))
    return Pieces({model.id_to_piece(i): -math.log(rank + SHIFT) for rank, i in enumerate(ranked)})


class Trie:
    """Pre-tokens with the forward score and the count of tokens of each prefix."""

    def __init__(self, own: Pieces):
        self.own = own
        self.children: list[dict[str, int]] = [{}]
        self.score, self.count = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def insert(self, token: str) -> int:
        """Tokens of the best segmentation; of equal scores that with fewer. A character that no piece covers is its UTF-8 bytes."""
        path, children, own = [0], self.children, self.own
        for i, char in enumerate(token):
            nxt = children[path[-1]].get(char)
            if nxt is None:
                size = len(char.encode("utf-8", "replace"))
                best = (self.score[path[i]] + size * own.unknown, -self.count[path[i]] - size)
                at, k = 0, i
                while k >= 0 and (at := own.backwards[at].get(token[k], 0)):
                    if (score := own.score_at[at]) is not None:
                        best = max(best, (self.score[path[k]] + score, -self.count[path[k]] - 1))
                    k -= 1
                nxt = children[path[-1]][char] = len(children)
                children.append({})
                self.score.append(best[0])
                self.count.append(-best[1])
            path.append(nxt)
        self.terminal[token] = self.count[path[-1]]
        return self.terminal[token]


def count_long(own: Pieces, token: str) -> int:
    """What Trie.insert() returns, with the scores of the last prefixes alone: no piece reaches farther back."""
    room = own.longest + 1
    scores, counts = [0.0] * room, [0] * room
    for i, char in enumerate(token):
        size = len(char.encode("utf-8", "replace"))
        best = (scores[i % room] + size * own.unknown, -counts[i % room] - size)
        at, k = 0, i
        while k >= 0 and (at := own.backwards[at].get(token[k], 0)):
            if (score := own.score_at[at]) is not None:
                best = max(best, (scores[k % room] + score, -counts[k % room] - 1))
            k -= 1
        scores[(i + 1) % room], counts[(i + 1) % room] = best[0], -best[1]
    return counts[len(token) % room]


class Counter:
    def __init__(self, own: Pieces):
        self.own, self.trie = own, Trie(own)

    def count(self, text: str | None, part: int = 1 << 20) -> tuple[int, int]:
        """(tokens, pre-tokens) of a text; long ones are split part by part, between words. A pre-token may have any length."""
        tokens = words = at = 0
        text = text or ""
        while at < len(text):
            end = min(at + part, len(text))
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
            own = text[at:end].split()
            if len(self.trie.children) > HELD_NODES:
                self.trie = Trie(self.own)
            known = self.trie.terminal
            words += len(own)
            if end - at > TRIE_CHARS:
                long = [w for w in own if len(w) > TRIE_CHARS]
                tokens += sum(count_long(self.own, SPACE + w) for w in long)
                own = [w for w in own if len(w) <= TRIE_CHARS] if long else own
            for word in set(own).difference(known):
                self.trie.insert(SPACE + word)
                known[word] = known.pop(SPACE + word)
            tokens += sum(map(known.__getitem__, own))
            at = end
        return tokens, words


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_tokens, n_pretokens, of its whole text split at white space.

    Null and empty texts have none. Pre-tokens over TRIE_CHARS, such as a text without spaces, are counted with the
    same scores in memory of the longest piece's size and put in no trie. Rows, repeated ones too, stay as many as they are; an empty table returns
    none; other columns are not looked at.
    """

    def run(batches):
        counter = Counter(pieces(path))
        for batch in batches:
            found = [counter.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[k] for f in found], pa.int64()) for k in (0, 1))], names=["id", "n_tokens", "n_pretokens"])

    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, n_pretokens long")
    return out.withColumnRenamed("id", id_col)
