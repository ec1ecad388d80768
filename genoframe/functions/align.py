"""Global alignment of oriented sequence pairs, for segments that no outside aligner has worked on.

Pairs of up to WHOLE bases are aligned by fewest edits, many short ones at once. A longer pair is cut into tiles at exact words that both
sequences hold once and in the same order, the tiles are aligned by fewest edits as rows of their own, and their paths are joined by position.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.functions import bands
from genoframe.operators.groups import over_groups

#: Words at which a pair is cut: first the long ones, then shorter ones within tiles that stay over TILE bases.
SEEDS, TILE = (32, 20, 12), 256
#: Most that going on to another diagonal costs, in bases, and how many runs of words before it a run looks back at.
LEAP, BACK = 100, 64
#: Bases from which shared words are found by sorting numbers of them.
MANY = 400
#: Bases of pairs that are aligned without cuts.
WHOLE = 1 << 18
#: Bases of pairs that are aligned many at once, and bytes that the columns of a longer one may take.
SHORT, COLUMNS = 1024, 1 << 25
#: Pairs of a batch of rows that are worked on at a time.
ROWS = 512

Path = list[tuple[str, int]]


def _middle(a: str, b: str, most: int | None) -> tuple[int, int] | None:
    """A place (x, y) inside on a path of fewest edits, for sequences at least two edits apart; None if there are more than `most`.

    Fronts grow from both ends, one edit at a time: of each diagonal (x less y) the farthest base that so many edits reach.
    Costs do not fall along a diagonal, so where fronts meet, the paths do. Only the fronts are kept.
    """
    n, m = len(a), len(b)
    ahead = ({}, {})  # one of them with both sequences turned round
    edits = [-1, -1]
    while True:
        way = 0 if edits[0] <= edits[1] else 1
        edits[way] += 1
        if most is not None and sum(edits) > most:
            return None
        last, front = ahead[way], {}
        for k in range(max(-m, -edits[way]), min(n, edits[way]) + 1):
            x = max(last.get(k, -2) + 1, last.get(k - 1, -2) + 1, last.get(k + 1, -2)) if last else 0
            x = min(x, n, m + k)
            if x < max(0, k):
                continue
            y = x - k
            if way:
                while x < n and y < m and a[-1 - x] == b[-1 - y]:
                    x, y = x + 1, y + 1
            else:
                while x < n and y < m and a[x] == b[y]:
                    x, y = x + 1, y + 1
            front[k] = x
        ahead[way].clear()
        ahead[way].update(front)
        for k, x in front.items():
            other = ahead[1 - way].get(n - m - k)
            if other is not None and x + other >= n:
                at, k = (n - other, k) if not way else (n - x, n - m - k)
                return at, at - k


def edit_path(target: str, query: str, most: int | None = None) -> Path | None:
    """Runs of '=', 'X', 'I' (query alone) and 'D' (target alone) with fewest edits; None if there are more than `most`.

    The pair is halved at a place of a best path again and again, so memory grows with the sequences' length alone.
    """
    out: list[list] = []
    todo: list[tuple[int, int, int, int] | int] = [(0, len(target), 0, len(query))]

    def add(op: str, n: int) -> None:
        if n and out and out[-1][0] == op:
            out[-1][1] += n
        elif n:
            out.append([op, n])

    while todo:
        job = todo.pop()
        if isinstance(job, int):
            add("=", job)
            continue
        t0, t1, q0, q1 = job
        tail = 0
        while t0 < t1 and q0 < q1 and target[t0] == query[q0]:
            add("=", 1)
            t0, q0 = t0 + 1, q0 + 1
        while t0 < t1 and q0 < q1 and target[t1 - 1] == query[q1 - 1]:
            t1, q1, tail = t1 - 1, q1 - 1, tail + 1
        if t0 == t1 or q0 == q1 or (t1 - t0 == 1 and q1 - q0 == 1):
            if most is not None and max(t1 - t0, q1 - q0) > most:
                return None
            same = min(t1 - t0, q1 - q0)
            for op, n in (("X", same), ("D", t1 - t0 - same), ("I", q1 - q0 - same), ("=", tail)):
                add(op, n)
        elif (found := _middle(target[t0:t1], query[q0:q1], most)) is None:
            return None
        else:
            todo += [tail, (t0 + found[0], t1, q0 + found[1], q1), (t0, t0 + found[0], q0, q0 + found[1])]
        most = None  # the whole pair is within it
    return [(op, n) for op, n in out]


def _column(target: str, query: str) -> tuple[int, int]:
    """Where, from one base of the query to the next, the edits to the whole target grow and where they fall, as bits.

    A column of the table of edits is two whole numbers, which a base of the target changes at once.
    """
    every = (1 << len(query)) - 1
    places = {x: int("".join("1" if y == x else "0" for y in reversed(query)), 2) for x in set(query)}
    up, down = every, 0
    for x in target:
        same = places.get(x, 0)
        across = (((same & up) + up) ^ up) | same
        down_across, up_across = up & across, down | (every & ~(across | up))
        up_across, same = up_across << 1 | 1, same | down
        up, down = (down_across << 1 | ~(same | up_across)) & every, up_across & same & every
    return up, down


def fewest_edits(target: str, query: str) -> int:
    """How many edits part them; time grows with the product of the lengths, 64 cells at a time."""
    if not target or not query:
        return len(target) + len(query)
    up, down = _column(target, query)
    return len(target) + up.bit_count() - down.bit_count()


def _edits_to(target: str, query: str) -> np.ndarray:
    """Edits between the target and the query's first 0, 1, ... bases."""
    size = len(query) // 8 + 1
    steps = [np.unpackbits(np.frombuffer(x.to_bytes(size, "little"), np.uint8), bitorder="little")[: len(query)].astype(np.int64) for x in _column(target, query)]
    return len(target) + np.concatenate([[0], np.cumsum(steps[0] - steps[1])])


def whole_path(target: str, query: str) -> Path:
    """edit_path() for pairs of many edits: the target is halved where the fewest edits to both halves meet, again and again."""
    out: list[list] = []
    todo = [(target, query)]
    while todo:
        t, q = todo.pop()
        if max(len(t), len(q)) > TILE and len(t) > 1 and q:
            half = len(t) // 2
            at = int(np.argmin(_edits_to(t[:half], q) + _edits_to(t[half:][::-1], q[::-1])[::-1]))
            todo += [(t[half:], q[at:]), (t[:half], q[:at])]
            continue
        for op, n in edit_path(t, q):
            if out and out[-1][0] == op:
                out[-1][1] += n
            else:
                out.append([op, n])
    return [(op, n) for op, n in out]


class _Columns:
    """Of the table of edits, column by column, the cells on the diagonals (target less query) from `low` to `high`; as _column(), of a part of the query that moves on with the target.

    What comes in from outside the band is as if an edit were made for every base, so no value is too small, and those that a path within the band leads to are right.
    """

    def __init__(self, target: bytes, query: bytes, low: int, high: int, keep: bool):
        n, m, part = len(target), len(query), max(64, (high - low) // 8)
        text, alphabet = query[::-1], set(query)
        places = {x: int(text.translate(bytes(49 if y == x else 48 for y in range(256))), 2) for x in alphabet}
        self.ups: list[int] = []
        self.downs: list[int] = []
        self.offsets: list[int] = []
        self.part = part
        first = ended = up = down = value = 0
        for at in range(0, max(n, 1), part):
            to = min(n, at + part)
            new_first, new_ended = max(first, min(m, at - high)), max(ended, min(m, to - low))
            gone = new_first - first
            value += (up & ((1 << gone) - 1)).bit_count() - (down & ((1 << gone) - 1)).bit_count()
            up, down, first = up >> gone, down >> gone, new_first
            up |= ((1 << (new_ended - ended)) - 1) << (ended - first)
            ended = new_ended
            every = (1 << (ended - first)) - 1
            own = [0] * 256
            for x, whole in places.items():
                own[x] = (whole >> first) & every
            self.offsets.append(first)
            # Complements by masks, as negative numbers take longer; what carries leave beyond the band goes with the last one.
            over = every << 3 | 7
            ups, downs = self.ups, self.downs
            for x in target[at:to]:
                same = own[x]
                across = (((same & up) + up) ^ up) | same
                up_across = (down | ((across | up) ^ every)) << 1 | 1
                same |= down
                up = ((up & across) << 1 | ((same | up_across) ^ over)) & every
                down = up_across & same
                if keep:
                    ups.append(up)
                    downs.append(down)
            value += to - at
        self.up, self.down, self.first, self.ended, self.value = up, down, first, ended, value

    def last(self) -> int:
        """Edits of both whole."""
        return self.value + self.up.bit_count() - self.down.bit_count()

    def to_each(self) -> np.ndarray:
        """Edits of the whole target and the query's bases up to each place from `first` to `ended`."""
        n = self.ended - self.first
        size = n // 8 + 1
        steps = [np.unpackbits(np.frombuffer(x.to_bytes(size, "little"), np.uint8), bitorder="little")[:n].astype(np.int64) for x in (self.up, self.down)]
        return self.value + np.concatenate([[0], np.cumsum(steps[0] - steps[1])])

    def path(self, t: bytes, q: bytes) -> Iterator[tuple[str, int]]:
        """The path of fewest edits from its end, of all columns."""
        i, j, ups, downs, offsets, part = len(t), len(q), self.ups, self.downs, self.offsets, self.part
        t_ends, q_ends = bands.ends(t, 0), bands.ends(q, 255)
        while i and j:
            n = i
            while not (off := t_ends[i] ^ q_ends[j]):
                i, j = i - 8, j - 8
            same = (64 - off.bit_length()) >> 3
            i, j = i - same, j - same
            if n > i:
                yield "=", n - i
                continue
            if ups[i - 1] >> (j - 1 - offsets[(i - 1) // part]) & 1:
                j -= 1
                yield "I", 1
                continue
            i -= 1
            if i and downs[i - 1] >> (j - 1 - offsets[(i - 1) // part]) & 1:
                yield "D", 1
            else:
                j -= 1
                yield "X", 1
        yield ("D", i) if i else ("I", j)


def _columns_path(target: bytes, query: bytes) -> Path:
    """A path of fewest edits of a long pair. Where its columns take too much room the pair is halved first."""
    out: list[tuple[str, int]] = []
    todo: list[tuple[bytes, bytes, int | None]] = [(target, query, None)]
    while todo:
        t, q, edits = todo.pop()
        if not t or not q:
            out.append(("D", len(t)) if t else ("I", len(q)))
            continue
        off = len(t) - len(q)
        most = edits if edits is not None else int(bands.RATE * min(len(t), len(q))) + abs(off) + 16
        while True:
            # A diagonal more on each side, so no path of so many edits comes to the end of the band.
            low, high = -((most - off) // 2 + 2), (most + off) // 2 + 2
            if len(t) < 2 or len(t) * (high - low) // 4 <= COLUMNS:
                columns = _Columns(t, q, low, high, True)
                found = columns.last()
                if found <= most:
                    out += reversed(list(columns.path(t, q)))
                    break
            else:
                half = len(t) // 2
                ahead, back = _Columns(t[:half], q, low, high, False), _Columns(t[half:][::-1], q[::-1], off - high, off - low, False)
                # Both end at places of the query: of those that both come to, the one of fewest edits.
                first, ended = max(ahead.first, len(q) - back.ended), min(ahead.ended, len(q) - back.first)
                sums = ahead.to_each()[first - ahead.first : ended - ahead.first + 1] + back.to_each()[::-1][first - (len(q) - back.ended) : ended - (len(q) - back.ended) + 1]
                place = int(np.argmin(sums))
                found, at = int(sums[place]), first + place
                if found <= most:
                    one = int(ahead.to_each()[at - ahead.first])
                    todo += [(t[half:], q[at:], found - one), (t[:half], q[:at], one)]
                    break
            most = min(2 * most, max(len(t), len(q)))
    return bands.merged(out)


def edit_paths(pairs: list[tuple[str, str]]) -> list[Path]:
    """Runs of '=', 'X', 'I' (query alone) and 'D' (target alone) with fewest edits of every pair; short pairs are worked on together."""
    found: list[Path] = [[]] * len(pairs)
    short = []
    for i, (t, q) in enumerate(pairs):
        if not (t.isascii() and q.isascii()):
            found[i] = whole_path(t, q)
        elif max(len(t), len(q)) <= SHORT:
            short.append(i)
        else:
            found[i] = _columns_path(t.encode(), q.encode())
    for i, (_, path) in zip(short, bands.banded_paths([tuple(x.encode() for x in pairs[i]) for i in short], bands.EDITS)):
        found[i] = path
    return found


def _once(text: str, size: int) -> dict[str, int]:
    """Places of the words of that size that occur once."""
    seen: dict[str, int] = {}
    for i in range(len(text) - size + 1):
        word = text[i : i + size]
        seen[word] = -1 if word in seen else i
    return {w: i for w, i in seen.items() if i >= 0}


def _words(text: str, size: int) -> np.ndarray:
    """A number for the word of that size at each place."""
    x = (np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    found, done, step = None, 0, 1
    while step <= size:
        factor = np.uint64(pow(0x9E3779B97F4A7C15, step, 1 << 64))
        if size & step:
            n = len(text) - done - step + 1
            found = x[:n] if found is None else found[:n] * factor + x[done : done + n]
            done += step
        x = x[:-step] * factor + x[step:]
        step *= 2
    return found


def _shared(target: str, query: str, size: int) -> list[tuple[int, int]]:
    """Places (t, q), by t, of the words of that size that both hold once."""
    if max(len(target), len(query)) < MANY or min(len(target), len(query)) < size:
        once = _once(query, size)
        return [(i, once[w]) for w, i in _once(target, size).items() if w in once] if once else []
    sides = []
    for text in (target, query):
        words = _words(text, size)
        order = np.argsort(words)
        words = words[order]
        differs = np.concatenate([[True], words[1:] != words[:-1], [True]])
        once = differs[1:] & differs[:-1]
        sides += [words[once], order[once]]
    t, t_at, q, q_at = sides
    if not len(q):
        return []
    at = np.minimum(np.searchsorted(q, t), len(q) - 1)
    same = q[at] == t
    pairs = sorted(zip(t_at[same].tolist(), q_at[at[same]].tolist()))
    # Words of one number are all but always the same.
    return [(i, j) for i, j in pairs if target[i : i + size] == query[j : j + size]]


def _runs(pairs: list[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """(t, q, n): places that follow each other on one diagonal, less than a word apart, as one run of n bases' starts."""
    open_: dict[int, list[int]] = {}
    out = []
    for t, q in pairs:
        run = open_.get(t - q)
        if run and t < run[0] + run[2] + size:
            run[2] = t - run[0] + 1
        else:
            run = open_[t - q] = [t, q, 1]
            out.append(run)
    return [tuple(r) for r in out]


def _in_register(pairs: list[tuple[int, int]], size: int, t_n: int, q_n: int) -> list[tuple[int, int, int]]:
    """The best chain of runs of (t, q), sorted by t, that go on on both sides, from the beginning to the end of sequences that long.

    A run is worth its bases; going on to another diagonal, from the beginning's and to the end's too, costs the difference, up to LEAP. So a chance hit, which is short and off the diagonal
    of what is around it, costs more than it is worth, and a large indel between long runs does not. A run looks back at BACK others.
    """
    runs = _runs(pairs, size)
    worth: list[float] = []
    before: list[int] = []
    for j, (t, q, n) in enumerate(runs):
        best, come = -float(min(LEAP, abs(t - q))), -1
        for i in range(max(0, j - BACK), j):
            u, p, m = runs[i]
            if u + m <= t and p + m <= q:
                got = worth[i] - min(LEAP, abs((t - q) - (u - p)))
                if got > best:
                    best, come = got, i
        worth.append(best + n + size - 1)
        before.append(come)
    ended = [w - min(LEAP, abs((t_n - q_n) - (t - q))) for w, (t, q, _) in zip(worth, runs)]
    i = max(range(len(runs)), key=ended.__getitem__, default=-1)
    out, i = [], i if i >= 0 and ended[i] > 0 else -1
    while i >= 0:
        out.append(runs[i])
        i = before[i]
    return out[::-1]


def cuts(target: str, query: str, seeds: tuple[int, ...] = SEEDS, tile: int = TILE) -> Iterator[tuple[int, int]]:
    """Places (t, q) in order where a pair can be cut in register: middles of exact words that both hold once.

    Between them shorter words are looked for while more than `tile` bases lie there.
    """
    if not seeds or max(len(target), len(query)) <= tile:
        return
    size, half = seeds[0], seeds[0] // 2
    runs = _in_register(_shared(target, query, size), size, len(target), len(query))
    chain = [(t + k, q + k) for t, q, n in runs for k in (*range(0, n - 1, half), n - 1)]
    t = q = 0
    for i, j in [*chain, (None, None)]:
        to_t, to_q = (len(target), len(query)) if i is None else (i + half, j + half)
        # Cuts nearer than a tile to the last are not needed.
        if i is not None and to_t - t < tile and to_q - q < tile:
            continue
        for x, y in cuts(target[t:to_t], query[q:to_q], seeds[1:], tile):
            yield t + x, q + y
        if i is not None:
            yield to_t, to_q
            t, q = to_t, to_q


def difference_string(path: Path, target: str, query: str, long: bool = False) -> str:
    """The cs form of a path; long: with the equal bases themselves."""
    t = q = 0
    out = []
    for op, n in path:
        if op == "=":
            out.append(f"={target[t : t + n]}" if long else f":{n}")
        elif op == "X":
            out += [f"*{a}{b}" for a, b in zip(target[t : t + n].lower(), query[q : q + n].lower())]
        else:
            out.append("+" + query[q : q + n].lower() if op == "I" else "-" + target[t : t + n].lower())
        t, q = t + n * (op != "I"), q + n * (op != "D")
    return "".join(out)


ALIGNED = "cg string, cs string, nmatch bigint, alnlen bigint, edits bigint, reason string"


def described(path: Path, target: str, query: str, long: bool) -> tuple:
    """(cg, cs, nmatch, alnlen, edits)."""
    merged = [(m, sum(n for _, n in run)) for m, run in groupby(path, key=lambda x: "M" if x[0] in "=X" else x[0])]
    same, whole = sum(n for op, n in path if op == "="), sum(n for _, n in path)
    return "".join(f"{n}{op}" for op, n in merged), difference_string(path, target, query, long), same, whole, whole - same


def align_pairs(rows: DataFrame, target: str = "target", query: str = "query", most: int | None = None, long: bool = False) -> DataFrame:
    """rows with `aln`: struct of cg, cs, nmatch, alnlen and edits, or of the reason why there is none.

    Each pair is worked on by itself, whole: for pairs of up to some thousand bases, or of few edits: time grows with
    the square of the edits. most: pairs of more edits have the reason "too many edits". None: no such limit.
    """

    @F.pandas_udf(ALIGNED)
    def run(targets: pd.Series, queries: pd.Series) -> pd.DataFrame:
        found = []
        for t, q in zip(targets, queries):
            if not t or not q:
                found.append((None, None, None, None, None, "empty"))
                continue
            path = edit_path(t.upper(), q.upper(), most)
            found.append((None, None, None, None, None, "too many edits") if path is None else (*described(path, t, q, long), None))
        out = pd.DataFrame(found, columns=["cg", "cs", "nmatch", "alnlen", "edits", "reason"])
        return out.astype({c: "Int64" for c in ("nmatch", "alnlen", "edits")})

    return rows.withColumn("aln", run(F.col(target), F.col(query)))


def align_by_tiles(rows: DataFrame, id_col: str, target: str = "target", query: str = "query", long: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, cg, cs, nmatch, alnlen, edits, then the columns `keep`) of rows(id, target, query), however long or different the pairs are; empty pairs are left out.

    Pairs of up to WHOLE bases are aligned by fewest edits where they are, so that their bases are not dealt. Longer ones become rows of tiles, which are dealt anew and
    aligned each by fewest edits; then the paths of a pair are joined in order. Ids name pairs. Cuts lie in exact words, so they cost no edits but where such a word is a chance hit.
    """
    kinds = dict(rows.dtypes)
    kind, also = kinds[id_col], "".join(f", {c} {kinds[c]}" for c in keep)
    shape = f"id {kind}, cg string, cs string, nmatch bigint, alnlen bigint, edits bigint"
    pairs = rows.select(F.col(id_col).alias("id"), F.col(target).alias("t"), F.col(query).alias("q"), *keep)
    longest, some = F.greatest(F.length("t"), F.length("q")), (F.col("t") != "") & (F.col("q") != "")

    def whole(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist()))
                paths = edit_paths([(t.upper(), q.upper()) for t, q in texts])
                found = list(zip(*(described(path, t, q, long) for path, (t, q) in zip(paths, texts))))
                columns = [pa.array(c, k) for c, k in zip(found, (pa.string(), pa.string(), *[pa.int64()] * 3))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, *part.columns[3:]], names=["id", "cg", "cs", "nmatch", "alnlen", "edits", *keep])

    def tiles(batches):
        for batch in batches:
            for i, (own, t, q) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]))):
                places = [(0, 0), *cuts(t.upper(), q.upper()), (len(t), len(q))]
                parts = [(own, k, t[a:c], q[b:d]) for k, ((a, b), (c, d)) in enumerate(zip(places, places[1:]))]
                columns = [pa.array([p[i] for p in parts], x) for i, x in enumerate((batch.schema.field(0).type, pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, *(c.take(pa.array([i] * len(parts))) for c in batch.columns[3:])], names=["id", "tile", "t", "q", *keep])

    # A condition that is not worked out before rows are dealt, so that both kinds of pairs share what the caller has dealt.
    far = pairs.where(F.when(F.spark_partition_id() >= 0, some & (longest > WHOLE)))
    dealt = far.mapInArrow(tiles, f"id {kind}, tile long, t string, q string{also}").repartition("id", "tile")

    @F.pandas_udf("array<struct<op:string,n:bigint>>")
    def path_of(targets: pd.Series, queries: pd.Series) -> pd.Series:
        found: list[list[dict]] = []
        for at in range(0, len(targets), ROWS):
            paths = edit_paths([(t.upper(), q.upper()) for t, q in zip(targets[at : at + ROWS], queries[at : at + ROWS])])
            found += [[{"op": op, "n": n} for op, n in path] for path in paths]
        return pd.Series(found)

    def joined(key, group):
        steps: list[tuple[str, int]] = []
        ts, qs, others = [], [], ()
        for _, _, t, q, path, *others in group:
            ts.append(t)
            qs.append(q)
            steps += [(step["op"], step["n"]) for step in path]
        t, q = "".join(ts), "".join(qs)
        yield (*key, *described(bands.merged(steps), t, q, long), *others)

    paths = dealt.select("id", "tile", "t", "q", path_of("t", "q").alias("path"), *keep)
    cut = over_groups(paths, ["id"], ["tile"], joined, shape + also)
    near = pairs.where(F.when(F.spark_partition_id() >= 0, some & (longest <= WHOLE)))
    return near.mapInArrow(whole, shape + also).unionByName(cut).withColumnRenamed("id", id_col)
