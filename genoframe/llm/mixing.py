"""Mixing sources to target weights by a Pfair schedule.

Each source's rows are cut into blocks. Of a source with weight w, block j is released at slot floor(j / w) and
due at ceil((j + 1) / w); in each slot the released block with the earliest deadline runs. With weights that
sum to one every block meets its window, so at every slot a source has had its share to within one block.
Weights are whole parts, so the schedule repeats after as many slots as there are parts: one period is worked
out, and a block's slot follows from its number. When a source has no more blocks, the others go on with
their weights among themselves, in a schedule of its own.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.shared import gapless
from genoframe.scratch import written

#: Rows of a block.
BLOCK_ROWS = 32
#: Most parts of all sources together, and so most slots of a period.
MOST_PARTS = 100_000
#: The class of all sources without a target of their own.
REST = "*"


@dataclass(frozen=True)
class Run:
    """What a source does while the same sources have blocks: its blocks from first to last, in slots from start on."""

    source: str
    first: int
    last: int
    start: int
    period: int
    parts: int
    places: list[int]


def period(parts: Mapping[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks within one period of sum(parts) slots: earliest deadline first, ties to more parts, then by name."""
    total = sum(parts.values())
    places: dict[str, list[int]] = {s: [] for s in parts}
    due = lambda s: -((-(len(places[s]) + 1) * total) // parts[s])
    for slot in range(total):
        open_ = [s for s in parts if len(places[s]) < parts[s] and len(places[s]) * total // parts[s] <= slot]
        places[min(open_, key=lambda s: (due(s), -parts[s], s))].append(slot)
    return places


def schedule(parts: Mapping[str, int], blocks: Mapping[str, int]) -> list[Run]:
    """Runs of every source with blocks; together they name a slot of its own for each block, without gaps."""
    if any(p < 1 or int(p) != p for p in parts.values()) or sum(parts.values()) > MOST_PARTS:
        raise ValueError(f"parts must be whole, positive and at most {MOST_PARTS} together")
    left, done, start, runs = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    while left:
        gcd = math.gcd(*[parts[s] for s in left])
        own = {s: parts[s] // gcd for s in left}
        total, places = sum(own.values()), period(own)
        slots = min((n - 1) // own[s] * total + places[s][(n - 1) % own[s]] + 1 for s, n in left.items())
        for s in list(left):
            n = slots // total * own[s] + sum(p < slots % total for p in places[s])
            if n:
                runs.append(Run(s, done[s], done[s] + n - 1, start, total, own[s], places[s]))
            done[s], left[s] = done[s] + n, left[s] - n
            if not left[s]:
                del left[s]
        start += slots
    return runs


def placed(docs: DataFrame, targets: Mapping[str, int], rest: int = 1, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """doc (each row of docs as a struct) with mix_class, place, block, slot, release, deadline and position.

    targets: parts of each source; all other sources, null too, are the class "*" with `rest` parts. place counts a
    class's rows from 0, block is place div block_rows, position counts all rows from 0 in the mixed order: by
    slot, then place. Rows are dealt within their class by a hash of the id, so a class may hold any share
    of the rows, and no row is left out; only the classes' counts reach the driver. Rows with equal ids are
    told apart by their place in the input, which is written first. An empty table stays empty.
    """
    if REST in targets:
        raise ValueError(f"{REST} is the class of all other sources")
    source = F.col(source_col)
    named = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), (F.when(source.isin(list(targets)), source).otherwise(REST) if targets else F.lit(REST)).alias("mix_class"), F.monotonically_increasing_id().alias("row"))
    named = written(named)
    counts = {r["mix_class"]: r["count"] for r in named.groupBy("mix_class").count().collect()}
    runs = schedule({**targets, REST: rest}, {s: -(-n // block_rows) for s, n in counts.items()})
    # A class's last block may be short: positions after it are less by what it lacks.
    ends = {}
    for r in runs:
        ends[r.source] = r.start + (r.last - r.first) // r.parts * r.period + r.places[(r.last - r.first) % r.parts]
    lacks = [(slot, -counts[s] % block_rows) for s, slot in ends.items()]
    table = docs.sparkSession.createDataFrame([(r.source, r.first, r.last, r.start, r.period, r.parts, r.places) for r in runs], "rc string, first long, last long, start long, period long, parts long, places array<int>")
    numbered = gapless(named, "mix_class", [F.xxhash64("id"), F.col("row")], "place", F.xxhash64("row"))
    numbered = numbered.withColumn("block", F.floor(F.col("place") / block_rows))
    j, inside = F.col("block") - F.col("first"), F.col("block").between(F.col("first"), F.col("last"))
    found = numbered.join(F.broadcast(table), (F.col("mix_class") == F.col("rc")) & inside)
    turn = F.floor(j / F.col("parts"))
    found = found.withColumns({
        "slot": F.col("start") + turn * F.col("period") + F.element_at("places", (j - turn * F.col("parts") + 1).cast("int")),
        "release": F.col("start") + F.floor(j * F.col("period") / F.col("parts")),
        "deadline": F.col("start") + F.ceil((j + 1) * F.col("period") / F.col("parts")),
    })
    less = sum((F.when(F.col("slot") > slot, n).otherwise(0) for slot, n in lacks), F.lit(0))
    position = F.col("slot") * block_rows + F.col("place") % block_rows - less
    return found.select("doc", "mix_class", F.col("place").cast("long"), "block", "slot", "release", "deadline", position.cast("long").alias("position"))


def mixed(docs: DataFrame, targets: Mapping[str, int], rest: int = 1, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """placed() with the columns of docs instead of doc; where one has the name of an added column, the added one stays."""
    found = placed(docs, targets, rest, block_rows, id_col, source_col)
    added = found.columns[1:]
    return found.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in added], *added)


def in_mixed_order(docs: DataFrame, targets: Mapping[str, int], rest: int = 1, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs itself, sorted into the mixed order: part files one after another hold it."""
    return placed(docs, targets, rest, block_rows, id_col, source_col).select("doc", "position").orderBy("position").select("doc.*")
