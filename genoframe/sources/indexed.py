"""FASTA files with an index beside them, as a data source that reads only the bytes that are asked for.

    register(spark)
    spark.read.format("indexed_fasta").load(path).where("seq_id = 'chr1' and start < 500000")

A row is a chunk of a sequence. Partitions are runs of chunks whose places in the file follow from the index: the offset of a
sequence's first base, bases and bytes of a line. Filters on seq_id, start and end leave out chunks before a file is opened. Files
in bgzip blocks need their block index (.gzi) too; then only the blocks that hold the bytes are unpacked.
"""

from __future__ import annotations

import bisect
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from genoframe.operators.groups import over_groups
from genoframe.scratch import written
from genoframe.sources.fasta import CHUNK, slices_of_chunks

#: Bases of a partition at most (but for one chunk).
PARTITION = 1 << 25
#: Most names that are pushed down as a filter.
NAMES = 1000
#: Bytes of a file that a task looks through for an index.
RANGE_BYTES = 1 << 26
CHUNK_SCHEMA = "file string, seq_id string, start long, end long, first long, bases string"


@dataclass(frozen=True)
class Entry:
    """A sequence of an index: its file, name and length, where its first base is, bases and bytes of a line."""

    file: str
    name: str
    length: int
    offset: int
    line_bases: int
    line_bytes: int

    def place(self, base: int) -> int:
        return self.offset + base // self.line_bases * self.line_bytes + base % self.line_bases


@dataclass(frozen=True)
class Run:
    """Chunks first to last - 1 of a sequence."""

    entry: Entry
    first: int
    last: int


@dataclass
class Runs(InputPartition):
    runs: list[Run]


def _system(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def _read(path: str) -> bytes:
    system, at = _system(path)
    with system.open_input_stream(at) as f:
        return f.read()


def _exists(path: str) -> bool:
    system, at = _system(path)
    return system.get_file_info(at).type == pa.fs.FileType.File


def files_of(path: str) -> list[str]:
    """The file, or those of a folder that have an index, in order of their names."""
    system, at = _system(path)
    info = system.get_file_info(at)
    if info.type == pa.fs.FileType.File:
        return [path]
    if info.type == pa.fs.FileType.NotFound:
        raise FileNotFoundError(path)
    names = sorted(f.base_name for f in system.get_file_info(pa.fs.FileSelector(at)) if f.type == pa.fs.FileType.File and f.base_name.endswith(".fai"))
    return [f"{path.rstrip('/')}/{n.removesuffix('.fai')}" for n in names]


def entries(file: str) -> Iterator[Entry]:
    for line in _read(f"{file}.fai").decode().splitlines():
        if line:
            name, *numbers = line.split("\t")
            yield Entry(file, name, *map(int, numbers[:4]))


class _Plain:
    def __init__(self, file: str):
        system, at = _system(file)
        self.file = system.open_input_file(at)

    def bytes(self, start: int, end: int) -> bytes:
        return self.file.read_at(end - start, start)


class _Blocks:
    """A bgzip file: gzip members, and an index of where they begin, packed and unpacked."""

    def __init__(self, file: str):
        system, at = _system(file)
        self.file = system.open_input_file(at)
        index = _read(f"{file}.gzi")
        (n,) = struct.unpack_from("<Q", index)
        numbers = struct.unpack_from(f"<{2 * n}Q", index, 8)
        self.packed, self.plain = [0, *numbers[::2]], [0, *numbers[1::2]]

    def bytes(self, start: int, end: int) -> bytes:
        first = bisect.bisect_right(self.plain, start) - 1
        at, last = self.packed[first], bisect.bisect_left(self.plain, end)
        data = self.file.read_at((self.packed[last] if last < len(self.packed) else self.file.size()) - at, at)
        out, missing = [], end - self.plain[first]
        while data and missing > 0:
            member = zlib.decompressobj(31)
            out.append(member.decompress(data))
            missing -= len(out[-1])
            data = member.unused_data
        return b"".join(out)[start - self.plain[first] : end - self.plain[first]]


class _Wanted:
    """What filters leave: names (None: all), and the least and largest base that chunks may hold."""

    def __init__(self):
        self.names: set[str] | None = None
        self.low, self.high = 0, 1 << 62
        self.first = 0

    def take(self, f: Filter) -> None:
        column = getattr(f, "attribute", None)
        if column == ("seq_id",) and isinstance(f, EqualTo | In):
            names = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.names = names if self.names is None else self.names & names
        elif column == ("start",) and isinstance(f, EqualTo):
            self.first, self.high = max(self.first, f.value), min(self.high, f.value + 1)
        elif column == ("start",) and isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.first = max(self.first, f.value + isinstance(f, GreaterThan))
        elif column == ("start",) and isinstance(f, LessThan | LessThanOrEqual):
            self.high = min(self.high, f.value + isinstance(f, LessThanOrEqual))
        elif column == ("end",) and isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.low = max(self.low, f.value - isinstance(f, GreaterThanOrEqual))

    def chunks(self, entry: Entry, size: int) -> tuple[int, int]:
        """First chunk and one past the last that start at `first` or later, before `high`, and end after `low`."""
        first = max(-(-self.first // size), self.low // size)
        return first, -(-min(entry.length, self.high) // size)


class IndexedFastaReader(DataSourceReader):
    def __init__(self, path: str, size: int, most: int, around: int):
        self.path, self.size, self.most, self.around, self.wanted = path, size, most, around, _Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Chunks are left out by the filters; Spark looks at the rows of the others again."""
        for f in filters:
            self.wanted.take(f)
            yield f

    def partitions(self) -> list[Runs]:
        found, own, bases = [], [], 0
        each = max(1, self.most // self.size)
        for file in files_of(self.path):
            for entry in entries(file):
                if self.wanted.names is not None and entry.name not in self.wanted.names:
                    continue
                first, last = self.wanted.chunks(entry, self.size)
                for at in range(first, last, each):
                    run = Run(entry, at, min(last, at + each))
                    many = (run.last - run.first) * self.size
                    if own and bases + many > self.most:
                        found.append(Runs(own))
                        own, bases = [], 0
                    own.append(run)
                    bases += many
        return [*found, Runs(own)]

    def read(self, partition: Runs) -> Iterator[pa.RecordBatch]:
        opened: dict[str, _Plain | _Blocks] = {}
        for run in partition.runs:
            e = run.entry
            if e.file not in opened:
                opened[e.file] = _Blocks(e.file) if _exists(f"{e.file}.gzi") else _Plain(e.file)
            step = max(1, (1 << 22) // self.size)
            for at in range(run.first, run.last, step):
                first, stop = at * self.size, min(e.length, min(at + step, run.last) * self.size)
                start, end = max(0, first - self.around), min(e.length, stop + self.around)
                data = opened[e.file].bytes(e.place(start), e.place(end - 1) + 1).replace(b"\n", b"").replace(b"\r", b"")
                if len(data) != end - start:
                    raise ValueError(f"{e.file}: the index does not fit {e.name}")
                starts = list(range(first, stop, self.size))
                ends = [min(s + self.size, stop) for s in starts]
                firsts = [max(0, s - self.around) for s in starts]
                columns = [[e.file] * len(starts), [e.name] * len(starts), starts, ends, firsts, [data[s - start : t + self.around - start].decode() for s, t in zip(firsts, ends)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), *[pa.int64()] * 3, pa.string()))], names=[n.split()[0] for n in CHUNK_SCHEMA.split(", ")])


@dataclass
class Part(WriterCommitMessage):
    name: str | None


class IndexedFastaWriter(DataSourceWriter):
    """A FASTA file with its index from each task; files of tasks that failed or ran twice are removed on commit."""

    def __init__(self, path: str, width: int, overwrite: bool, columns: list[str]):
        self.path, self.width, self.overwrite, self.job = path.rstrip("/"), width, overwrite, uuid.uuid4().hex
        self.name, self.seq = columns.index("seq_id"), columns.index("seq")

    def write(self, rows: Iterator) -> Part:
        system, at = _system(self.path)
        system.create_dir(at)
        name, index, place = f"part-{self.job}-{uuid.uuid4().hex}.fa", [], 0
        with system.open_output_stream(f"{at}/{name}") as out:
            for row in rows:
                seq, own = (row[self.seq] or "").encode(), row[self.name]
                head = f">{own}\n".encode()
                width = self.width or max(1, len(seq))
                out.write(head)
                for i in range(0, len(seq), width):
                    out.write(seq[i : i + width] + b"\n")
                index.append(f"{own.split()[0] if own.split() else ''}\t{len(seq)}\t{place + len(head)}\t{width}\t{width + 1}\n")
                place += len(head) + len(seq) + -(-len(seq) // width)
        if not index:
            system.delete_file(f"{at}/{name}")
            return Part(None)
        with system.open_output_stream(f"{at}/{name}.fai") as out:
            out.write("".join(index).encode())
        return Part(name)

    def _remove(self, keep: set[str], all_jobs: bool) -> None:
        system, at = _system(self.path)
        for f in system.get_file_info(pa.fs.FileSelector(at, allow_not_found=True)):
            mine = f.base_name.startswith(f"part-{self.job}-")
            if f.type == pa.fs.FileType.File and (mine or all_jobs) and f.base_name not in keep:
                system.delete_file(f"{at}/{f.base_name}")

    def commit(self, messages: list[Part | None]) -> None:
        names = {m.name for m in messages if m and m.name}
        self._remove(names | {f"{n}.fai" for n in names}, self.overwrite)

    def abort(self, messages: list[Part | None]) -> None:
        self._remove(set(), False)


class IndexedFasta(DataSource):
    """Options: path; chunk, bases of a row; around, bases that a row holds on either side besides, from `first` on;
    partition, bases of a partition; width, bases of a written line (0: one line)."""

    @classmethod
    def name(cls) -> str:
        return "indexed_fasta"

    def schema(self) -> str:
        return CHUNK_SCHEMA

    def reader(self, schema) -> IndexedFastaReader:
        return IndexedFastaReader(self.options["path"], int(self.options.get("chunk", CHUNK)), int(self.options.get("partition", PARTITION)), int(self.options.get("around", 0)))

    def writer(self, schema, overwrite: bool) -> IndexedFastaWriter:
        return IndexedFastaWriter(self.options["path"], int(self.options.get("width", 60)), overwrite, schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(IndexedFasta)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_chunks(spark: SparkSession, path: str, chunk: int = CHUNK, partition: int = PARTITION, around: int = 0) -> DataFrame:
    """(file, seq_id, start, end, first, bases; 0-based, half-open) of the indexed file, or of all indexed files of the folder.

    bases begin at `first`: `around` bases before the chunk and as many after it come with it.
    """
    register(spark)
    return spark.read.format("indexed_fasta").option("chunk", chunk).option("partition", partition).option("around", around).load(path)


def write_indexed(sequences: DataFrame, path: str, width: int = 60) -> None:
    """seq_id and seq as FASTA files with indexes, one of each task; replaces what is in the folder."""
    register(sequences.sparkSession)
    sequences.select("seq_id", "seq").write.format("indexed_fasta").option("width", width).mode("overwrite").save(path)


def _pieces(file: str, start: int, end: int) -> Iterator[tuple]:
    """(header or None, offset of the first base, bases, lines, bases and bytes of the first line, bases of the last line, uneven)
    of what the records have of the lines that begin in the range; the first piece goes on with the record before, if it has no header."""
    system, at = _system(file)
    source = io.BufferedReader(system.open_input_file(at), 1 << 20)
    if start:
        source.seek(start - 1)
        source.readline()
    place = source.tell()
    own = [None, place, 0, 0, 0, 0, 0, False]
    while place < end and (line := source.readline()):
        place += len(line)
        text = line.rstrip(b"\r\n")
        if text.startswith(b">"):
            yield tuple(own)
            own = [text[1:].decode(), place, 0, 0, 0, 0, 0, False]
            continue
        if not own[3]:
            own[4:6] = len(text), len(line)
        else:
            own[7] = own[7] or own[6] != own[4] or len(text) > own[4]
        own[2], own[3], own[6] = own[2] + len(text), own[3] + 1, len(text)
    yield tuple(own)


def make_index(spark: SparkSession, path: str) -> DataFrame:
    """Write `<file>.fai` beside each plain FASTA file of the path, and return (file, seq_id, length, offset, line_bases, line_bytes).

    Files are looked through range by range, so a large file is many tasks'. Records whose lines, but for the last, differ in length are
    an error, as no index can describe them.
    """
    system, at = _system(path)
    info = system.get_file_info(at)
    found = [info] if info.type == pa.fs.FileType.File else [f for f in system.get_file_info(pa.fs.FileSelector(at)) if f.type == pa.fs.FileType.File and not f.base_name.endswith((".fai", ".gzi"))]
    named = [(path if info.type == pa.fs.FileType.File else f"{path.rstrip('/')}/{f.base_name}", f.size) for f in found]
    ranges = [(name, s, min(size, s + RANGE_BYTES)) for name, size in named for s in range(0, size, RANGE_BYTES)]
    kinds = "file string, range long, nth long, header string, offset long, bases long, lines long, line_bases long, line_bytes long, last long, uneven boolean"

    def run(batches):
        for batch in batches:
            for file, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [(file, start, i, *p) for i, p in enumerate(_pieces(file, start, end))]
                types = (pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 6, pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=[k.split()[0] for k in kinds.split(", ")])

    asked = spark.createDataFrame(ranges, "file string, start long, end long").repartition(max(1, len(ranges)))
    pieces = asked.mapInArrow(run, kinds)

    def fold(key, rows):
        """Index rows of a file, whose pieces come in order: one row for each record and range."""
        own: Entry | None = None
        uneven, last = False, 0
        out = []
        for _, _, _, header, offset, bases, lines, line_bases, line_bytes, end, odd in rows:
            if header is not None:
                out += [(own, uneven)] if own else []
                own, uneven, last = Entry(key[0], (header.split() or [""])[0], 0, offset, 0, 0), False, 0
            if own is None or not lines:
                continue
            if not own.length:
                own = replace(own, line_bases=line_bases, line_bytes=line_bytes)
            else:
                uneven = uneven or last != own.line_bases or line_bases > own.line_bases
            uneven, last = uneven or odd, end
            own = replace(own, length=own.length + bases)
        out += [(own, uneven)] if own else []
        if bad := [e.name for e, odd in out if odd]:
            raise ValueError(f"{key[0]}: lines of different length in {bad[:5]}")
        fs, to = _system(f"{key[0]}.fai")
        with fs.open_output_stream(to) as f:
            f.write("".join(f"{e.name}\t{e.length}\t{e.offset}\t{max(1, e.line_bases)}\t{max(2, e.line_bytes)}\n" for e, _ in out).encode())
        for e, _ in out:
            yield e.file, e.name, e.length, e.offset, e.line_bases, e.line_bytes

    return written(over_groups(pieces, ["file"], ["range", "nth"], fold, "file string, seq_id string, length long, offset long, line_bases long, line_bytes long"))


def read_slices(spark: SparkSession, segments: DataFrame, path: str, strand: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """slices() of the indexed FASTA of the path; only chunks of sequences and ranges that segments lie in are read."""
    chunks = read_chunks(spark, path, chunk).select("seq_id", F.floor(F.col("start") / chunk).alias("chunk"), "bases")
    names = segments.select("seq_id").distinct().limit(NAMES + 1).collect()
    if len(names) <= NAMES:
        chunks = chunks.where(F.col("seq_id").isin([r.seq_id for r in names]))
    return slices_of_chunks(segments, chunks, chunk, strand)
