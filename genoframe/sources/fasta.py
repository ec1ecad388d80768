"""Sequences: FASTA files in and out, slices of sequences."""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.functions.alignments import reverse_complement
from genoframe.operators.groups import over_groups
from genoframe.sources.tables import read_fai
from genoframe.sources.text import counted, is_there, lines

#: Names of files that Spark's text reader does not unpack.
PACKED = re.compile(r"\.(bgz|bgzf|xz|lzma)$", re.IGNORECASE)
#: Lines handed on at a time.
OUT_LINES = 10_000
#: Bases of the parts in which sequences meet what is cut out of them.
CHUNK = 1 << 16


def _opened(data: bytes) -> io.TextIOWrapper:
    """Text of a file's bytes, unpacked by what they begin with, as it is read."""
    if data[:2] == b"\x1f\x8b":
        raw = gzip.GzipFile(fileobj=io.BytesIO(data))
    elif data[:3] == b"BZh":
        raw = bz2.BZ2File(io.BytesIO(data))
    elif data[:6] == b"\xfd7zXZ\x00" or data[:3] == b"\x5d\x00\x00":
        raw = lzma.LZMAFile(io.BytesIO(data))
    else:
        raw = io.BytesIO(data)
    return io.TextIOWrapper(raw, "utf-8")


def _unpacked(spark: SparkSession, paths: list[str]) -> DataFrame:
    """lines() of packed files; a file is unpacked by one task, line by line."""

    def run(batches):
        table = lambda file, first, text: pa.RecordBatch.from_arrays([pa.array([file] * len(text)), pa.array([0] * len(text), pa.int64()), pa.array(range(first, first + len(text)), pa.int64()), pa.array(text)], names=["file", "split", "line_no", "line"])
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out, first = [], 0
                for line in _opened(data):
                    out.append(line.rstrip("\r\n"))
                    if len(out) == OUT_LINES:
                        yield table(file, first, out)
                        out, first = [], first + OUT_LINES
                yield table(file, first, out)

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(run, "file string, split long, line_no long, line string")


def fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """lines() of plain, gz, bgz, bz2, xz and lzma files."""
    names = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    plain, packed = [n for n in names if not PACKED.search(n)], [n for n in names if PACKED.search(n)]
    parts = ([lines(spark, plain)] if plain else []) + ([_unpacked(spark, packed)] if packed else [])
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def sequences_of(rows: DataFrame) -> DataFrame:
    """(file, ord, header, seq_id, seq, length) of lines(); ord numbers a file's records.

    seq_id is the header's first word. A header that comes again in a file begins its record anew: the last one's
    sequence counts, at the first one's place. Lines are dealt by record, so a file's records are many tasks'.
    """
    starts = F.col("line").startswith(">")
    rows = counted(rows.select("file", "split", "line_no", "line"), starts, "record").where("record > 0").drop("split")
    heads = rows.where(starts).groupBy("file", F.substring("line", 2, 1 << 30).alias("header")).agg(F.min("record").alias("ord"), F.max("record").alias("_last"))
    heads = heads.withColumnRenamed("file", "_file")
    rows = rows.join(heads, (F.col("file") == F.col("_file")) & (F.col("record") == F.col("_last"))).select("file", "ord", "header", "line_no", "line")

    def build(key, group):
        file, ord_ = key
        header, seq = None, bytearray()
        for _, _, header, _, line in group:
            if not line.startswith(">"):
                seq += line.strip().encode()
        yield file, ord_ - 1, header, (header.split() or [""])[0], seq.decode(), len(seq)

    return over_groups(rows, ["file", "ord"], ["line_no"], build, "file string, ord long, header string, seq_id string, seq string, length long")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """sequences_of() the files."""
    return sequences_of(fasta_lines(spark, path))


def first_record(sequences: DataFrame) -> DataFrame:
    """The first sequence of each file."""
    first = F.min_by(F.struct(*sequences.columns), "ord").alias("s")
    return sequences.groupBy(F.col("file").alias("_file")).agg(first).select("s.*")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, n): how many records each file has; sequences are not put together."""
    return fasta_lines(spark, path).groupBy("file").agg(F.count_if(F.col("line").startswith(">")).alias("n"))


def index_of(sequences: DataFrame) -> DataFrame:
    """(chrom, len), as an index file has them."""
    return sequences.select(F.col("seq_id").alias("chrom"), F.length("seq").cast("long").alias("len"))


def read_or_make_index(spark: SparkSession, fasta: str, fai: str | None = None) -> DataFrame:
    """(chrom, len) of the index file, or where there is none, of the sequences."""
    fai = fai or f"{fasta}.fai"
    return read_fai(spark, fai) if is_there(spark, fai) else index_of(read_fasta(spark, fasta))


def chunked(sequences: DataFrame, size: int = CHUNK) -> DataFrame:
    """(seq_id, chunk, bases): the sequences in parts of `size` bases, numbered from 0."""
    return sequences.select("seq_id", F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))).alias("chunk", "bases"))


def slices_of_chunks(segments: DataFrame, chunks: DataFrame, size: int, strand: str | None = None) -> DataFrame:
    """slices() of chunks(seq_id, chunk, bases), which may leave out chunks that no segment lies in.

    Segments meet the chunks that they lie in by number, so no segment carries a sequence, and one in a single chunk is cut out at once, in the
    one join; only those of several chunks are put together and joined back.
    """
    c = F.col
    kept = segments.columns
    chunks = chunks.select(c("seq_id").alias("_id"), c("chunk").cast("long").alias("_chunk"), "bases")
    segments = segments.withColumns({"_a": c("start").cast("long"), "_b": c("end").cast("long")})
    segments = segments.withColumns({"_first": F.floor(c("_a") / size), "_last": F.floor((c("_b") - 1) / size)})
    single = F.coalesce((c("_b") > c("_a")) & (c("_a") >= 0) & (c("_first") == c("_last")), F.lit(False))
    at = F.greatest(c("_a") - c("_chunk") * size, F.lit(0))
    piece = F.substring("bases", at.cast("int") + 1, (F.least(c("_b") - c("_chunk") * size, F.lit(size)) - at).cast("int"))
    # Most slices lie in one chunk, and come out of the join as they are.
    own = segments.where(single).join(chunks, (c("seq_id") == c("_id")) & (c("_first") == c("_chunk")), "left").select(*kept, piece.alias("_seq"))

    rest = segments.where(~single)
    asked = rest.select(c("seq_id").alias("_of"), "_a", "_b", "_first", "_last").where("_b > _a and _a >= 0").distinct()
    asked = asked.withColumn("_part", F.explode(F.sequence("_first", "_last")))
    met = asked.join(chunks, (c("_of") == c("_id")) & (c("_part") == c("_chunk")))
    pieces = met.groupBy("_of", "_a", "_b").agg(F.array_sort(F.collect_list(F.struct("_chunk", piece.alias("piece")))).alias("_p"))
    found = pieces.select("_of", c("_a").alias("_from"), c("_b").alias("_to"), F.concat_ws("", F.transform("_p", lambda p: p["piece"])).alias("_seq"))
    rest = rest.join(found, (c("seq_id") == c("_of")) & (c("_a") == c("_from")) & (c("_b") == c("_to")), "left").select(*kept, "_seq")

    seq = F.when(c("_seq") != "", c("_seq"))
    part = seq if strand is None else F.when(c(strand) == "-", reverse_complement(seq)).otherwise(seq)
    return own.unionByName(rest).select(*kept, part.alias("seq"))


def slices(segments: DataFrame, sequences: DataFrame, strand: str | None = None, size: int = CHUNK) -> DataFrame:
    """segments(seq_id, start, end: 0-based, half-open) with seq, reverse-complemented where the strand column is '-'.

    What lies beyond the sequence is left out; seq is null for segments of unknown sequences, without bases or wholly outside. Ids name sequences.
    """
    return slices_of_chunks(segments, chunked(sequences, size), size, strand)


def wrapped(seq: Column, width: int = 60) -> Column:
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")


def write_fasta(sequences: DataFrame, path: str, width: int | None = 60) -> None:
    """seq_id and seq as FASTA text files; width None keeps each sequence on one line."""
    seq = wrapped(F.col("seq"), width) if width else F.col("seq")
    sequences.select(F.concat(F.lit(">"), F.col("seq_id"), F.lit("\n"), seq).alias("value")).write.text(path)


def write_presence_absence(events: DataFrame, path: str) -> None:
    """presence_absence() events as FASTA: name:start..end and the bases on one line."""
    name = F.concat("name", F.lit(":"), F.col("start").cast("string"), F.lit(".."), F.col("end").cast("string"))
    write_fasta(events.select(name.alias("seq_id"), "seq"), path, None)
