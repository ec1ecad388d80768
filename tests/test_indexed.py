"""The indexed FASTA source against slices of Python strings."""

import random
import struct
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from genoframe.sources import indexed
from genoframe.sources.fasta import read_fasta, slices


def some(n=7, seed=3):
    rng = random.Random(seed)
    return {f"s{i}": "".join(rng.choice("ACGTN") for _ in range(rng.choice([1, 59, 60, 61, 500, 2000]))) for i in range(n)}


def frame(spark, seqs):
    return spark.createDataFrame(list(seqs.items()), "seq_id string, seq string")


def blocked(data, size, at):
    """data as bgzip members of `size` bytes, with their index."""
    out, index = b"", []
    for i in range(0, len(data), size):
        if i:
            index.append((len(out), i))
        member = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += member.compress(data[i : i + size]) + member.flush()
    Path(at).write_bytes(out)
    Path(f"{at}.gzi").write_bytes(struct.pack("<Q", len(index)) + b"".join(struct.pack("<QQ", *x) for x in index))


def whole(chunks):
    found = {}
    for r in sorted(chunks.collect(), key=lambda r: (r.seq_id, r.start)):
        assert r.first == r.start and r.end - r.start == len(r.bases)
        assert len(found.get(r.seq_id, "")) == r.start
        found[r.seq_id] = found.get(r.seq_id, "") + r.bases
    return found


@pytest.mark.parametrize("width", [60, 7, 0])
def test_written_and_read(spark, tmp_path, width):
    seqs = some()
    path = str(tmp_path / "out")
    indexed.write_indexed(frame(spark, {"old": "A"}), path)
    indexed.write_indexed(frame(spark, seqs).repartition(3), path, width)
    assert whole(indexed.read_chunks(spark, path, 100, 300)) == seqs
    assert {r.seq_id: r.seq for r in read_fasta(spark, f"{path}/*.fa").collect()} == seqs
    assert not [f for f in Path(path).iterdir() if f.suffix not in (".fa", ".fai")]


def test_filters_leave_out_chunks(spark, tmp_path):
    seqs = {f"s{i}": "".join(random.Random(i).choice("ACGT") for _ in range(5000)) for i in range(5)}
    path = str(tmp_path / "out")
    indexed.write_indexed(frame(spark, seqs), path)
    chunks = indexed.read_chunks(spark, path, 100)
    rows = chunks.where("seq_id in ('s1', 's3', 'zz') and start >= 250 and start < 1000 and end > 300").collect()
    assert {(r.seq_id, r.start) for r in rows} == {(s, k) for s in ("s1", "s3") for k in range(300, 1000, 100)}
    assert all(r.bases == seqs[r.seq_id][r.start : r.end] for r in rows)
    reader = indexed.IndexedFastaReader(path, 100, 1000, 0)
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan

    assert len(list(reader.pushFilters([EqualTo(("seq_id",), "s2"), GreaterThan(("end",), 950), LessThan(("start",), 1300)]))) == 3
    assert [(r.entry.name, r.first, r.last) for p in reader.partitions() for r in p.runs] == [("s2", 9, 13)]
    assert chunks.where("seq_id = 'none'").count() == 0
    assert chunks.where("start = 200").count() == 5


def test_bases_around(spark, tmp_path):
    seqs = some(4, 8)
    indexed.write_indexed(frame(spark, seqs), str(tmp_path / "out"))
    for r in indexed.read_chunks(spark, str(tmp_path / "out"), 100, around=30).collect():
        assert r.first == max(0, r.start - 30) and r.bases == seqs[r.seq_id][r.first : r.end + 30]


@pytest.mark.parametrize("size", [64, 1000, 10**6])
def test_bgzip_blocks(spark, tmp_path, size):
    seqs = some()
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    indexed.write_indexed(frame(spark, seqs).coalesce(1), str(plain))
    (name,) = [f for f in plain.iterdir() if f.suffix == ".fa"]
    packed.mkdir()
    blocked(name.read_bytes(), size, packed / "a.fa.gz")
    (packed / "a.fa.gz.fai").write_bytes(Path(f"{name}.fai").read_bytes())
    assert whole(indexed.read_chunks(spark, str(packed), 100)) == seqs
    assert whole(indexed.read_chunks(spark, str(packed / "a.fa.gz"), 333)) == seqs


def test_index_of_a_plain_file(spark, tmp_path, monkeypatch):
    seqs = some(9, 5) | {"empty": ""}
    text = "".join(f">{n} more words\r\n" + "".join(f"{s[i : i + 50]}\r\n" for i in range(0, len(s), 50)) for n, s in seqs.items())
    (tmp_path / "a.fa").write_text(text, newline="")
    (tmp_path / "b.fa").write_text(">one\n" + "ACGT" * 100 + "\n>two\nAC\nGT\nA")
    for size in (97, 1 << 26):
        monkeypatch.setattr(indexed, "RANGE_BYTES", size)
        for fai in tmp_path.glob("*.fai"):
            fai.rename(fai.with_suffix(".old"))
            fai.with_suffix(".old").rename(tmp_path.parent / f"{tmp_path.name}-{size}-{fai.name}")
        found = indexed.make_index(spark, str(tmp_path)).collect()
        assert {r.seq_id: r.length for r in found} == {n: len(s) for n, s in seqs.items()} | {"one": 400, "two": 5}
        read = whole(indexed.read_chunks(spark, str(tmp_path), 64))
        assert read == {n: s for n, s in seqs.items() if s} | {"one": "ACGT" * 100, "two": "ACGTA"}
    (tmp_path / "c.fa").write_text(">odd\nACGT\nAC\nACGT\n")
    with pytest.raises(Exception, match="different length"):
        indexed.make_index(spark, str(tmp_path / "c.fa"))


def test_slices(spark, tmp_path):
    seqs = some(5, 2)
    rng = random.Random(6)
    rows = [(n, a, a + rng.randrange(1, 700), rng.choice("+-")) for n in seqs for a in (rng.randrange(0, len(seqs[n])) for _ in range(20))]
    rows += [rows[0], ("s1", 5, 5, "+"), ("s1", 10**6, 10**6 + 5, "+"), ("none", 0, 5, "-"), (None, 0, 5, "+")]
    asked = spark.createDataFrame(rows, "seq_id string, start long, end long, strand string")
    turn = str.maketrans("ACGT", "TGCA")

    def cut(n, a, b, strand):
        part = seqs.get(n, "")[a:b]
        return (part if strand == "+" else part[::-1].translate(turn)) or None

    want = sorted((str(r[0]), *r[1:], cut(*r) or "") for r in rows)
    got = lambda df: sorted((str(r.seq_id), r.start, r.end, r.strand, r.seq or "") for r in df.collect())
    assert got(slices(asked, frame(spark, seqs), "strand", 64)) == want
    assert got(slices(asked, frame(spark, seqs), "strand")) == want
    indexed.write_indexed(frame(spark, seqs), str(tmp_path / "x"))
    assert got(indexed.read_slices(spark, asked, str(tmp_path / "x"), "strand", 128)) == want
    assert slices(asked.withColumn("strand", F.lit("+")).limit(0), frame(spark, seqs)).count() == 0
