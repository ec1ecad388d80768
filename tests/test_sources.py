"""Files in and out, and resumable streams."""

import bz2
import gzip
import lzma

import pytest
from pyspark.sql import functions as F

from genoframe.functions.alignments import locus
from genoframe.sources import fasta, sinks, tables
from genoframe.streaming.resume import reasons_so_far, work_through

PAF = "Zm_chr1\t1000000\t0\t31\t+\tSb_chr1\t1000000\t0\t32\t25\t34\t60\tNM:i:9\ttp:A:P\tde:f:0.1935\tcg:Z:16M2I4M3D9M\tcs:Z::10*ag:5+ac*ct:3-ttt*ac:7*nn"


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_paf(spark, tmp_path):
    path = put(tmp_path, "a.paf", PAF + "\nshort\t1\n" + PAF.replace("\t31\t", "\tx\t") + "\n")
    r = tables.read_paf(spark, path).collect()
    assert len(r) == 1 and r[0].de == 0.1935 and r[0].tags["tp:A"] == "P" and r[0].cg.startswith("16M")
    assert tables.read_paf(spark, path, min_len=32).count() == 1
    assert tables.read_paf(spark, path, min_len=32, both_sides=True).count() == 0
    line = tables.read_paf(spark, path).select(sinks.paf_line(F.lit("abc")).alias("x")).collect()[0].x.split("\t")
    assert len(line) == 25 and line[20] == "de:f:0.1935" and line[-1] == "sd:Z:abc" and line[12] == "NM:i:9"


def test_anchors(spark, tmp_path):
    path = put(tmp_path, "a.anchors", "###\na b 10\nc d\n###\n###\ne f\n")
    found = [(r.block_id, r.gene1, r.gene2) for r in tables.read_anchors(spark, path).orderBy("ord").collect()]
    assert found == [(1, "a", "b"), (1, "c", "d"), (2, "e", "f")]
    assert tables.read_anchors(spark, path, exact=True).count() == 2


def test_coords(spark, tmp_path):
    path = put(tmp_path, "c.tsv", "Zm_chr1:0..900\tSb_chr1:870..50\t+\t1\nbad\tx\t+\n")
    r = tables.read_coords(spark, path, clamp=True, order=True).collect()
    assert [(x.t, x.t_start, x.t_end, x.q_start, x.q_end, x.block) for x in r] == [("Zm_chr1", 1, 900, 50, 870, "1")]
    assert tuple(spark.range(1).select(locus(F.lit("a:b:3..4")).alias("l")).collect()[0].l) == ("a:b", 3, 4)


def test_beds_and_index(spark, tmp_path):
    fai = put(tmp_path, "x.fai", "c1\t100\t0\t60\t61\nshort\n")
    assert [tuple(r) for r in tables.read_fai(spark, fai).collect()] == [("c1", 100)]
    bed = put(tmp_path, "x.bed", "c1\t0\t9\tde:f:0.01\nc1\tx\t1\t8\tde:f:0.2\ty\nc1\t1\n")
    assert sorted(tuple(r) for r in tables.read_scored_bed(spark, bed).collect()) == [("c1", 0, 9, "de:f:0.01"), ("c1", 1, 8, "de:f:0.2")]
    assert [r.de for r in tables.read_identity_bed(spark, put(tmp_path, "y.bed", "c\t1\t5\ta:0.5\nc\t1\t5\t1e-3\n")).collect()] == [0.5, None]
    genes = put(tmp_path, "g.bed", "track x\nc\t1\t5\tg1\t0\t+\n#x\n")
    assert [(r.gene, r.strand) for r in tables.read_genes(spark, genes).collect()] == [("g1", "+")]


def test_vcf_and_rates(spark, tmp_path):
    v, c = tables.read_vcf(spark, put(tmp_path, "v.vcf", "##contig=<ID=c1,length=50>\n#CHROM\tPOS\nc1\t7\t.\n"))
    assert [tuple(r) for r in v.collect()] == [("c1", 7)] and [tuple(r) for r in c.collect()] == [("c1", 50)]
    head = put(tmp_path, "k1", "Sequence\tMethod\tKa\tKs\na-b\tx\t0.1\t0.5\nc-d\tx\t0.1\tNA\n")
    assert sorted((r.pair, r.ks) for r in tables.read_ks(spark, head).where("ks is not null").collect()) == [("a-b", 0.5)]
    (tmp_path / "many").mkdir()
    rest = "\t9.5" * 18
    put(tmp_path, "many/a", "Sequence\tMethod\tKa\tx\tKs\na-b\tYN\t0.1\t8.0\t0.5\nSequence\tMethod\tKa\tx\tKs\na-c\tYN\t0.1\t8.0\t0.6\n")
    put(tmp_path, "many/b", f"b-c\tYN\t0.1\t0.7{rest}\nb-d\tYN\t0.1\tNA{rest}\n")
    put(tmp_path, "many/c", "Sequence\tKs\tKa\nc-d\t0.9\t0.1\n")
    found = tables.read_ks(spark, str(tmp_path / "many")).collect()
    assert sorted((r.pair, r.ks) for r in found if r.ks) == [("a-b", 0.5), ("a-c", 0.6), ("b-c", 0.7), ("c-d", 0.9)] and len(found) == 5
    put(tmp_path, "many/d", "d-e\tYN\t0.1\t0.7\n")
    with pytest.raises(Exception, match="known number of columns"):
        tables.read_ks(spark, str(tmp_path / "many")).collect()


def test_gff_and_maf(spark, tmp_path):
    gff = put(tmp_path, "g.gff", "##STA\tMKV*\n##ATN\tat~gg~A-TG\nc\tm\tmRNA\t1\t9\t.\t+\t.\tID=x;Target=p 1 3\n")
    r = tables.read_gff(spark, gff).collect()[0]
    assert (r.type, r.start, r.attrs["Target"], r.sta, r.atn) == ("mRNA", 1, "p 1 3", "MKV*", "ATG")
    maf = put(tmp_path, "m.maf", "a score=1\ns t 0 4 + 10 AC-GT\ns q 2 5 - 20 ACTGT\n\n")
    r = tables.maf_of(__import__("genoframe.sources.text", fromlist=["lines"]).lines(spark, maf)).collect()[0]
    assert (r.t.name, r.q.strand, r.q.text) == ("t", "-", "ACTGT")


def test_fasta(spark, tmp_path):
    text = ">a one\nACG\nT\n>b\nTT\n>a one\nGG\n"
    for name, pack in (("x.fa", bytes), ("x.fa.gz", gzip.compress), ("x.fa.bz2", bz2.compress), ("x.fa.xz", lzma.compress)):
        (tmp_path / name).write_bytes(pack(text.encode()))
        found = {r.seq_id: r.seq for r in fasta.read_fasta(spark, str(tmp_path / name)).collect()}
        assert found == {"a": "GG", "b": "TT"}
    seqs = fasta.read_fasta(spark, str(tmp_path / "x.fa"))
    assert {r.chrom: r.len for r in fasta.index_of(seqs).collect()} == {"a": 2, "b": 2}
    fasta.write_fasta(spark.createDataFrame([("s", "A" * 130)], "seq_id string, seq string").coalesce(1), str(tmp_path / "out"))
    lines = next(tmp_path.glob("out/part*")).read_text().splitlines()
    assert [len(x) for x in lines] == [2, 60, 60, 10]


def test_stream_works_each_segment_once(spark, tmp_path):
    put_rows = lambda ids: spark.createDataFrame([(i,) for i in ids], "segment_id long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put_rows([1, 2, 2])
    go = lambda: work_through(spark.readStream.schema("segment_id long").parquet(str(tmp_path / "in")), lambda b: b.withColumn("x", F.col("segment_id") * 10), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    go()
    put_rows([2, 3])
    go()
    assert sorted(r.x for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [10, 20, 30]
    stream = spark.readStream.schema("segment_id long").parquet(str(tmp_path / "in")).select((F.col("segment_id") % 2).cast("string").alias("reason"))
    q = reasons_so_far(stream).writeStream.format("memory").queryName("reasons").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.reason: r.n for r in spark.table("reasons").collect()} == {"0": 3, "1": 2}
