"""Readers, checks and helpers that no query of the tables at hand needs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from genoframe import scratch
from genoframe.functions import alignments as A
from genoframe.functions import names
from genoframe.operators import assembly, components, divergence, scene, sets, variants, windows
from genoframe.sources import fasta, sinks, tables
from genoframe.sources.text import carried, counted, lines
from genoframe.streaming.resume import job_stream, work_through


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_lines_in_many_splits(spark, tmp_path):
    text = "".join(f">r{k // 7}\n" if k % 7 == 0 else f"ACGT{k}\n" for k in range(400))
    path = put(tmp_path, "a.fa", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        found = counted(carried(lines(spark, path), F.when(F.col("line").startswith(">"), F.col("line")), "head"), F.col("line").startswith(">"), "n")
        got = found.orderBy("line_no").collect()
        assert len({r.split for r in got}) > 3
        want, head, n = [], None, 0
        for line in text.splitlines():
            head, n = (line, n + 1) if line.startswith(">") else (head, n)
            want.append((line, head, n))
        assert [(r.line, r["head"], r.n) for r in got] == want
        seqs = fasta.read_fasta(spark, path).orderBy("ord").collect()
        assert [r.seq_id for r in seqs] == [f"r{k}" for k in range(58)]
        assert seqs[1].seq == "".join(f"ACGT{k}" for k in range(8, 14))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sequences_and_indexes(spark, tmp_path):
    path = put(tmp_path, "a.fa", ">x one\nAC\nGT\n>y\nA\n")
    assert rows(fasta.first_record(fasta.read_fasta(spark, path)), "seq_id", "seq") == [("x", "ACGT")]
    assert rows(fasta.records(spark, path), "n") == [(2,)]
    assert rows(fasta.read_or_make_index(spark, path), "chrom", "len") == [("x", 4), ("y", 1)]
    put(tmp_path, "a.fa.fai", "x\t99\n")
    assert rows(fasta.read_or_make_index(spark, path), "chrom", "len") == [("x", 99)]


def test_genes_that_may_be_missing(spark, tmp_path):
    with pytest.warns(UserWarning):
        assert tables.read_genes_if_there(spark, str(tmp_path / "none.bed")).count() == 0
    assert tables.read_genes_if_there(spark, put(tmp_path, "g.bed", "c\t1\t5\tg1\t0\t+\n")).count() == 1


def test_matrices_and_keys(spark, tmp_path):
    want = [("A", "A", 0.0), ("A", "B", 0.5), ("B", "A", 0.5), ("B", "B", 0.0)]
    for head in ("\tA\tB", "A\tB", "i\tA\tB"):
        assert rows(tables.read_matrix(spark, put(tmp_path, f"m{len(head)}{head[0] == 'i'}", f"{head}\nA\t0\t0.5\nB\t0.5\t0\n")), "i", "j", "d") == want
    assert rows(tables.read_name_key(spark, put(tmp_path, "key", "A\tmaize\nB\trice\n")), "name", "label") == [("A", "maize"), ("B", "rice")]


def test_genome_ids_by_precedence(spark, tmp_path):
    at = str(tmp_path)
    assert tables.read_genome_ids(spark, at).count() == 0
    put(tmp_path, "Os_mod.fa", ">x\n")
    assert rows(tables.read_genome_ids(spark, at), "genome") == [("Os",)]
    put(tmp_path, "jcvi_list.txt", "Zm Sb\nZm\tOs.1\n")
    assert rows(tables.read_genome_ids(spark, at), "genome") == [("Os.1",), ("Sb",), ("Zm",)]
    put(tmp_path, "genome_list.txt", "\n")
    assert tables.read_genome_ids(spark, at).count() == 3
    put(tmp_path, "genome_list.txt", "Zm\n\nSb\n")
    assert rows(tables.read_genome_ids(spark, at), "genome") == [("Sb",), ("Zm",)]


def test_reports_sizes_and_means(spark, tmp_path):
    put(tmp_path, "Sb.report", "chromosome\tavg\nc1\t0.5\nWholeGenome\t0.4\n")
    reports = tables.read_reports(spark, str(tmp_path / "*.report"))
    assert rows(reports, "accession", "chrom", "value") == [("Sb", "WholeGenome", 0.4), ("Sb", "c1", 0.5)]
    wide = spark.createDataFrame([("c1", 0, 9, "Sb", 0.1), ("c2", 0, 9, "Sb", 0.2), ("c1", 0, 9, "Os", 0.3)], "chrom string, start long, end long, id string, avg_de double")
    assert rows(tables.with_means(wide, reports), "id", "chrom", "mean") == [("Os", "c1", None), ("Sb", "c1", 0.5), ("Sb", "c2", None)]
    assert windows.merge_windows(wide).columns == ["chrom", "start", "end", "Os", "Sb"]
    put(tmp_path, "Zm.Sb.bed.aln.size", "123\n")
    assert rows(tables.read_sizes(spark, str(tmp_path / "*.bed.aln.size")), "id1", "id2", "size") == [("Zm", "Sb", 123)]


def test_tags_written_without_a_tab(spark, tmp_path):
    line = "q\t9\t0\t9\t+\tt\t9\t0\t9\t9\t9\t60\tde:f:0.0123rl:i:5\n"
    found = tables.read_paf(spark, put(tmp_path, "a.paf", line + line.replace("rl:i:5", "").replace("0.0123", "1e-3"))).collect()
    assert sorted(r.de for r in found) == [0.001, 0.0123]


def test_preflight_and_pairs(spark):
    genomes = spark.createDataFrame([("a", "x/a.fa.gz"), ("b", "b.FASTA"), ("b", "c.fa"), ("", "d.fa"), ("e", "e.zip"), ("f", None)], "id string, path string")
    assert rows(sets.preflight(genomes), "id", "problem") == [("", "no id"), ("b", "id comes twice"), ("e", "unknown kind of file"), ("f", "unknown kind of file")]
    cds = spark.createDataFrame([("p2", "ATG"), ("p1", "ATC")], "id string, cds string")
    pep = spark.createDataFrame([(1, "p1", "I"), (2, "p3", "X"), (3, "p2", "M")], "ord int, id string, protein string")
    pairs, missing = sets.with_proteins(cds, pep)
    assert [r.id for r in pairs.collect()] == ["p1", "p2"] and rows(missing, "id") == [("p3",)]


def test_chromosomes_by_wish_and_names_that_fit(spark):
    fai = spark.createDataFrame([("chr1", 100), ("chr2", 10), ("sca1", 50)], "chrom string, len long")
    assert rows(assembly.chromosomes(fai, pattern="^chr"), "chrom", "rule") == [("chr1", "pattern"), ("chr2", "pattern")]
    assert rows(assembly.chromosomes(fai, min_len=50), "chrom", "rule") == [("chr1", "min-length"), ("sca1", "min-length")]
    headers = spark.createDataFrame([(1, "contig1"), (2, "contig2")], "ord long, header string")
    assert [tuple(r) for r in assembly.survives(headers, "Zm").collect()] == [(2, 0, True)]
    assert [r.ok for r in assembly.survives(headers, "averylongstem").collect()] == [False]
    assert [r.ok for r in assembly.survives(headers.unionByName(spark.createDataFrame([(3, "Chr01")], headers.schema)), "averylongstem").collect()] == [True]
    scaffolds = spark.createDataFrame([(k, f"h{k}", k % 5) for k in range(200)], "ord long, header string, length long")
    found = assembly.name_scaffolds(scaffolds, "Zm", 8).collect()
    assert len(found) == 99 and {r.new for r in found} == {f"Zm_sca{k}" for k in range(1, 100)}
    assert next(r.header for r in found if r.new == "Zm_sca1") == "h4"
    assert [r.number for r in assembly.numbered(headers, ["ord"], "TE").orderBy("ord").collect()] == ["TE1", "TE2"]
    assert [r.letters for r in assembly.lettered(headers, "ord").orderBy("ord").collect()] == ["A", "B"]


def test_cut_of_equal_lengths_and_large_assemblies(spark):
    lengths = [1000] * 5 + [990] * 5 + [1] * 3000
    fai = spark.createDataFrame([(f"s{k}x{'a' * (k % 2)}", n) for k, n in enumerate(lengths)], "chrom string, len long")
    found = assembly.chromosomes(fai).collect()
    assert len(found) == 10 and {r.rule for r in found} == {"length-cliff"} and min(r.len for r in found) == 990


def test_scene_helpers(spark, tmp_path):
    few = spark.createDataFrame([(k, f"n{k:02d}") for k in range(8)], "ord long, name string")
    many = spark.createDataFrame([(k, f"n{k:02d}") for k in range(23)], "ord long, name string")
    assert [r.colour for r in scene.palette(few, "name").orderBy("ord").collect()] == list(scene.PALETTE)
    assert [r.colour for r in scene.palette(many, "name").orderBy("ord").collect()] == [*scene.CYCLE, *scene.CYCLE[:3]]
    bars = spark.createDataFrame([(25_000_000,), (2_100_000_000,), (90_000_000_000,)], "b long").select(scene.scale_bar(F.col("b")).alias("s"))
    assert [(r.s.label, round(r.s.share, 4)) for r in bars.collect()] == [("5 Mb", 0.2), ("500 Mb", 0.2381), ("1 Gb", 0.0111)]
    blocks = spark.createDataFrame([(1, "a", 0, 9, "x", 0, 9), (2, "b", 0, 9, "x", 0, 9), (3, "a", 0, 3, "x", 0, 9)], "id long, ca string, sa long, ea long, cb string, sb long, eb long")
    one = lambda n: spark.createDataFrame([(n,)], "chrom string")
    assert rows(scene.on_chromosomes(blocks, one("a"), one("x"), 5), "id") == [(1,)]
    order = scene.track_order(spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "chrom string, ord int"), spark.createDataFrame([("z", 1.0), ("x", 5.0)], "cb string, anchor double"))
    assert rows(order, "place", "chrom") == [(1, "z"), (2, "x"), (3, "y")]
    scene.write_svg(spark.createDataFrame([(1, "M0,0 Z"), (2, "M1,1 Z")], "id long, path string"), str(tmp_path / "svg"), 100.0, 50.0)
    text = next((tmp_path / "svg").glob("part*")).read_text().splitlines()
    assert text[0].startswith("<svg") and text[-1] == "</svg>" and [x.split('"')[1] for x in text[1:-1]] == ["M0,0 Z", "M1,1 Z"]


def test_ids_and_genomes(spark):
    df = spark.createDataFrame([("a:1..2", "b:3..4", "+"), (None, "x", "-")], "a string, b string, s string")
    found = [r.i for r in df.select(A.stored_segment_id(F.col("a"), F.col("b"), F.col("s")).alias("i")).collect()]
    assert found == [hashlib.blake2b(b"a:1..2|b:3..4|+", digest_size=6).hexdigest(), None]
    known = spark.createDataFrame([("c1", "Zm"), ("c1", "Zm"), ("c2", "Sb")], "chrom string, genome string")
    asked = spark.createDataFrame([("c1",), ("c3",)], "n string")
    assert rows(names.unique_genome_of(asked, "n", known, "g"), "n", "g") == [("c1", "Zm"), ("c3", None)]
    with pytest.raises(Exception, match="several genomes"):
        names.unique_genome_of(asked, "n", known.unionByName(spark.createDataFrame([("c1", "Os")], known.schema)), "g").collect()
    coords = spark.createDataFrame([("Zm_1", "Sb_1")], "t string, q string")
    assert rows(tables.between_two_genomes(coords, ["Zm", "Sb"]), "t_genome", "q_genome") == [("Zm", "Sb")]
    with pytest.raises(Exception, match="one genome"):
        tables.between_two_genomes(spark.createDataFrame([("Zm_1", "Zm_2")], "t string, q string"), ["Zm"]).collect()


def test_small_relations(spark, tmp_path):
    blocks = spark.createDataFrame([(3,), (1,)], "n_records long")
    assert rows(divergence.records_per_block(blocks), "blocks", "records", "per_block") == [(2, 4, 2.0)]
    paf = spark.createDataFrame([("c", 0, 5, 0.1), ("c", 5, 9, None)], "t_name string, t_start long, t_end long, de double")
    assert rows(divergence.identity_bed(paf), "chrom", "start", "end", "de") == [("c", 0, 5, 0.1)]
    numbers = spark.createDataFrame([("a:0.25", 0.125, 4, 2), ("0.5", -0.0001, 0, 3)], "f string, x double, a long, b long")
    assert [tuple(r) for r in numbers.select(A.divergence_of(F.col("f")), sinks.decimals(F.col("x"), 2), A.length_ratio(F.col("a"), F.col("b"))).collect()] == [(0.25, "0.12", 2.0), (0.5, "0.00", None)]
    bed = spark.createDataFrame([("Os", "c", 1), ("Sb", "c", 2)], "other string, chrom string, start long")
    sinks.write_by_genome(bed, str(tmp_path / "beds"))
    assert {p.name for p in (tmp_path / "beds").iterdir() if p.is_dir()} == {"other=Os", "other=Sb"}
    tags = spark.createDataFrame([({"tp:A": "P"},)], "t map<string,string>")
    assert tags.select(A.tag(F.col("t"), "tp:A").alias("x")).collect()[0].x == "P"
    events = spark.createDataFrame([("a", "b"), ("a", "a")], "q_name string, t_name string")
    assert sorted(r.chrom for r in variants.by_either_name(events).collect()) == ["a", "a", "b"]


def test_annotations_near_indels(spark, tmp_path):
    from genoframe.operators.intervals import near_join, prefixed

    path = put(tmp_path, "a.gff", "c\tm\tgene\t101\t200\t.\t+\t.\tID=g\nc\tm\tgene\tx\t200\t.\t+\t.\tID=bad\n")
    indels = spark.createDataFrame([("c", 95, 203, 1), ("c", 80, 203, 2), ("d", 95, 203, 3)], "chrom string, start long, end long, id long")
    found = near_join(indels, prefixed(tables.read_annotations(spark, path)), ["chrom"], 10)
    assert rows(found, "id", "r_type") == [(1, "gene")]


def test_jobs_stream(spark, tmp_path):
    from genoframe.functions.align import align_pairs

    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "a", "s1\tACGT\tACCT\nbad line\ns2\tAAAA\tAAA\n")
    work_through(job_stream(spark, str(tmp_path / "in")), lambda b: align_pairs(b).select("segment_id", "aln.cs", "aln.edits"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "segment_id", "edits") == [("s1", 1), ("s2", 1)]


def test_components_and_scratch(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (5, 5), (None, 1)], "a long, b long")
    assert rows(components.connected_components(links, "a", "b"), "node", "root") == [(2, 1), (3, 1), (8, 7)]
    path = scratch.new_path(spark, "x")
    assert path.startswith(scratch.own_folder(spark)) and path != scratch.new_path(spark, "x")
    assert scratch.written(spark.range(5)).count() == 5
