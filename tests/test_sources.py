from __future__ import annotations

import gzip
import random
import struct

import pytest

from isoframe.operators import select
from isoframe.operators.transcripts import from_alignments
from isoframe.sources import bam, gtf, placed, sam, tables
from isoframe.streaming import junctions as stream

GTF = """#comment
chr2\tsrc\tgene\t1\t900\t.\t-\t.\tgene_id "g1"; gene_name "G";
chr2\tsrc\ttranscript\t100\t400\t.\t-\t.\tgene_id "g1"; transcript_id "t1";
chr2\tsrc\texon\t300\t400\t.\t-\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G";
chr2\tsrc\texon\t100\t200\t.\t-\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G";
chr1\tsrc\ttranscript\t5\t9\t.\t+\t.\tgene_name "H"; transcript_name "u";
chr1\tsrc\texon\t5\t9\t.\t+\t.\tgene_name "H"; transcript_name "u"; exon_number 1
chr2\tsrc\texon\t700\t800\t.\t-\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G";
scaf\tsrc\ttranscript\t1\t2\t.\t+\t.\tgene_id "z"; transcript_id "z";
scaf\tsrc\texon\t1\t2\t.\t+\t.\tgene_id "z"; transcript_id "z";
"""
SAM = "@HD\tVN:1\n@SQ\tSN:c1\tLN:1000\n@SQ\tSN:c2\tLN:500\nr1\t16\tc2\t11\t60\t5M10N5M\t*\t0\t0\tACGTACGTAC\t*\tNM:i:1\tAS:i:7\tNH:i:1\tXS:A:+\nr2\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*\n"


def test_gtf(spark, tmp_path):
    (tmp_path / "a.gtf").write_text(GTF)
    path = str(tmp_path / "a.gtf")
    rows = gtf.read(spark, path).orderBy("ord").collect()
    assert [(r.trans_id, r.gene_id, r.gene_name, r.seqname, r.tid, r.is_rev, [tuple(e) for e in r.exons]) for r in rows] == [
        ("t1", "g1", "G", "chr2", 0, True, [(100, 200), (300, 400)]), ("u", "H", "H", "chr1", 1, False, [(5, 9)]),
        ("t1", "g1", "G", "chr2", 0, True, [(700, 800)]), ("z", "z", "z", "scaf", 2, False, [(1, 2)]),
    ]
    known = spark.createDataFrame([("chr1", 5)], "name string, tid int")
    assert {r.trans_id: r.tid for r in gtf.read(spark, path, known).collect()} == {"t1": -1, "u": 5, "z": -1}
    assert {r["name"]: r.tid for r in gtf.contigs(gtf.exon_rows(gtf.read_lines(spark, path)), known).collect()} == {"chr1": 5, "chr2": 6, "scaf": 7}
    order = [(r.seqname, r.start) for r in gtf.sorted_lines(gtf.read_lines(spark, path)).collect()]
    # The last exon of t1 follows chr1's transcript in the file.
    assert order == [("chr1", 5), ("chr1", 5), ("chr2", 700), ("chr2", 100), ("chr2", 300), ("chr2", 100), ("scaf", 1), ("scaf", 1)]


def test_gtf_round_trip(spark, tmp_path):
    (tmp_path / "a.gtf").write_text(GTF)
    rows = gtf.read(spark, str(tmp_path / "a.gtf"))
    gtf.write(rows.coalesce(1), str(tmp_path / "out"), "mine")
    again = gtf.read(spark, str(tmp_path / "out"))
    key = lambda f: sorted((r.trans_id, r.gene_id, r.seqname, r.is_rev, str(r.exons)) for r in f.collect())
    assert key(again) == key(rows)
    texts = [r.value for r in gtf.lines(rows, "mine").where("value LIKE '%t1%'").orderBy("ord", "row").collect()]
    assert texts[0] == 'chr2\tmine\ttranscript\t100\t400\t.\t-\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G"; transcript_name "t1"; transcript_cov "1";'
    assert [t.split("\t")[3] for t in texts[1:3]] == ["300", "100"]
    assert [r.value.split("\t")[3] for r in gtf.lines(rows, "mine", full=False).where("value LIKE '%t1%' AND row > 0").orderBy("ord", "row").collect()] == ["100", "300", "700"]


def test_missing_ids_are_an_error(spark, tmp_path):
    (tmp_path / "b.gtf").write_text('c\ts\texon\t1\t2\t.\t+\t.\tgene_id "g";\n')
    with pytest.raises(Exception, match="exon without transcript"):
        gtf.read(spark, str(tmp_path / "b.gtf")).collect()


def bam_bytes():
    def record(name, flag, tid, pos, ops, length, tags):
        body = struct.pack("<iiBBHHHiiii", tid, pos, len(name) + 1, 60, 0, len(ops), flag, length, -1, -1, 0) + name.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | bam.OPERATIONS.index(op)) for n, op in ops) + bytes((length + 1) // 2) + b"\xff" * length + tags
        return struct.pack("<i", len(body)) + body

    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 2)
    for name, n in ((b"c1\0", 1000), (b"c2\0", 500)):
        head += struct.pack("<i", len(name)) + name + struct.pack("<i", n)
    tags = b"NMC\1" + b"ASs" + struct.pack("<h", 7) + b"NHi" + struct.pack("<i", 1) + b"XSA+" + b"ZZZab\0" + b"BBBS" + struct.pack("<iHH", 2, 1, 2)
    return head + record("r1", 16, 1, 10, [(5, "M"), (10, "N"), (5, "M")], 10, tags) + record("r2", 4, -1, -1, [], 0, b"")


def test_sam_and_bam_agree(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    data = bam_bytes()
    # Blocks are members of one gzip file.
    (tmp_path / "a.bam").write_bytes(gzip.compress(data[:50]) + gzip.compress(data[50:]))
    spark.dataSource.register(bam.BamSource)
    one = sam.read(spark, str(tmp_path / "a.sam")).orderBy("ord").collect()
    two = spark.read.format("bam").load(str(tmp_path / "a.bam")).orderBy("ord").collect()
    for name in ("qname", "flag", "cigar", "l_qseq", "nm", "as_score", "nh", "xs"):
        assert [r[name] for r in one] == [r[name] for r in two], name
    assert (one[0].tid, one[0].pos, one[0].chrom) == (two[0].tid, two[0].pos, two[0].chrom) == (1, 10, "c2")
    rows = sam.read(spark, str(tmp_path / "a.sam"))
    assert select.filtered(rows).count() == 1
    assert [tuple(e) for e in from_alignments(rows).head().exons] == [(11, 15), (26, 30)]
    sam.write(rows.where("flag = 16"), sam.header(spark, str(tmp_path / "a.sam")), str(tmp_path / "out"))
    again = sam.read(spark, str(tmp_path / "out")).head()
    assert (again.qname, again.pos, again.tid, again.nm, again.xs, again.l_qseq) == ("r1", 10, 1, 1, "+", 10)


def test_tables(spark, tmp_path):
    (tmp_path / "sj").write_text("c1 10 20\t1 1 1 3 4 5\nc9\t1\t2\t0\t0\t0\t1\t0\t9\n")
    names = spark.createDataFrame([("c1", 0)], "name string, tid int")
    rows = tables.read_junctions(spark, str(tmp_path / "sj"), names).orderBy("don").collect()
    assert [(r.don, r.acc, r.uniq_c, r.max_over, r.tid) for r in rows] == [(1, 2, 1, 9, None), (10, 20, 3, 5, 0)]
    counted = spark.createDataFrame([("c1", 0, 10, 20, 1, 1, 1, 3, 4)], "chrom string, tid int, don int, acc int, strand int, motif int, is_anno int, uniq_c long, multi_c long")
    tables.write_junctions(counted, str(tmp_path / "out"))
    header = spark.read.text(str(tmp_path / "out")).where("value LIKE '#CHR%'").head().value
    assert header.split("\t") == ["#CHR", "START", "END", "STRAND", "ANNO", "UNIQ_C", "MULTI_C", "MOTIF"]
    assert tables.junctions_from_counts(counted).columns == [c.split()[0] for c in tables.JUNCTION.split(", ")]
    with gzip.open(tmp_path / "g.fa.gz", "wt") as f:
        f.write(">c1 some words\nACGT\nAC\n>c2\n\nGG\n>c3\n")
    assert [(r.name, r.comment, r.seq) for r in tables.read_fasta(spark, str(tmp_path / "g.fa.gz")).orderBy("ord").collect()] == [("c1", "some words", "ACGTAC"), ("c2", None, "GG"), ("c3", None, "")]
    (tmp_path / "r.fq").write_text("@a x\nAC\n+\n@@\n@b\nG\n+\nI\n")
    assert [(r.name, r.comment, r.seq, r.qual) for r in tables.read_fastq(spark, str(tmp_path / "r.fq")).orderBy("ord").collect()] == [("a", "x", "AC", "@@"), ("b", None, "G", "I")]
    assert tables.replicates("a,b:c") == [["a", "b"], ["c"]]
    assert tables.manifest("2 # long\na.fa,b.fa\nc.fa\n1\nx_1.fa x_2.fa\n") == {"long": [["a.fa", "b.fa"], ["c.fa"]], "short": [["x_1.fa", "x_2.fa"]]}
    assert tables.params_of({"aln_cov": 0.5, "full_level": 3, "other": 1}).min_coverage == 0.5
    (tmp_path / "config.yaml").write_text("# a run\ngenome:\n  fasta: x.fa\nfilter:\n  aln_cov: 0.5  # share\n  split_trans: true\n  sup_cnt: 2\nsite_distance: 3\n")
    made = tables.params_of(tables.read_settings(spark, str(tmp_path / "config.yaml")))
    assert (made.min_coverage, made.split, made.min_junction_count, made.site_distance) == (0.5, True, 2, 3)
    found = spark.createDataFrame([("q", 0, True, 1, 2, 0, False, 3, 4)], "qname string, left_tid int, left_is_rev boolean, left_ref_start int, left_ref_end int, right_tid int, right_is_rev boolean, right_ref_start int, right_ref_end int")
    tables.write_fusions(found, names, str(tmp_path / "fusions"))
    assert [r.value for r in spark.read.text(str(tmp_path / "fusions")).collect()] == ["#fusion_id\t1st_chr\t1st_strand\tst_start_site\t1st_end_site\t2nd_chr\t2nd_strand\t2nd_start_site\t2nd_end_site", "q\tc1\t-\t1\t2\tc1\t+\t3\t4"]
    exons = spark.createDataFrame([(0, 10, 20, "T", 3, True)], "tid int, start int, end int, kind string, score int, is_rev boolean")
    tables.write_bed(exons, names, str(tmp_path / "bed"))
    assert [r.value for r in spark.read.text(str(tmp_path / "bed")).collect()] == ["c1\t9\t20\tT_exon\t3\t-"]
    tables.write_table(exons, str(tmp_path / "tsv"), ["start"])
    assert spark.read.csv(str(tmp_path / "tsv"), sep="\t", header=True).count() == 1


def test_streamed_counts(spark, tmp_path):
    schema = "ord long, qname string, flag int, tid int, pos int, cigar string, nh int"
    for k in range(3):
        spark.createDataFrame([(k, "a", 2, 0, 10, "5M10N5M", 1 + k % 2)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    frames = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = stream.start(frames, "streamed_junctions", str(tmp_path / "at"))
    run.processAllAvailable()
    run.stop()
    assert [tuple(r) for r in spark.table("streamed_junctions").select("don", "acc", "uniq_c", "multi_c").collect()] == [(16, 25, 2, 1)]


def test_streamed_counts_survive_a_restart(spark, tmp_path):
    schema = "ord long, qname string, flag int, tid int, pos int, cigar string, nh int"
    for k in range(6):
        rows = [(10 * k + i, "a", 2, 0, 10 * (i % 3), "5M10N5M", 1 + (k + i) % 2) for i in range(8)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    frames = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, at = str(tmp_path / "out"), str(tmp_path / "at")
    run = stream.save(frames(), out, at)
    while run.lastProgress is None or run.lastProgress["batchId"] < 2:
        run.awaitTermination(0.2)
    run.stop()
    seen = len(list((tmp_path / "out").glob("batch=*")))
    # As if the run had ended after a batch was written, before it was noted.
    last = max((tmp_path / "at" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run = stream.save(frames(), out, at)
    run.processAllAvailable()
    run.stop()
    assert seen >= 3 and len(list((tmp_path / "out").glob("batch=*"))) >= 6
    key = ["tid", "don", "acc", "strand", "uniq_c", "multi_c"]
    want = sorted(tuple(r) for r in stream.counts(spark.read.parquet(str(tmp_path / "in"))).select(key).collect())
    assert sorted(tuple(r) for r in stream.totals(spark, out).select(key).collect()) == want and sum(r[4] + r[5] for r in want) == 48
    stream.compact(spark, out, str(tmp_path / "one"))
    assert sorted(tuple(r) for r in stream.totals(spark, str(tmp_path / "one")).select(key).collect()) == want


def test_regions_read_the_files_they_need(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, f"r{i}", rng.choice([0, 16, 4]), rng.randrange(-1, 3), rng.randrange(0, 400_000), rng.choice(["50M", "10M90000N10M", "5S20M"])) for i in range(800)]
    records = spark.createDataFrame(rows, "ord long, qname string, flag int, tid int, pos int, cigar string")
    path = str(tmp_path / "placed")
    placed.write(records, path, 12)
    size = {"50M": 50, "10M90000N10M": 90020, "5S20M": 20}
    few = 0
    for tid, start, end in ((0, 0, 10), (1, 100_000, 100_500), (2, 390_000, 600_000), (1, 0, 10**6), (7, 0, 10)):
        want = [r[0] for r in rows if r[2] != 4 and r[3] == tid and r[4] <= end and r[4] + size[r[5]] - 1 >= start]
        assert sorted(r.ord for r in placed.region(spark, path, tid, start, end).collect()) == want
        few += len(placed.files(spark, path, tid, start, end)) < 12
    assert few >= 4 and len(placed.files(spark, path, 0, 0, 10)) <= 3
    placed_and_not = spark.read.parquet(f"{path}/records").count() + spark.read.parquet(f"{path}/unplaced").count()
    assert placed_and_not == 800


def test_genome_in_chunks(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    for chunk in (4, 7, 4096):
        monkeypatch.setattr(tables, "CHUNK", chunk)
        sequences = {f"c{k}": "".join(rng.choice("ACGTacgt") for _ in range(rng.choice([1, 5, 8, 60]))) for k in range(6)}
        text = "; no record\n" if chunk == 7 else ""
        for name, bases in sequences.items():
            width = rng.choice([1, 3, 10, 100])
            text += f">{name} some\n" + "\n".join(bases[i : i + width] for i in range(0, len(bases), width)) + rng.choice(["\n", "\n\n", "\r\n"])
        file = tmp_path / f"{chunk}.fa"
        file.write_text(text)
        got = {(r.chrom, r.chunk): r.bases for r in tables.genome(spark, str(file)).collect()}
        want = {(name, k): bases[k * chunk : (k + 1) * chunk + 1] for name, bases in sequences.items() for k in range(-(-len(bases) // chunk))}
        # A last base alone is also in the chunk before, as the one that follows.
        assert got == want


def test_junction_files_carry_their_legends(spark, tmp_path):
    counted = spark.createDataFrame([("c2", 1, 5, 9, 2, 2, 1, 3, 4), ("c1", 0, 10, 20, 1, 1, 1, 3, 4)], "chrom string, tid int, don int, acc int, strand int, motif int, is_anno int, uniq_c long, multi_c long")
    tables.write_junctions(counted, str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines[:4]) == sorted(tables.JUNCTION_HEAD) and len(lines) == 6
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.splitlines() == [*tables.JUNCTION_HEAD, "c1\t10\t20\t1\t1\t3\t4\t1", "c2\t5\t9\t2\t1\t3\t4\t2"]


def test_genes_as_text(spark, tmp_path):
    (tmp_path / "a.gtf").write_text(GTF)
    gtf.write_genes(gtf.read(spark, str(tmp_path / "a.gtf")), str(tmp_path / "out"), "mine")
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).splitlines()
    assert lines[0] == 'chr2\tmine\tgene\t100\t800\t.\t-\t.\tgene_id "g1"; gene_name "G";'
    assert [x.split("\t")[2:6] for x in lines[:6]] == [["gene", "100", "800", "."], ["transcript", "100", "400", "."], ["exon", "300", "400", "0"], ["exon", "100", "200", "0"], ["transcript", "700", "800", "."], ["exon", "700", "800", "0"]]
    assert [x.split("\t")[2] for x in lines].count("gene") == 3
