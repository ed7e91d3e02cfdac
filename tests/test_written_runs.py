"""Runs of lines that writers must keep in one file of the folder."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from isoframe.plans.queries import QUERIES
from isoframe.sources import gtf, sam


@pytest.fixture()
def many_files(spark):
    """Small writes give as many files as large ones."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _transcripts(spark):
    exons = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.struct((F.col("id") * 1000 + i * 50 + 1).cast("int").alias("start"), (F.col("id") * 1000 + i * 50 + 20).cast("int").alias("end")))
    rows = spark.range(23).select(F.col("id").alias("ord"), F.concat(F.lit("t"), "id").alias("trans_id"), F.lit("g").alias("gene_id"), F.lit("chr1").alias("seqname"), F.lit(False).alias("is_rev"), exons.alias("exons"))
    return rows.selectExpr("*", "exons[0].start AS start", "exons[8].end AS end", "1 AS cov")


def test_gtf_transcripts_stay_whole(many_files, tmp_path):
    gtf.write(_transcripts(many_files), str(tmp_path / "out"), "mine")
    rows = gtf.read(many_files, str(tmp_path / "out")).collect()
    assert len({r.file for r in rows}) > 1
    assert sorted((r.trans_id, len(r.exons)) for r in rows) == sorted((f"t{k}", 9) for k in range(23))


def test_genes_keep_transcripts_whole(many_files, tmp_path):
    rows = _transcripts(many_files).withColumn("tid", F.lit(0)).withColumn("gene_id", F.concat(F.lit("g"), F.floor(F.col("ord") / 10)))
    gtf.write_genes(rows, str(tmp_path / "out"), "mine")
    assert sorted((r.trans_id, len(r.exons)) for r in gtf.read(many_files, str(tmp_path / "out")).collect()) == sorted((f"t{k}", 9) for k in range(23))


def test_sam_reads_stay_whole(many_files, tmp_path):
    rows = many_files.range(180).selectExpr("id AS ord", "concat('r', id div 9) AS qname", "0 AS flag", "'c1' AS chrom", "0 AS tid", "CAST(id AS INT) AS pos", "60 AS mapq", "'5M' AS cigar", "5 AS l_qseq", "0 AS nm", "CAST(NULL AS INT) AS as_score", "1 AS nh", "CAST(NULL AS STRING) AS xs")
    contigs = many_files.createDataFrame([("c1", 0, 1000)], "name string, tid int, length long")
    sam.write(rows, contigs, str(tmp_path / "out"))
    back = sam.read(many_files, str(tmp_path / "out"))
    assert back.select("file").distinct().count() > 1
    assert [r.n for r in back.groupBy("file", "qname").agg(F.count("*").alias("n")).collect()] == [9] * 20
    assert [r.pos for r in back.orderBy("ord").collect()] == list(range(180))


def test_gtf_odd_stays_whole(many_files):
    folder = "/root/testdata/sf0.001"
    odd = QUERIES["gtf_odd"](many_files, folder).collect()
    assert len(odd) == QUERIES["gtf_lines"](many_files, folder).where("row = 0").count()
