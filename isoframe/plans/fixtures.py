"""Fixture tables made from the star-schema tables.

The same SQL runs on Spark and on DuckDB.  ``exons`` holds annotation and read
transcripts, ``junctions`` short-read splice junctions, ``alignments`` records
grouped by read, and ``segments`` the parts of split alignments.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FX_EXON = """
SELECT ok, gene, CAST(gene % 25 AS INT) AS tid,
       CASE WHEN ok % 10 = 0 THEN 'anno' ELSE 'read' END AS kind,
       CASE WHEN gene % 2 = 0 THEN 0 ELSE 1 END AS is_rev,
       CAST(floor(gene / 25) * 10000 + slot * 500 + 1 + j1 AS INT) AS es,
       CAST(floor(gene / 25) * 10000 + slot * 500 + 200 + j2 AS INT) AS ee
FROM (SELECT o_orderkey AS ok, o_custkey % 600 AS gene, l_partkey % 10 AS slot,
             MIN(CASE WHEN l_suppkey % 4 = 0 THEN l_suppkey % 3 ELSE 0 END) AS j1,
             MIN(CASE WHEN l_suppkey % 5 = 0 THEN 7 ELSE 0 END) AS j2
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      GROUP BY o_orderkey, o_custkey % 600, l_partkey % 10) b
"""

FX_SJ = """
SELECT tid, don, acc, CAST(SUM(CASE WHEN ok % 4 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS uniq_c,
       CAST(SUM(CASE WHEN ok % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS multi_c
FROM (SELECT ok, tid, ee + 1 AS don, LEAD(es) OVER (PARTITION BY ok ORDER BY es) - 1 AS acc FROM fx_exon WHERE ok % 3 = 1) t
WHERE acc IS NOT NULL GROUP BY tid, don, acc
"""

FX_ALN = """
SELECT qname, rec, flag, tid, pos, nm, nh, mlen + c5 + c3 AS l_qseq,
       concat(CASE WHEN c5 > 0 THEN concat(CAST(c5 AS VARCHAR(9)), 'S') ELSE '' END, CAST(m1 AS VARCHAR(9)), 'M',
              CASE WHEN n1 > 0 THEN concat(CAST(n1 AS VARCHAR(9)), 'N') ELSE '' END, CAST(m2 AS VARCHAR(9)), 'M',
              CASE WHEN d1 > 0 THEN concat(CAST(d1 AS VARCHAR(9)), 'D') ELSE '' END, '20M',
              CASE WHEN c3 > 0 THEN concat(CAST(c3 AS VARCHAR(9)), 'S') ELSE '' END) AS cigar
FROM (SELECT *, m1 + m2 + 20 AS mlen FROM (
  SELECT l_orderkey AS qname,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rec,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 4 WHEN l_linestatus = 'F' THEN 18 ELSE 2 END AS flag,
         CAST(l_suppkey % 25 AS INT) AS tid, CAST(l_partkey * 10 AS INT) AS pos,
         CAST(l_suppkey % 12 AS INT) AS c5, CAST(40 + l_partkey % 60 AS INT) AS m1,
         CAST(CASE WHEN l_linenumber % 2 = 0 THEN 100 + (l_partkey % 5) * 50 ELSE 0 END AS INT) AS n1,
         CAST(30 + l_suppkey % 40 AS INT) AS m2, CAST(l_linenumber % 3 AS INT) AS d1,
         CAST(CAST(floor(l_quantity) AS INT) % 30 AS INT) AS c3,
         CAST(l_linenumber % 3 + l_linenumber * 2 AS INT) AS nm,
         CASE WHEN l_suppkey % 3 = 0 THEN 2 ELSE 1 END AS nh
  FROM lineitem) a) b
"""

FX_SEG = """
SELECT qname, rec, score, ed, tid, is_rev, 1000 AS rlen,
       CAST(CASE WHEN rec % 2 = 1 THEN 1 ELSE 501 - pj END AS INT) AS read_start,
       CAST(CASE WHEN rec % 2 = 1 THEN 495 + sj ELSE 1000 END AS INT) AS read_end,
       ref_start, ref_start + 499 AS ref_end
FROM (SELECT l_orderkey AS qname,
             ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rec,
             CAST(floor(l_extendedprice) AS INT) AS score, l_linenumber AS ed, CAST(l_suppkey % 5 AS INT) AS tid,
             CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_rev,
             l_suppkey % 60 AS pj, l_partkey % 40 AS sj, CAST(l_partkey * 1000 + 1 AS INT) AS ref_start
      FROM lineitem) s
"""

#: Names and texts, in the order in which they build on one another.
VIEWS = {"fx_exon": FX_EXON, "fx_sj": FX_SJ, "fx_aln": FX_ALN, "fx_seg": FX_SEG}
NEEDS = {"fx_exon": ("orders", "lineitem"), "fx_sj": ("fx_exon",), "fx_aln": ("lineitem",), "fx_seg": ("lineitem",)}


#: Rows of a base table in a task, and the keys by which all views group them.
ROWS = 1 << 18
KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def parts(spark: SparkSession, sf_dir: str) -> int:
    """Tasks over which the rows of a folder of tables are dealt, ROWS each at most
    but for chance; one for each core at least.  The files' ends tell their rows."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS))


def view(spark: SparkSession, sf_dir: str, name: str, tasks: int | None = None) -> DataFrame:
    """A fixture table over the tables in a folder.

    Base tables are dealt by their key over ``tasks``, or else ``parts``, whose number grows with
    them; joins, windows and groups by that key need no other shuffle and no more memory a task.
    """
    text, frames, tasks = VIEWS[name], {}, tasks or parts(spark, sf_dir)
    for need in NEEDS[name]:
        frames[need] = view(spark, sf_dir, need, tasks) if need in VIEWS else spark.read.parquet(f"{sf_dir}/{need}.parquet").repartition(tasks, KEYS[need])
        text = re.sub(rf"\b(FROM|JOIN) {need}\b", rf"\1 {{{need}}} {need}", text)
    return spark.sql(text, **frames)


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment records: ord, qname, flag, tid, pos, cigar, l_qseq, nm, nh, xs."""
    rows = view(spark, sf_dir, "fx_aln")
    return rows.withColumn("ord", F.col("rec")).withColumn("xs", F.lit(None).cast("string"))


def transcripts(spark: SparkSession, sf_dir: str, kind: str, tasks: int | None = None) -> DataFrame:
    """Nested transcripts of a kind, 'read' or 'anno'; ``tasks`` as in ``view``."""
    from isoframe.operators.transcripts import nested

    rows = view(spark, sf_dir, "fx_exon", tasks).where(F.col("kind") == kind)
    return nested(rows.select(F.col("ok").alias("ord"), F.col("gene").cast("string").alias("gene_id"), "tid", (F.col("is_rev") == 1).alias("is_rev"), F.col("es").alias("start"), F.col("ee").alias("end")))
