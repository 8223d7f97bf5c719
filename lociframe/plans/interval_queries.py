"""Queries of the interval family: name -> (query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import express as X, intervals as I
from .adapters import sql, v_exon, v_iv, v_signal


def regions(s, d):
    return v_exon(s, d).select(F.col("gene_id").alias("region_id"), "chrom", F.col("s").alias("s2"), F.col("e").alias("e2"), "strand", F.col("gene_type").alias("region_class"))


MERGED = """m AS (SELECT *, max(e) OVER (PARTITION BY {k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM {t}),
g AS (SELECT *, sum(CASE WHEN s <= b THEN 0 ELSE 1 END) OVER (PARTITION BY {k} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS no FROM m)"""
COVERAGE = """x AS (SELECT chrom, s AS pos, {w} AS d FROM {t} WHERE s < e UNION ALL SELECT chrom, e, -({w}) FROM {t} WHERE s < e),
y AS (SELECT chrom, pos, sum(d) AS d FROM x GROUP BY 1, 2),
z AS (SELECT chrom, pos AS s, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS e, sum(d) OVER (PARTITION BY chrom ORDER BY pos) AS value FROM y)"""

QUERIES = {
    "w4_merge_intervals": (lambda s, d: I.merge_intervals(v_iv(s, d), ["chrom"]), sql(MERGED.format(k="chrom", t="v_iv") + " SELECT chrom, min(s) AS s, max(e) AS e FROM g GROUP BY chrom, no", "v_iv")),
    "w5_coverage": (lambda s, d: I.coverage(v_iv(s, d), ["chrom"], tile=1000).select("chrom", "s", "e", F.round("value", 6).alias("value")),
        sql(COVERAGE.format(w="1.0", t="v_iv") + " SELECT chrom, s, e, CAST(round(value, 6) AS DOUBLE) AS value FROM z WHERE value > 1e-9 AND e IS NOT NULL", "v_iv")),
    "w6_binned_coverage": (lambda s, d: I.binned_coverage(v_iv(s, d), ["chrom"], 50).select("chrom", "bin", F.round("value", 6).alias("value")),
        sql("""b AS (SELECT chrom, s, e, unnest(range(s // 50, (e - 1) // 50 + 1)) AS bin FROM v_iv WHERE s < e)
        SELECT chrom, bin, round(sum((least(e, (bin + 1) * 50) - greatest(s, bin * 50)) / 50.0), 6) AS value FROM b GROUP BY 1, 2""", "v_iv")),
    "j3_overlap_join": (lambda s, d: I.overlap_join(v_iv(s, d), regions(s, d), ["chrom"], 64, build=True).groupBy("region_id").agg(F.count("*").alias("pairs"), F.sum("overlap").alias("bases")),
        sql("SELECT gene_id AS region_id, count(*) AS pairs, CAST(sum(least(a.e, b.e) - greatest(a.s, b.s)) AS BIGINT) AS bases FROM v_iv a JOIN v_exon b ON a.chrom = b.chrom AND a.s < b.e AND b.s < a.e AND a.s < a.e GROUP BY 1", "v_iv", "v_exon")),
    "j8_signal_in_regions": (lambda s, d: I.signal_in_regions(v_signal(s, d), regions(s, d), ["chrom"], width=64).select("region_id", F.round("signal", 4).alias("signal")),
        sql("SELECT gene_id AS region_id, round(coalesce(sum(value * (least(a.e, b.e) - greatest(a.s, b.s))), 0.0), 4) AS signal FROM v_exon b LEFT JOIN v_signal a ON a.chrom = b.chrom AND a.s < b.e AND b.s < a.e GROUP BY 1", "v_signal", "v_exon")),
    "j9_known_junctions": (lambda s, d: I.known_junction_match(
            v_iv(s, d).selectExpr("chrom", "s as id", "array(struct(s, e), struct(e + 30 as s, e + 40 as e)) as blocks").distinct(), v_exon(s, d).selectExpr("chrom", "s + 21 as donor", "s + 51 as acceptor")).select("chrom", "id", F.element_at("blocks", 1).e.alias("donor")),
        sql("SELECT DISTINCT a.chrom, a.s AS id, a.e AS donor FROM v_iv a JOIN v_exon b ON a.chrom = b.chrom AND a.e = b.s + 21", "v_iv", "v_exon")),
    "w7_junctions": (lambda s, d: I.junctions_from_exons(v_exon(s, d).selectExpr("gene_id % 100 as gene_id", "chrom", "s", "e")),
        sql(MERGED.format(k="gene, chrom", t="ex") .replace("m AS", "ex AS (SELECT gene_id % 100 AS gene, chrom, s, e FROM v_exon), m AS", 1) + """, u AS (SELECT gene, chrom, min(s) AS s, max(e) AS e FROM g GROUP BY gene, chrom, no),
        j AS (SELECT gene AS gene_id, chrom, e AS donor, lead(s) OVER (PARTITION BY gene, chrom ORDER BY s) AS acceptor FROM u) SELECT * FROM j WHERE acceptor > donor""", "v_exon")),
    "a13_gene_model": (lambda s, d: X.gene_model(v_exon(s, d).withColumn("gene_id", F.col("gene_id") % 100)),
        sql(MERGED.format(k="gene, chrom, strand", t="ex").replace("m AS", "ex AS (SELECT gene_id % 100 AS gene, chrom, strand, s, e FROM v_exon), m AS", 1) + """, u AS (SELECT gene, chrom, strand, min(s) AS s, max(e) AS e FROM g GROUP BY gene, chrom, strand, no)
        SELECT gene AS gene_id, CAST(sum(e - s) AS BIGINT) AS length, count(*) AS exons FROM u GROUP BY 1""", "v_exon")),
    "a14_multi_locus_genes": (lambda s, d: X.multi_locus_genes(v_exon(s, d).withColumn("gene_id", F.col("gene_id") % 77)),
        sql("SELECT gene_id % 77 AS gene_id, count(DISTINCT chrom || strand) AS loci FROM v_exon GROUP BY 1 HAVING count(DISTINCT chrom || strand) > 1", "v_exon")),
    "r1_scaled_profile": (lambda s, d: I.scaled_profile(v_signal(s, d), regions(s, d), ["chrom"], width=64).select("region_class", F.col("bin").cast("long").alias("bin"), F.round("value", 4).alias("value")),
        sql("""p AS (SELECT gene_id, gene_type, chrom, CASE WHEN strand = '-' THEN 19 - i ELSE i END AS bin, CAST(floor(s + i * (e - s) / 20) AS BIGINT) AS s, CAST(floor(s + (i + 1) * (e - s) / 20) AS BIGINT) AS e FROM v_exon, range(0, 20) t(i) WHERE e - s >= 20),
        q AS (SELECT p.gene_id, p.gene_type, p.bin, coalesce(sum(a.value * (least(a.e, p.e) - greatest(a.s, p.s))), 0.0) / any_value(p.e - p.s) AS x FROM p LEFT JOIN v_signal a ON a.chrom = p.chrom AND a.s < p.e AND p.s < a.e GROUP BY 1, 2, 3)
        SELECT gene_type AS region_class, bin, round(avg(x), 4) AS value FROM q GROUP BY 1, 2""", "v_signal", "v_exon")),
    "r2_exclude_blacklist": (lambda s, d: I.exclude_regions(v_exon(s, d).withColumnRenamed("gene_id", "region_id"), v_iv(s, d).where("w < 0.02").selectExpr("chrom", "s as s2", "e as e2"), ["chrom"], width=64).select("region_id"),
        sql("SELECT gene_id AS region_id FROM v_exon b WHERE NOT EXISTS (SELECT 1 FROM v_iv a WHERE a.w < 0.02 AND a.chrom = b.chrom AND a.s < b.e AND b.s < a.e)", "v_iv", "v_exon")),
    "u4_merge_tracks": (lambda s, d: I.merge_tracks(["chrom"], v_iv(s, d).selectExpr("chrom", "s", "e", "1.0d as value"), v_signal(s, d).selectExpr("chrom", "s", "e", "0.5d as value"), tile=1000).select("chrom", "s", "e", F.round("value", 6).alias("value")),
        sql("u AS (SELECT chrom, s, e, 1.0 AS v FROM v_iv UNION ALL SELECT chrom, s, e, 0.5 FROM v_signal), " + COVERAGE.format(w="v", t="u") + " SELECT chrom, s, e, CAST(round(value, 6) AS DOUBLE) AS value FROM z WHERE value > 1e-9 AND e IS NOT NULL", "v_iv", "v_signal")),
}
