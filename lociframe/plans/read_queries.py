"""Queries of the read family: name -> (query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import reads as R
from ..operators import reads as O
from .adapters import BASES, LETTERS, sql, table, v_pairs, v_reads

PAIRS_SQL = """
c AS (SELECT *, split_part(read_id, '_', 2) AS umi FROM v_pairs),
a AS (SELECT *, CASE WHEN length(umi) >= 14 THEN translate(reverse(substr(umi, 1, 14)), 'ACGT', 'TGCA') END AS adapter FROM c),
n AS (SELECT a.*, t.n FROM a, range(3, 15) t(n)),
f AS (SELECT read_id, max(n) AS n FROM n WHERE n <= length(seq1) AND adapter IS NOT NULL AND
  len(list_filter(range(1, n + 1), lambda i: substr(right(seq1, n), i, 1) <> substr(adapter, i, 1))) <= floor(n * 0.1) GROUP BY 1),
t AS (SELECT a.*, coalesce(f.n, 0) AS trimmed FROM a LEFT JOIN f USING (read_id)),
o AS (SELECT *, length(seq1) - trimmed AS keep, CASE WHEN adapter IS NULL OR length(seq1) - trimmed < 10 OR length(seq2) < 10 THEN 'Too_short'
  WHEN trimmed > 0 THEN 'UMI_readthrough' ELSE 'No_UMI_readthrough' END AS outcome FROM t)
"""


def trimmed(s, d):
    return R.trim_readthrough(v_pairs(s, d))


def quals(s, d):
    letters = F.filter(F.split("seq", ""), lambda c: c != "")
    return v_reads(s, d).select("read_id", F.transform(letters, lambda c: F.when(c == "A", 5).when(c == "C", 38).when(c == "G", 15).otherwise(30)).alias("q"))


def panel(s, d):
    """The benchmark's texts as sequences that reads are screened against."""
    seq = F.translate(F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")), LETTERS, BASES)
    return table(s, d, "benchmark").select(F.concat(F.lit("@b"), F.col("item_id")).alias("ref"), seq.alias("seq"))


QUERIES = {
    "p1_motif_at": (lambda s, d: v_reads(s, d).select("read_id", R.motif_at(F.col("seq"), "ACG", 3, 5).alias("hit")),
        sql("SELECT read_id, coalesce(length(seq) >= 5 AND substr(seq, 3, 3) = 'ACG', false) AS hit FROM v_reads", "v_reads")),
    "p2_reverse_complement": (lambda s, d: v_reads(s, d).select("read_id", R.reverse_complement(F.col("seq")).alias("rc")),
        sql("SELECT read_id, translate(reverse(seq), 'ACGT', 'TGCA') AS rc FROM v_reads", "v_reads")),
    "p3_trim_readthrough": (lambda s, d: trimmed(s, d).select("doc_id", "piece", "adapter", F.col("trimmed").cast("long").alias("trimmed"), "seq1", "outcome"),
        sql(PAIRS_SQL + "SELECT doc_id, piece, adapter, CAST(trimmed AS BIGINT) AS trimmed, substr(seq1, 1, keep) AS seq1, outcome FROM o", "v_reads", "v_pairs")),
    "p4_rewrite_umi_header": (lambda s, d: trimmed(s, d).select("doc_id", "piece", "read_id"),
        sql("SELECT doc_id, piece, CASE WHEN length(split_part(read_id, '_', 2)) >= 14 THEN split_part(read_id, '_', 1) || '_' || substr(split_part(read_id, '_', 2), 1, 8) ELSE read_id END AS read_id FROM v_pairs", "v_reads", "v_pairs")),
    "p5_classify_pairs": (lambda s, d: trimmed(s, d).groupBy("outcome").agg(F.count("*").alias("pairs")),
        sql(PAIRS_SQL + "SELECT outcome, count(*) AS pairs FROM o GROUP BY 1", "v_reads", "v_pairs")),
    "p6_extract_umi": (lambda s, d: R.extract_umi(v_pairs(s, d).withColumn("qual2", F.col("seq2"))).select("doc_id", "piece", "read_id", "seq2"),
        sql("SELECT doc_id, piece, read_id || '_' || substr(seq2, 1, 14) AS read_id, substr(seq2, 15) AS seq2 FROM v_pairs", "v_reads", "v_pairs")),
    "p7_trim_adapter": (lambda s, d: v_reads(s, d).select("read_id", R.trim_adapter(F.col("seq"), "ACGTACGAC").alias("seq")),
        sql("""p AS (SELECT read_id, seq, i, least(length(seq) - i + 1, 9) AS n FROM v_reads, range(1, 101) t(i) WHERE i <= length(seq) - 2),
        f AS (SELECT read_id, min(i) AS i FROM p WHERE len(list_filter(range(0, n), lambda k: substr(seq, i + k, 1) <> substr('ACGTACGAC', k + 1, 1))) <= floor(n * 0.1) GROUP BY 1)
        SELECT read_id, CASE WHEN i IS NULL THEN seq ELSE substr(seq, 1, i - 1) END AS seq FROM v_reads LEFT JOIN f USING (read_id)""", "v_reads")),
    "p8_quality_trim": (lambda s, d: quals(s, d).select("read_id", R.quality_cut(F.col("q")).cast("long").alias("kept")),
        sql("""r AS (SELECT read_id, i, CASE substr(seq, length(seq) - i + 1, 1) WHEN 'A' THEN 15 WHEN 'C' THEN -18 WHEN 'G' THEN 5 ELSE -10 END AS x FROM v_reads, range(1, 101) t(i) WHERE i <= length(seq)),
        w AS (SELECT *, sum(x) OVER (PARTITION BY read_id ORDER BY i) AS total FROM r), y AS (SELECT *, min(total) OVER (PARTITION BY read_id ORDER BY i) AS low FROM w),
        z AS (SELECT *, max(total) OVER (PARTITION BY read_id) AS best FROM y WHERE low >= 0 AND total > 0), c AS (SELECT read_id, min(i) AS cut FROM z WHERE total = best GROUP BY 1)
        SELECT read_id, length(seq) - coalesce(cut, 0) AS kept FROM v_reads LEFT JOIN c USING (read_id)""", "v_reads")),
    "a1_motif_fraction": (lambda s, d: O.motif_fraction(v_reads(s, d), ["sample_id"], motif="ACG", start=3, end=5),
        sql("SELECT sample_id, count(*) AS total, CAST(sum(CASE WHEN length(seq) >= 5 AND substr(seq, 3, 3) = 'ACG' THEN 1 ELSE 0 END) AS BIGINT) AS hits, round(sum(CASE WHEN length(seq) >= 5 AND substr(seq, 3, 3) = 'ACG' THEN 1 ELSE 0 END) / count(*), 4) AS ratio FROM v_reads GROUP BY 1", "v_reads")),
    "a2_base_composition": (lambda s, d: O.base_composition(v_reads(s, d), ["sample_id"]).select("sample_id", F.col("pos").cast("long").alias("pos"), *[F.round(b, 6).alias(b.lower()) for b in "ACGT"]),
        sql("SELECT sample_id, pos, " + ", ".join(f"round(sum(CASE WHEN substr(seq, pos, 1) = '{b}' THEN 1 ELSE 0 END) / count(*), 6) AS {b.lower()}" for b in "ACGT") + " FROM v_reads, range(1, 15) t(pos) WHERE length(seq) >= 14 GROUP BY 1, 2", "v_reads")),
    "a3_read_length_histogram": (lambda s, d: O.read_length_histogram(v_reads(s, d), ["sample_id"]).select("sample_id", F.col("length").cast("long").alias("length"), "reads", F.round("log10_reads", 6).alias("log10_reads")),
        sql("SELECT sample_id, length(seq) AS length, count(*) AS reads, round(log10(count(*)), 6) AS log10_reads FROM v_reads GROUP BY 1, 2", "v_reads")),
    "a4_trim_summary": (lambda s, d: O.trim_summary(trimmed(s, d), ["sample_id"]),
        sql(PAIRS_SQL + """SELECT sample_id, count(*) AS input, CAST(sum(CASE WHEN outcome <> 'Too_short' THEN 1 ELSE 0 END) AS BIGINT) AS output, CAST(sum(CASE WHEN outcome = 'UMI_readthrough' THEN 1 ELSE 0 END) AS BIGINT) AS trimmed,
        CASE WHEN sum(CASE WHEN outcome <> 'Too_short' THEN 1 ELSE 0 END) > 0 THEN round(sum(CASE WHEN outcome = 'UMI_readthrough' THEN 1 ELSE 0 END) / sum(CASE WHEN outcome <> 'Too_short' THEN 1 ELSE 0 END), 6) ELSE 0.0 END AS ratio FROM o GROUP BY 1""", "v_reads", "v_pairs")),
    "a5_trim_log": (lambda s, d: O.trim_log(trimmed(s, d)).select("read_id", "adapter", F.col("trimmed").cast("long").alias("trimmed"), F.col("length").cast("long").alias("length")),
        sql(PAIRS_SQL + "SELECT split_part(read_id, '_', 1) || '_' || substr(umi, 1, 8) AS read_id, adapter, CAST(trimmed AS BIGINT) AS trimmed, CAST(keep AS BIGINT) AS length FROM o WHERE trimmed > 0", "v_reads", "v_pairs")),
    "a6_fastq_stats": (lambda s, d: O.fastq_stats(v_reads(s, d).withColumn("file", F.col("doc_id") % 3), ["sample_id"], "file").select("sample_id", "reads", F.round("mean_length", 6).alias("mean_length"), F.round("gc_percent", 6).alias("gc_percent"), F.col("min_length").cast("long").alias("min_length"), F.col("max_length").cast("long").alias("max_length")),
        sql("""f AS (SELECT sample_id, doc_id % 3 AS file, count(*) AS n, avg(length(seq)) AS m, sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) * 100.0 / sum(length(seq)) AS g, min(length(seq)) AS lo, max(length(seq)) AS hi FROM v_reads GROUP BY 1, 2)
        SELECT sample_id, CAST(sum(n) AS BIGINT) AS reads, round(avg(m), 6) AS mean_length, round(avg(g), 6) AS gc_percent, min(lo) AS min_length, max(hi) AS max_length FROM f GROUP BY 1""", "v_reads")),
    "a38_contaminant_share": (lambda s, d: O.contaminant_share(v_reads(s, d).withColumn("label", F.when(F.col("doc_id") % 7 == 0, "rRNA").when(F.col("doc_id") % 11 == 0, "bacteria")), ["sample_id"]),
        sql("""l AS (SELECT sample_id, CASE WHEN doc_id % 7 = 0 THEN 'rRNA' WHEN doc_id % 11 = 0 THEN 'bacteria' END AS label, count(*) OVER (PARTITION BY sample_id) AS n FROM v_reads)
        SELECT sample_id, label, count(*) AS reads, round(count(*) * 100.0 / any_value(n), 2) AS percent FROM l WHERE label IS NOT NULL GROUP BY 1, 2""", "v_reads")),
    "j1_pair_mates": (lambda s, d: O.pair_mates(v_reads(s, d).withColumn("qual", F.col("seq")), v_pairs(s, d).select("sample_id", F.split_part("read_id", F.lit("_"), F.lit(1)).alias("read_id"), F.col("seq2").alias("seq"), F.col("seq2").alias("qual"))).select("sample_id", "read_id", "seq1", "seq2"),
        sql("SELECT sample_id, a.read_id, seq AS seq1, seq2 FROM v_reads a JOIN v_pairs b USING (sample_id, doc_id, piece)", "v_reads", "v_pairs")),
    "j13_kmer_screen": (lambda s, d: O.kmer_screen(v_reads(s, d), panel(s, d), k=12),
        sql(f"""p AS (SELECT '@b' || item_id AS ref, translate(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '{LETTERS}', '{BASES}') AS seq FROM benchmark),
        k AS (SELECT DISTINCT read_id, least(substr(seq, i, 12), translate(reverse(substr(seq, i, 12)), 'ACGT', 'TGCA')) AS kmer FROM v_reads, range(1, 90) t(i) WHERE i <= length(seq) - 11),
        q AS (SELECT DISTINCT ref, least(substr(seq, i, 12), translate(reverse(substr(seq, i, 12)), 'ACGT', 'TGCA')) AS kmer FROM (SELECT ref, seq, unnest(range(1, greatest(length(seq) - 10, 1))) AS i FROM p)),
        c AS (SELECT read_id, ref, count(*) AS kmers FROM k JOIN q USING (kmer) GROUP BY 1, 2),
        n AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY kmers DESC, ref) AS nth FROM c) SELECT read_id, ref, kmers FROM n WHERE nth = 1""", "v_reads")),
    "o3_sample_rows": (lambda s, d: O.sample_rows(v_reads(s, d), 100, 42).select("read_id", "seq"), sql("SELECT read_id, seq FROM v_reads ORDER BY md5(read_id || ':42'), read_id LIMIT 100", "v_reads")),
    "o4_sample_fraction": (lambda s, d: O.sample_fraction(v_reads(s, d), 0.2, 7).select("read_id", "seq"), sql(f"SELECT read_id, seq FROM v_reads WHERE substr(md5(read_id || ':7'), 1, 8) < '{int(0.2 * (1 << 32)):08x}'", "v_reads")),
    "o5_limit_reads": (lambda s, d: O.limit_reads(v_reads(s, d), 50).groupBy().agg(F.count("*").alias("reads")),
        sql("SELECT least(count(*), 50) AS reads FROM v_reads", "v_reads")),
    "s2_validate_fastq": (lambda s, d: R.validate_fastq(v_reads(s, d).withColumn("qual", F.expr("substring(seq, 1, cast(90 as int))"))).select("read_id"),
        sql("SELECT read_id FROM v_reads WHERE length(seq) > 90", "v_reads")),
    "p22_normalise_gene_id": (lambda s, d: v_reads(s, d).select("read_id", R.strip_version(F.concat(F.lit("ENSG"), F.lpad("doc_id", 11, "0"), F.lit("."), F.col("doc_id") % 9)).alias("stable"), R.extract_symbol(F.concat(F.lit("ENSG0001|"), F.lower("sample_id"), F.lit(";"), F.lit("ENSG0002"))).alias("symbol")),
        sql("SELECT read_id, 'ENSG' || lpad(CAST(doc_id AS VARCHAR), 11, '0') AS stable, upper(sample_id) AS symbol FROM v_reads", "v_reads")),
    "p23_gene_label": (lambda s, d: v_reads(s, d).select("read_id", R.gene_label(F.when(F.col("doc_id") % 2 == 0, F.concat(F.col("sample_id"), F.lit(".1"))).otherwise(F.lit("X")), F.concat(F.col("sample_id"), F.lit(".2"))).alias("label")),
        sql("SELECT read_id, CASE WHEN doc_id % 2 = 0 THEN sample_id ELSE 'X(' || sample_id || '.2)' END AS label FROM v_reads", "v_reads")),
    "p26_format_count": (lambda s, d: v_reads(s, d).select("read_id", R.format_count(F.col("doc_id") / 4).alias("shown")),
        sql("SELECT read_id, regexp_replace(regexp_replace(printf('%.2f', doc_id / 4), '0+$', ''), '\\.$', '') AS shown FROM v_reads", "v_reads")),
}
