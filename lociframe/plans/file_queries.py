"""Queries of the file family: the driver's tables are written in a format and read back by its reader: name -> (query, SQL)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import intervals as I
from ..operators.tables import shared_path
from ..sources import sequences, tables as T
from .adapters import BASES, LETTERS, SQL, sql, table, v_aln, v_exon, v_iv, v_reads

TAB = "\t"


def lines(df: DataFrame, *fields: Column | str, sep: str = TAB, name: str = "lines") -> str:
    """The path of a text file with a line for each row."""
    path = shared_path(df.sparkSession, name)
    df.select(F.concat_ws(sep, *[F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields]).alias("value")).write.text(path)
    return path


def fastq(s, d):
    path = lines(v_reads(s, d), "read_id", "seq", F.lit("+"), F.expr("repeat('I', length(seq))"), sep="\n")
    return sequences.read_fastq(s, path, "x", 1).select("sample_id", F.col("mate").cast("long").alias("mate"), "read_id", "seq", "qual")


def fasta(s, d):
    letters = F.translate(F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")), LETTERS, BASES)
    path = lines(table(s, d, "documents"), F.concat(F.lit(">d"), "doc_id", F.lit(" letters")), F.regexp_replace(letters, "(.{60})", "$1\n"), sep="\n")
    return sequences.read_fasta_tiles(s, path, 100).select("chrom", F.col("tile").cast("long").alias("tile"), "seq")


def gtf(s, d):
    exon = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; x "1";'))
    return T.read_gtf_exons(s, lines(v_exon(s, d), "chrom", F.lit("t"), F.lit("exon"), F.col("s") + 1, "e", F.lit("."), "strand", F.lit("."), exon))


def bed(s, d):
    return T.read_bed(s, lines(v_exon(s, d), "chrom", "s", "e", "symbol", F.lit("0"), "strand"))


def saf(s, d):
    by = lambda strand: lines(v_exon(s, d).where(F.col("strand") == strand), "gene_id", "chrom", F.col("s") + 1, "e", "strand")
    return T.read_saf(s, {"plus": by("+"), "minus": by("-"), "none": shared_path(s, "none")})


def counts(s, d):
    return T.read_counts(s, lines(table(s, d, "part"), "p_partkey", F.lit("c"), F.lit("1"), F.lit("9"), F.lit("+"), F.col("p_size") * 3, "p_retailprice"), "x")


def rsem(s, d):
    path = shared_path(s, "rsem")
    T.write_tsv(table(s, d, "part").select(F.col("p_partkey").alias("gene_id"), F.col("p_size").alias("expected_count"), F.col("p_retailprice").alias("TPM")), path)
    return T.read_rsem(s, path, "x")


def gene_meta(s, d):
    return T.read_gene_meta(s, lines(table(s, d, "part"), "p_partkey", F.expr("if(p_size % 5 = 0, ' ', p_name)"), "p_type"))


def sam(s, d):
    nh = F.when(F.col("nh").isNotNull(), F.concat(F.lit("NH:i:"), F.col("nh"))).otherwise("XX:i:1")
    path = lines(v_aln(s, d), "qname", "flag", "chrom", F.col("st") + 1, "mapq", "cigar", F.lit("*"), F.lit("0"), "tlen", F.lit("ACGT"), F.lit("IIII"), nh, F.concat(F.lit("AS:i:"), F.col("score").cast("int")))
    out = T.read_sam(s, path, "x")
    return out.select("qname", F.col("flag").cast("long").alias("flag"), "chrom", "st", F.col("mapq").cast("long").alias("mapq"), "cigar", "tlen", "seq", "qual", F.coalesce(F.col("nh").cast("long"), F.lit(-1)).alias("nh"), "score")


def star_log(s, d):
    return T.read_star_log(s, lines(table(s, d, "customer"), F.concat(F.lit("   "), "c_name", F.lit(" ")), F.concat(F.lit(TAB), "c_acctbal", F.expr("if(c_custkey % 2 = 0, '%', '')")), sep="|"), "x")


def taxonomy(s, d):
    return T.read_taxonomy_report(s, lines(table(s, d, "customer"), F.concat(F.lit(" "), "c_acctbal"), "c_custkey", "c_nationkey", F.lit("S"), F.col("c_custkey") + 9, F.concat(F.lit("    "), "c_mktsegment")), "x")


def profile(s, d):
    path = shared_path(s, "profile")
    own = table(s, d, "part").select(F.concat(F.lit("ENSG"), "p_partkey").alias("Ensembl_ID"), F.concat(F.lit("g"), "p_partkey").alias("Gene_symbol"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
    own.write.option("header", True).csv(path)
    return T.read_profile_matrix(s, path)


def single_sample(s, d):
    path = shared_path(s, "expr") + "/one.tsv"
    table(s, d, "part").select("p_partkey", "p_retailprice").write.option("sep", TAB).csv(path)
    return T.read_single_sample_expr(s, path)


def tsv(s, d):
    path = shared_path(s, "tsv")
    T.write_tsv(table(s, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    return s.read.option("sep", TAB).option("header", True).schema("s_suppkey bigint, s_name string, s_acctbal double").csv(path)


def bedgraph(s, d):
    path, ends = shared_path(s, "bedgraph"), v_iv(s, d).groupBy("chrom").agg((F.max("e") - 100).alias("length"))
    T.write_bedgraph(I.coverage(v_iv(s, d), ["chrom"]), path, ends)
    return s.read.option("sep", TAB).schema("chrom bigint, s bigint, e bigint, value double").csv(path)


def fastqc(s, d):
    """A report for every nation."""
    path = shared_path(s, "fastqc")
    own = table(s, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.min("c_custkey").alias("a"), F.max("c_custkey").alias("b"))
    report = F.concat_ws("\n", F.lit(">>Basic Statistics\tpass"), F.concat(F.lit("Total Sequences\t"), "n"), F.concat(F.lit("Sequence length\t"), "a", F.lit("-"), "b"), F.concat(F.lit("%GC\t"), F.col("n") % 100), F.lit(">>END_MODULE"))
    own.select("c_nationkey", report.alias("value")).repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    return T.read_fastqc_basic(s, path, "x")


def picard(s, d):
    own = table(s, d, "lineitem").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"), F.max("l_partkey").alias("p"))
    return T.read_picard_metrics(s, lines(own, F.lit("## METRICS"), F.lit("READS\tBASES\tMOST"), F.concat_ws(TAB, "n", "q", "p"), sep="\n"), "x")


def sorted_table(s, d):
    path = shared_path(s, "sorted")
    T.write_sorted(table(s, d, "part").select(F.col("p_partkey").alias("gene_id"), "p_name"), path)
    return s.read.option("sep", TAB).option("header", True).schema("gene_id bigint, p_name string").csv(path)


QUERIES = {
    "s1_read_fastq": (fastq, sql("SELECT 'x' AS sample_id, CAST(1 AS BIGINT) AS mate, read_id, seq, repeat('I', length(seq)) AS qual FROM v_reads", "v_reads")),
    "s19_read_fasta_tiles": (fasta, f"""WITH l AS (SELECT 'd' || doc_id AS chrom, translate(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '{LETTERS}', '{BASES}') AS letters FROM documents),
        t AS (SELECT chrom, letters, unnest(range(0, (length(letters) + 99) // 100)) AS tile FROM l) SELECT chrom, tile, substr(letters, tile * 100 + 1, 100) AS seq FROM t"""),
    "s3_read_gtf_exons": (gtf, sql("SELECT CAST(gene_id AS VARCHAR) AS gene_id, CAST(chrom AS VARCHAR) AS chrom, s, e, strand FROM v_exon WHERE e > s", "v_exon")),
    "s4_read_bed": (bed, sql("SELECT chrom || '_' || s || ':' || e || ':' || symbol AS region_id, CAST(chrom AS VARCHAR) AS chrom, s, e, symbol AS name, strand FROM v_exon WHERE e > s", "v_exon")),
    "s5_read_saf": (saf, sql("SELECT CASE strand WHEN '+' THEN 'plus' ELSE 'minus' END AS region_class, CAST(gene_id AS VARCHAR) AS region_id, CAST(chrom AS VARCHAR) AS chrom, s, e, strand FROM v_exon", "v_exon")),
    "s6_read_counts": (counts, "SELECT 'x' AS sample_id, CAST(p_partkey AS VARCHAR) AS gene_id, CAST(p_size * 3 AS DOUBLE) AS length, p_retailprice AS count FROM part"),
    "s7_read_rsem": (rsem, "SELECT 'x' AS sample_id, CAST(p_partkey AS VARCHAR) AS gene_id, CAST(p_size AS DOUBLE) AS count, p_retailprice AS tpm FROM part"),
    "s8_read_gene_meta": (gene_meta, "SELECT CAST(p_partkey AS VARCHAR) AS gene_id, CASE WHEN p_size % 5 = 0 THEN 'NA' ELSE p_name END AS symbol, p_type AS gene_type FROM part"),
    "s9_read_sam": (sam, sql("SELECT qname, CAST(flag AS BIGINT) AS flag, chrom, st, CAST(mapq AS BIGINT) AS mapq, m1 || 'M' || gap || 'N' || m2 || 'M' AS cigar, tlen, 'ACGT' AS seq, 'IIII' AS qual, CAST(coalesce(nh, -1) AS BIGINT) AS nh, score FROM v_aln", "v_aln")),
    "s11_read_star_log": (star_log, "SELECT 'x' AS sample_id, c_name AS metric, CAST(c_acctbal AS VARCHAR) AS value FROM customer"),
    "s12_read_taxonomy_report": (taxonomy, "SELECT 'x' AS sample_id, c_acctbal AS pct, c_custkey AS clade_reads, CAST(c_nationkey AS BIGINT) AS direct_reads, 'S' AS rank, c_custkey + 9 AS taxid, c_mktsegment AS name FROM customer"),
    "s13_read_profile_matrix": (profile, "SELECT 'g' || p_partkey AS gene_id, 'size' AS label, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT 'g' || p_partkey, 'price', p_retailprice FROM part"),
    "s14_read_single_sample_expr": (single_sample, "SELECT 'one' AS sample_id, CAST(p_partkey AS VARCHAR) AS gene_id, p_retailprice AS value FROM part"),
    "s15_write_tsv": (tsv, "SELECT s_suppkey, s_name, s_acctbal FROM supplier"),
    "s16_write_bedgraph": (bedgraph, f"""WITH v AS ({SQL["v_iv"]}), x AS (SELECT chrom, s AS pos, 1.0 AS d FROM v WHERE s < e UNION ALL SELECT chrom, e, -1.0 FROM v WHERE s < e), y AS (SELECT chrom, pos, sum(d) AS d FROM x GROUP BY 1, 2),
        z AS (SELECT chrom, pos AS s, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS e, sum(d) OVER (PARTITION BY chrom ORDER BY pos) AS value FROM y), m AS (SELECT chrom, max(e) - 100 AS length FROM v GROUP BY 1)
        SELECT chrom, s, least(e, length) AS e, CAST(value AS DOUBLE) AS value FROM z JOIN m USING (chrom) WHERE value > 1e-9 AND s < length"""),
    "s17_read_fastqc_basic": (fastqc, "SELECT 'x' AS sample_id, CAST(count(*) AS DOUBLE) AS total, CAST(count(*) % 100 AS DOUBLE) AS gc, (min(c_custkey) + max(c_custkey)) / 2 AS length FROM customer GROUP BY c_nationkey"),
    "s18_read_picard_metrics": (picard, """SELECT 'x' AS sample_id, unnest(['READS', 'BASES', 'MOST']) AS metric, unnest([CAST(count(*) AS VARCHAR), CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR), CAST(max(l_partkey) AS VARCHAR)]) AS value FROM lineitem"""),
    "o6_write_sorted": (sorted_table, "SELECT p_partkey AS gene_id, p_name FROM part"),
}
