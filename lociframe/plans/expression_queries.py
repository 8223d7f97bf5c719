"""Queries of the expression, circular RNA, profile and quality families: name -> (query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import circ as C, deconv as D, express as X, qc as Q
from .adapters import sql, table, v_calls, v_counts, v_exon, v_profile


def counts(s, d):
    return v_counts(s, d).join(v_exon(s, d).selectExpr("gene_id", "cast(e - s as double) as length"), "gene_id").withColumn("count", F.col("sense") + F.col("antisense"))


def matrix(s, d):
    """TPM with annotation; a few types are named as known RNA types."""
    own = X.annotate(X.tpm(counts(s, d)), v_exon(s, d))
    return own.select("sample_id", "gene_id", "symbol", "gene_type", F.col("count").alias("read_counts"), F.col("tpm").alias("norm_expr"))


def circ(s, d):
    own = C.merge_calls(v_calls(s, d), ["F", "O"])
    return own


def sites(s, d):
    """The places of either caller's calls."""
    own = v_calls(s, d).withColumn("site", F.concat(F.col("s").cast("string"), F.lit(":"), F.col("e").cast("string")))
    return own.where("caller = 'F'"), own.where("caller <> 'F'")


def expr(s, d):
    """Genes 8 to 63, so that the profile has genes that no sample holds."""
    own = table(s, d, "lineitem").selectExpr("l_suppkey % 4 as sample_id", "cast(l_linenumber * 8 + l_partkey % 8 as bigint) as gene_id", "l_quantity")
    return own.groupBy("sample_id", "gene_id").agg(F.sum("l_quantity").alias("value"))


def genes(s, d):
    """A gene table that lacks most of the counted genes."""
    return table(s, d, "supplier").selectExpr("s_suppkey as gene_id", "s_name as symbol", "concat('type', s_nationkey) as gene_type")


COUNTS = """c AS (SELECT sample_id, gene_id, sense, antisense, sense + antisense AS count, CAST(e - s AS DOUBLE) AS length FROM v_counts JOIN v_exon USING (gene_id)),
p AS (SELECT *, count * 1000.0 / length AS rpk FROM c WHERE count > 0 AND length > 0), t AS (SELECT *, rpk / sum(rpk) OVER (PARTITION BY sample_id) * 1e6 AS tpm FROM p)"""
MATRIX = COUNTS + """, m AS (SELECT sample_id, gene_id, coalesce(nullif(trim(symbol), ''), 'NA') AS symbol, coalesce(nullif(trim(gene_type), ''), 'NA') AS gene_type, count AS read_counts, tpm AS norm_expr FROM t LEFT JOIN v_exon USING (gene_id))"""
V = ("v_counts", "v_exon")
K = "sample_id, chrom, e, strand"
CLUSTERS = f"""i AS (SELECT *, s - lag(s) OVER (PARTITION BY {K} ORDER BY s) AS gap FROM v_calls),
j AS (SELECT *, sum(CASE WHEN gap < 2 THEN 0 ELSE 1 END) OVER (PARTITION BY {K} ORDER BY s RANGE UNBOUNDED PRECEDING) AS island FROM i),
k AS (SELECT *, min(s) OVER (PARTITION BY {K}, island) AS first FROM j), q AS (SELECT *, first + (s - first) // 2 * 2 AS cluster FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY {K}, cluster ORDER BY reads DESC, s, CASE caller WHEN 'F' THEN 1 ELSE 2 END, gene_id) AS nth, min(caller) OVER (PARTITION BY {K}, cluster) <> max(caller) OVER (PARTITION BY {K}, cluster) AS several FROM q),
u AS (SELECT sample_id, chrom, e, strand, s, gene_id, symbol, reads, CASE WHEN several THEN caller || ' (overlapped)' ELSE caller END AS source FROM r WHERE nth = 1)"""
PROFILE = "p AS (SELECT gene_id, label, avg(value) AS value FROM v_profile GROUP BY 1, 2)"
EXPR = "x AS (SELECT l_suppkey % 4 AS sample_id, CAST(l_linenumber * 8 + l_partkey % 8 AS BIGINT) AS gene_id, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)"
GENES = "e AS (SELECT s_suppkey AS gene_id, s_name AS symbol, 'type' || s_nationkey AS gene_type FROM supplier)"
THRESHOLDS = [("norm_expr", t) for t in (0.001, 0.1, 0.2, 0.5, 1)] + [("read_counts", t) for t in (1, 5, 10, 20, 50)]
BY_THRESHOLD = ", e AS (" + " UNION ALL ".join(f"SELECT sample_id, gene_type, '{m}' AS metric, CAST({t} AS DOUBLE) AS threshold, CAST(sum(CASE WHEN {m} > {t} THEN 1 ELSE 0 END) AS BIGINT) AS genes FROM m GROUP BY 1, 2" for m, t in THRESHOLDS) + ")"


def named(df):
    """The part types under the names of RNA types, or of none, by a rule on their letters."""
    names = F.array(*[F.lit(x) for x in (*X.SMALL_RNA, *X.LONG_RNA, "artifact")])
    return df.withColumn("gene_type", F.element_at(names, (F.ascii("gene_type") + F.length("gene_type")) % (len(X.SMALL_RNA) + len(X.LONG_RNA) + 1) + 1))


def groups(s, d):
    return X.composition_percent(X.expressed_by_threshold(named(matrix(s, d))))


KINDS = (*X.SMALL_RNA, *X.LONG_RNA, "artifact")
RENAMED = f", m2 AS (SELECT * REPLACE ([{', '.join(repr(x) for x in KINDS)}][(ascii(gene_type) + length(gene_type)) % {len(KINDS)} + 1] AS gene_type) FROM m)"


def taxa(s, d):
    """A taxonomy over the parts: every third one up to a root."""
    return table(s, d, "part").selectExpr("p_partkey as taxid", "nullif(p_partkey div 3, 0) as parent")


def report(s, d):
    """Orders as lines of a taxonomy report, indented by two blanks a level."""
    return table(s, d, "orders").selectExpr("o_custkey % 5 as sample_id", "o_orderkey as line", "o_orderkey as taxid", "concat(repeat('  ', cast(if(o_orderkey % 7 < 4, o_orderkey % 7, 0) as int)), 'taxon ', o_orderkey) as name")


LOG_NAMES = (
    "Number of input reads", "Uniquely mapped reads number", "Number of reads mapped to multiple loci", "Number of reads mapped to too many loci", "Number of reads unmapped: too short", "Number of reads unmapped: other",
    "Number of splices: Total", "Number of chimeric reads", "Average input read length", "Mismatch rate per base, %",
)


def log(s, d, times=1):
    """Customers as lines of a mapper's log, one log a nation."""
    metric = F.element_at(F.array(*[F.lit(n) for n in LOG_NAMES]), (F.col("c_custkey") % len(LOG_NAMES) + 1).cast("int"))
    own = table(s, d, "customer").groupBy(F.col("c_nationkey").alias("sample_id"), metric.alias("metric")).agg(F.sum("c_custkey").alias("value"))
    return own.withColumn("value", F.concat((F.col("value") * times).cast("string"), F.when(F.col("metric").contains("%"), "%").otherwise("")))


def qc(s, d):
    """The quality table of the nations, from all the sources it can have."""
    own = table(s, d, "customer").withColumnRenamed("c_nationkey", "sample_id")
    files = own.groupBy("sample_id", (F.col("c_custkey") % 2).alias("file")).agg(F.sum("c_custkey").alias("reads"), F.count("*").alias("n"))
    fastqc = files.select("sample_id", "file", "reads", (40 + F.col("n") % 20).alias("gc"), F.when(F.col("file") == 0, F.concat(F.lit("30-"), (40 + F.col("n") % 30).cast("string"))).otherwise("50").alias("length"))
    trimmed = files.select("sample_id", "file", (F.col("reads") - F.col("n")).alias("reads"), (20.0 + F.col("n") % 50).alias("mean_length"))
    taxonomy = own.selectExpr("sample_id", "c_acctbal as pct", "case when c_custkey % 3 = 0 then 'Bacteria' when c_custkey % 3 = 1 then ' Homo sapiens' else 'x' end as name")
    contaminants = own.selectExpr("sample_id", "case c_mktsegment when 'BUILDING' then 'ecoli' when 'MACHINERY' then 'mycoplasma' else 'rRNA' end as label", "1 as reads")
    strand = own.groupBy("sample_id").agg(F.expr("avg(if(c_custkey % 3 = 0, 1, 0))").alias("forward"), F.expr("avg(if(c_custkey % 3 = 1, 1, 0))").alias("reverse"), F.expr("avg(if(c_custkey % 3 = 2, 1, 0))").alias("undetermined"), F.expr("cast(count(*) as string)").alias("splice_per_kb"))
    names = lambda xs, k: F.element_at(F.array(*[F.lit(x) for x in xs]), (k % len(xs) + 1).cast("int"))
    regions = table(s, d, "supplier").select(F.col("s_nationkey").alias("sample_id"), names(tuple(Q.REGION_NAMES), F.col("s_suppkey")).alias("region_class"), (F.col("s_suppkey") % 7).alias("reads"))
    picard = table(s, d, "nation").select(F.col("n_nationkey").alias("sample_id"), names(Q.PICARD_KEYS, F.col("n_nationkey")).alias("metric"), F.col("n_regionkey").cast("string").alias("value"))
    expression = table(s, d, "orders").select((F.col("o_custkey") % 25).alias("sample_id"), names((*Q.RNA_TYPES, "other"), F.col("o_orderkey")).alias("gene_type"), (F.col("o_orderkey") % 20).alias("read_counts"), (F.col("o_orderkey") % 300 / 100).alias("norm_expr"))
    motif = own.groupBy("sample_id").agg((F.count("*") % 9 / 16).alias("ratio"))
    return Q.qc_matrix(own, fastqc, motif, trimmed, taxonomy, contaminants, log(s, d, 2), log(s, d), strand, regions, picard, expression)


SHOWN = lambda x: f"CASE WHEN ({x}) IS NULL OR ({x}) = 0 THEN 'NA' ELSE regexp_replace(regexp_replace(printf('%.2f', round(CAST({x} AS DOUBLE), 2)), '0+$', ''), '\\.$', '') END"
ZERO = lambda x: f"CASE WHEN coalesce({x}, 0) = 0 THEN '0' ELSE {SHOWN(x)} END"
SHARE = lambda x, y: f"CASE WHEN coalesce({y}, 0) > 0 THEN round(coalesce({x}, 0) * 100.0 / ({y}), 2) ELSE 0.0 END"


def qc_sql(body):
    """`o` (sample_id, ord, metric, value): a row of numbers for each source and nation, and the table from these."""
    star = ["input", "uniq", "several", "too_many", "short", "other", "splices", "chimeric", "length", "mismatch"]
    logs = ", ".join(f"coalesce(sum(CASE WHEN c_custkey % 10 = {k} THEN c_custkey END), 0) AS {n}" for k, n in enumerate(star))
    regions = ", ".join(f"sum(CASE WHEN s_suppkey % 8 = {k} THEN s_suppkey % 7 END) AS in{k}" for k in range(8))
    picard = ", ".join(f"max(CASE WHEN n_nationkey % {len(Q.PICARD_KEYS)} = {k} THEN CAST(n_regionkey AS VARCHAR) END) AS pic{k}" for k in range(len(Q.PICARD_KEYS)))
    tests = [(c, t) for c, ts in (("k % 20", (1, 5, 10)), ("k % 300 / 100.0", (0.01, 0.1, 1.0))) for t in ts]
    types = range(len(Q.RNA_TYPES))
    of = ", ".join([f"sum(CASE WHEN k % 22 = {r} THEN CAST({c} > {t} AS INTEGER) END) AS g{r}_{j}" for r in types for j, (c, t) in enumerate(tests)] + [f"sum(CASE WHEN k % 22 = {r} THEN k % 20 END) AS r{r}" for r in types])
    mapped, multi, inside = "2 * (uniq + several + too_many)", "several + too_many", " + ".join(f"coalesce(in{k}, 0)" for k in range(8))
    rows = [
        ("Total Raw Reads (R1+R2)", SHOWN("raw")), ("Total Raw Read Pairs (Fragments)", SHOWN("floor(CASE WHEN files >= 2 THEN raw / 2 ELSE raw END)")), ("%GC of Raw Reads", SHOWN("gc")), ("Average Raw Read Length", SHOWN("round_even(raw_length, 0)")),
        ("ACC motif fraction from UMI region", "CAST(n % 9 / 16 AS VARCHAR)"), ("Total Trimmed Reads (R1+R2)", SHOWN("trim")), ("Average Trimmed Read Length", SHOWN("round_even(trim_length, 0)")), ("Percentage of Reads Remaining after Trimming", f"CASE WHEN raw > 0 THEN {ZERO(SHARE('trim', 'raw'))} ELSE 'NA' END"),
        ("Percentage of Reads Mapped to Human (Kraken)", SHOWN("human")), ("Percentage of Reads Mapped to Bacteria (Kraken)", SHOWN("bacteria")),
        ("Number of Reads Mapped to Escherichia coli (BBSplit)", SHOWN("ecoli")), ("Percentage of Trimmed Reads Mapped to E. coli (BBSplit)", SHOWN(SHARE("ecoli", "trim"))),
        ("Number of Reads Mapped to Mycoplasma (BBSplit)", SHOWN("myco")), ("Percentage of Trimmed Reads Mapped to Mycoplasma (BBSplit)", SHOWN(SHARE("myco", "trim"))), ("Percentage of Trimmed Reads Mapped to rRNAs (RiboDetector)", SHOWN(SHARE("ribo", "trim"))),
        ("Total Fragments Mapped to Human (First STAR)", SHOWN(mapped)), ("Number of Reads after UMI-deduplication (STAR Input)", SHOWN("input")), ("Percentage of UMI-dedup Fragments", SHOWN(SHARE("input", mapped))), ("Average Mapped Read Length (STAR)", ZERO("length")),
        ("Percentage of Mapped Reads on Forward Strand", SHOWN("round(fwd * 100, 2)")), ("Percentage of Mapped Reads on Reverse Strand", SHOWN("round(rev * 100, 2)")), ("Percentage of Mapped Reads with Failed Strand", SHOWN("round(bad * 100, 2)")),
        ("Splices per Kilobase (splice/kb, DNA contamination metric)", "CAST(n AS VARCHAR)"), ("Number of Uniquely Mapped Reads (STAR)", SHOWN("uniq")), ("Percentage of Uniquely Mapped Reads (vs STAR Input)", SHOWN(SHARE("uniq", "input"))),
        ("Number of Multi-mapped Reads (STAR)", SHOWN(multi)), ("Percentage of Multi-mapped Reads (vs STAR Input)", SHOWN(SHARE(f"({multi})", "input"))), ("Number of Splices (from unique reads, STAR)", ZERO("splices")), ("Number of Unmapped Reads (STAR)", ZERO("short + other")),
        ("Number of Chimeric Reads (STAR)", ZERO("chimeric")), ("Mismatch Rate per Base (STAR)", ZERO("mismatch") + " || '%'"),
    ]
    rows += [(f"Number of Reads Mapped to {n} Regions", SHOWN(f"in{k}")) for k, n in enumerate(Q.REGION_NAMES.values())] + [(f"Percentage of Reads Mapped to {n} Regions", SHOWN(SHARE(f"in{k}", f"({inside})"))) for k, n in enumerate(Q.REGION_NAMES.values())]
    rows += [(f"PICARD_{n}", f"coalesce(pic{k}, 'NA')") for k, n in enumerate(Q.PICARD_KEYS)]
    names = [f"(Read Counts > {t:g})" for t in (1, 5, 10)] + [f"(TPM/CPM > {t:g})" for t in (0.01, 0.1, 1.0)]
    rows += [(f"Expressed {rna} Genes {names[j]}", SHOWN(f"g{r}_{j}")) for r, rna in enumerate(Q.RNA_TYPES) for j in range(6)]
    rows += [(f"Number of Reads Mapped to {rna}", SHOWN(f"r{r}")) for r, rna in enumerate(Q.RNA_TYPES)] + [(f"Percentage of Reads Mapped to {rna}", SHOWN(SHARE(f"r{r}", "reads_all"))) for r, rna in enumerate(Q.RNA_TYPES)]
    listed = lambda xs: "[" + ", ".join(xs) + "]"
    quoted = listed("'" + n.replace("'", "''") + "'" for n, _ in rows)
    return f"""WITH l AS (SELECT c_nationkey AS sample_id, {logs}, count(*) AS n, avg(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END) AS fwd, avg(CASE WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END) AS rev, avg(CASE WHEN c_custkey % 3 = 2 THEN 1 ELSE 0 END) AS bad,
      coalesce(max(CASE WHEN c_custkey % 3 = 1 THEN c_acctbal END), 0.0) AS human, coalesce(max(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END), 0.0) AS bacteria,
      nullif(count(*) FILTER (c_mktsegment = 'BUILDING'), 0) AS ecoli, nullif(count(*) FILTER (c_mktsegment = 'MACHINERY'), 0) AS myco, nullif(count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')), 0) AS ribo FROM customer GROUP BY 1),
    f AS (SELECT c_nationkey AS sample_id, c_custkey % 2 AS file, sum(c_custkey) AS reads, count(*) AS n FROM customer GROUP BY 1, 2),
    q AS (SELECT sample_id, sum(reads) AS raw, count(*) AS files, avg(40 + n % 20) AS gc, avg(CASE WHEN file = 0 THEN (70 + n % 30) / 2 ELSE 50 END) AS raw_length, sum(reads - n) AS trim, avg(20.0 + n % 50) AS trim_length FROM f GROUP BY 1),
    x AS (SELECT s_nationkey AS sample_id, {regions} FROM supplier GROUP BY 1), p AS (SELECT n_nationkey AS sample_id, {picard} FROM nation GROUP BY 1),
    e AS (SELECT o_custkey % 25 AS sample_id, {of}, sum(k % 20) AS reads_all FROM (SELECT *, o_orderkey AS k FROM orders) GROUP BY 1),
    w AS (SELECT * FROM l LEFT JOIN q USING (sample_id) LEFT JOIN x USING (sample_id) LEFT JOIN p USING (sample_id) LEFT JOIN e USING (sample_id)),
    o AS (SELECT sample_id, unnest(range(1, {len(rows) + 1})) AS ord, unnest({quoted}) AS metric, unnest({listed(v for _, v in rows)}) AS value FROM w) {body}"""


QUERIES = {
    "a11_tpm": (lambda s, d: X.tpm(counts(s, d)).select("sample_id", "gene_id", F.round("tpm", 4).alias("tpm")), sql(COUNTS + " SELECT sample_id, gene_id, round(tpm, 4) AS tpm FROM t", *V)),
    "a12_tpm_effective": (lambda s, d: X.tpm_effective(counts(s, d).withColumn("count_uniq", F.col("sense")).withColumn("count_total", F.col("count")), 20.0).select("sample_id", "gene_id", F.round("tpm_uniq", 4).alias("tpm_uniq"), F.round("tpm", 4).alias("tpm")),
        sql(COUNTS + ", g AS (SELECT *, greatest(1.0, length - 20 + 1) / 1000 AS kb FROM c) SELECT sample_id, gene_id, round(sense / kb * 1e6 / sum(count / kb) OVER (PARTITION BY sample_id), 4) AS tpm_uniq, round(count / kb * 1e6 / sum(count / kb) OVER (PARTITION BY sample_id), 4) AS tpm FROM g", *V)),
    "j5_annotate": (lambda s, d: X.annotate(v_counts(s, d), genes(s, d)).select("sample_id", "gene_id", "symbol", "gene_type"),
        sql(GENES + " SELECT sample_id, gene_id, coalesce(symbol, 'NA') AS symbol, coalesce(gene_type, 'NA') AS gene_type FROM v_counts LEFT JOIN e USING (gene_id)", "v_counts")),
    "j6_annotate_inner": (lambda s, d: X.annotate_inner(v_counts(s, d), genes(s, d)).select("sample_id", "gene_id", "symbol"), sql(GENES + " SELECT sample_id, gene_id, symbol FROM v_counts JOIN e USING (gene_id)", "v_counts")),
    "j7_strand_subtract": (lambda s, d: X.strand_subtract(v_counts(s, d).withColumn("count", F.col("sense")), v_counts(s, d).withColumn("count", F.col("antisense")), ["sample_id", "gene_id"]).select("sample_id", "gene_id", "count"),
        sql("SELECT sample_id, gene_id, greatest(sense - antisense, 0.0) AS count FROM v_counts", "v_counts")),
    "w8_top_n_per_group": (lambda s, d: X.top_n_per_group(matrix(s, d), ["sample_id", "gene_type"], 3, "norm_expr", "gene_id").select("sample_id", "gene_type", "gene_id"),
        sql(MATRIX + ", n AS (SELECT *, row_number() OVER (PARTITION BY sample_id, gene_type ORDER BY norm_expr DESC, gene_id) AS nth FROM m) SELECT sample_id, gene_type, gene_id FROM n WHERE nth <= 3", *V)),
    "w11_last_wins": (lambda s, d: X.last_wins(v_exon(s, d).withColumn("line", F.col("gene_id")).withColumn("gene_id", F.col("gene_id") % 100), ["gene_id"], "line").select("gene_id", "symbol"),
        sql("SELECT gene_id % 100 AS gene_id, arg_max(symbol, gene_id) AS symbol FROM v_exon GROUP BY 1", "v_exon")),
    "w12_share_of_total": (lambda s, d: X.share_of_total(counts(s, d), "count", ["sample_id"]).select("sample_id", "gene_id", F.round("share", 8).alias("share")),
        sql(COUNTS + " SELECT sample_id, gene_id, round(count / sum(count) OVER (PARTITION BY sample_id), 8) AS share FROM c", *V)),
    "a17_expressed_by_threshold": (lambda s, d: X.expressed_by_threshold(matrix(s, d)), sql(MATRIX + BY_THRESHOLD + " SELECT * FROM e", *V)),
    "a18_composition_percent": (lambda s, d: groups(s, d).select("sample_id", "gene_type", "metric", "threshold", "rna_group", F.round("percent", 6).alias("percent")),
        sql(MATRIX + RENAMED + BY_THRESHOLD.replace("FROM m ", "FROM m2 ") + f", f AS (SELECT *, CASE WHEN gene_type IN ({', '.join(repr(x) for x in X.SMALL_RNA)}) THEN 'Small' ELSE 'Long' END AS rna_group FROM e WHERE gene_type <> 'artifact') SELECT sample_id, gene_type, metric, threshold, rna_group, round(genes * 100.0 / greatest(sum(genes) OVER (PARTITION BY sample_id, metric, threshold, rna_group), 1), 6) AS percent FROM f", *V)),
    "a19_reads_by_biotype": (lambda s, d: X.reads_by_biotype(matrix(s, d)), sql(MATRIX + " SELECT sample_id, gene_type, sum(read_counts) AS reads, round(sum(read_counts) / sum(sum(read_counts)) OVER (PARTITION BY sample_id) * 100, 2) AS percent FROM m GROUP BY 1, 2", *V)),
    "a33_mean_by_type": (lambda s, d: X.mean_by_type(X.top_genes(matrix(s, d))).select("sample_id", "gene_type", F.round("mean_expr", 4).alias("mean_expr")),
        sql(MATRIX + """, n AS (SELECT *, row_number() OVER (PARTITION BY sample_id, gene_type ORDER BY norm_expr DESC, gene_id) AS nth FROM m WHERE norm_expr > 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY nth > 5, norm_expr DESC, gene_id) AS place FROM n) SELECT sample_id, gene_type, round(avg(norm_expr), 4) AS mean_expr FROM o WHERE place <= 100 GROUP BY 1, 2""", *V)),
    "o1_top_genes": (lambda s, d: X.top_genes(matrix(s, d), 5, 40).select("sample_id", "gene_id", "gene_type"),
        sql(MATRIX + """, n AS (SELECT *, row_number() OVER (PARTITION BY sample_id, gene_type ORDER BY norm_expr DESC, gene_id) AS nth FROM m WHERE norm_expr > 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY nth > 5, norm_expr DESC, gene_id) AS place FROM n) SELECT sample_id, gene_id, gene_type FROM o WHERE place <= 40""", *V)),
    "o2_order_types": (lambda s, d: X.order_types_by_total(X.expressed_by_threshold(matrix(s, d))).select("gene_type", "total", F.col("place").cast("long").alias("place")),
        sql(MATRIX + BY_THRESHOLD + " SELECT gene_type, CAST(sum(genes) AS BIGINT) AS total, row_number() OVER (ORDER BY sum(genes) DESC, gene_type) AS place FROM e GROUP BY 1", *V)),
    "p25_expressed": (lambda s, d: X.expressed(matrix(s, d)).groupBy("sample_id").agg(F.count("*").alias("genes")), sql(MATRIX + " SELECT sample_id, count(*) AS genes FROM m WHERE norm_expr > 0 GROUP BY 1", *V)),
    "p25_drop_artifact": (lambda s, d: X.drop_artifact(named(matrix(s, d))).groupBy("sample_id").agg(F.count("*").alias("genes")), sql(MATRIX + RENAMED + " SELECT sample_id, count(*) AS genes FROM m2 WHERE gene_type <> 'artifact' GROUP BY 1", *V)),
    "p25_countable": (lambda s, d: X.countable(counts(s, d).withColumn("length", F.col("length") - 20)).groupBy("sample_id").agg(F.count("*").alias("genes")), sql(COUNTS + " SELECT sample_id, count(*) AS genes FROM c WHERE count > 0 AND length > 20 GROUP BY 1", *V)),
    "p27_project_expression": (lambda s, d: X.project_expression(matrix(s, d)).select("sample_id", "gene_id", F.round("norm_expr", 4).alias("norm_expr")), sql(MATRIX + " SELECT sample_id, gene_id, round(norm_expr, 4) AS norm_expr FROM m", *V)),
    "j10_remaining_genes": (lambda s, d: X.remaining_genes(matrix(s, d), X.top_n_per_group(matrix(s, d), ["sample_id", "gene_type"], 3, "norm_expr", "gene_id")).select("sample_id", "gene_id"),
        sql(MATRIX + ", n AS (SELECT *, row_number() OVER (PARTITION BY sample_id, gene_type ORDER BY norm_expr DESC, gene_id) AS nth FROM m) SELECT sample_id, gene_id FROM n WHERE nth > 3", *V)),
    "u1_combine_expression": (lambda s, d: X.combine_expression(
            matrix(s, d).withColumnsRenamed({"read_counts": "count", "norm_expr": "tpm"}), circ(s, d).withColumn("circ_id1", C.circ_ids(F.col("chrom").cast("string"), F.col("s"), F.col("e"), F.col("gene_id"), F.col("symbol"))[0]).withColumn("cpm", F.col("reads") * 1.0).withColumn("gene_id", F.col("gene_id"))
        ).groupBy("sample_id", "gene_type").agg(F.count("*").alias("genes"), F.round(F.sum("read_counts"), 2).alias("reads")),
        sql(MATRIX + ", " + CLUSTERS + " SELECT sample_id, gene_type, count(*) AS genes, round(sum(read_counts), 2) AS reads FROM m GROUP BY 1, 2 UNION ALL SELECT sample_id, 'circRNAs', count(*), round(CAST(sum(reads) AS DOUBLE), 2) FROM u GROUP BY 1", *V, "v_calls")),
    "u2_union_calls": (lambda s, d: C.union_calls(v_calls(s, d).where("caller = 'F'"), v_calls(s, d).where("caller <> 'F'"), ("A", "B")).groupBy("caller").agg(F.count("*").alias("calls"), F.sum("reads").alias("reads")),
        sql("SELECT CASE WHEN caller = 'F' THEN 'A' ELSE 'B' END AS caller, count(*) AS calls, CAST(sum(reads) AS BIGINT) AS reads FROM v_calls GROUP BY 1", "v_calls")),
    "u3_id_sets": (lambda s, d: X.id_sets(*sites(s, d), "site")[0], sql("SELECT s || ':' || e AS site FROM v_calls WHERE caller = 'F' EXCEPT SELECT s || ':' || e FROM v_calls WHERE caller <> 'F'", "v_calls")),
    "u3_id_intersection": (lambda s, d: X.id_sets(*sites(s, d), "site")[1], sql("SELECT s || ':' || e AS site FROM v_calls WHERE caller = 'F' INTERSECT SELECT s || ':' || e FROM v_calls WHERE caller <> 'F'", "v_calls")),
    "u5_genes_seen": (lambda s, d: X.genes_seen([v_counts(s, d).where("sense > 0"), v_counts(s, d).where("antisense > 0")], genes(s, d)),
        sql("SELECT DISTINCT gene_id FROM v_counts WHERE (sense > 0 OR antisense > 0) AND gene_id IN (SELECT s_suppkey FROM supplier)", "v_counts")),
    "p24_circ_ids": (lambda s, d: v_calls(s, d).select(*[x.alias(n) for n, x in zip(("circ_id1", "circ_id2"), C.circ_ids(F.col("chrom").cast("string"), F.col("s"), F.col("e"), F.col("gene_id"), F.col("symbol")))]).withColumn("p", C.parse_circ_id(F.col("circ_id1"))).selectExpr("circ_id1", "circ_id2", "p.s as s", "p.e as e", "p.gene as gene"),
        sql("SELECT chrom || ':' || s || '|' || e || '|' || gene_id AS circ_id1, chrom || ':' || s || '|' || e || '|' || symbol AS circ_id2, s, e, gene_id AS gene FROM v_calls", "v_calls")),
    "a10_circ_cpm": (lambda s, d: C.circ_cpm(v_calls(s, d), v_calls(s, d).groupBy("sample_id").agg(F.count_distinct("e").alias("n"))).select("sample_id", "chrom", "s", "e", "strand", "cpm"),
        sql("n AS (SELECT sample_id, count(DISTINCT e) AS n FROM v_calls GROUP BY 1) SELECT sample_id, chrom, s, e, strand, round(reads / n * 1e6, 2) AS cpm FROM v_calls JOIN n USING (sample_id) WHERE reads > 0", "v_calls")),
    "w1_cluster_by_start": (lambda s, d: C.cluster_by_start(v_calls(s, d), ["sample_id", "chrom", "e", "strand"]).select("sample_id", "chrom", "e", "strand", "s", "cluster"), sql(CLUSTERS + " SELECT sample_id, chrom, e, strand, s, cluster FROM q", "v_calls")),
    "w1_cluster_by_start_any": (lambda s, d: C.cluster_by_start(v_calls(s, d), ["sample_id", "chrom"], tol=5).select("sample_id", "chrom", "s", "cluster"),
        sql("""t AS MATERIALIZED (SELECT DISTINCT sample_id, chrom, s FROM v_calls), f AS (SELECT sample_id, chrom, min(s) AS s FROM t GROUP BY 1, 2 UNION ALL SELECT f.sample_id, f.chrom, min(t.s) FROM f JOIN t USING (sample_id, chrom) WHERE t.s >= f.s + 5 GROUP BY 1, 2)
        SELECT v_calls.sample_id, v_calls.chrom, v_calls.s, f.s AS cluster FROM v_calls ASOF JOIN f ON v_calls.sample_id = f.sample_id AND v_calls.chrom = f.chrom AND v_calls.s >= f.s""", "v_calls").replace("WITH ", "WITH RECURSIVE ", 1)),
    "w2_cluster_representative": (lambda s, d: circ(s, d).select("sample_id", "chrom", "e", "strand", "s", "reads", "source"), sql(CLUSTERS + " SELECT sample_id, chrom, e, strand, s, reads, source FROM u", "v_calls")),
    "w3_number_within_gene": (lambda s, d: circ(s, d).select("sample_id", "symbol", "circ_id3"),
        sql(CLUSTERS + " SELECT sample_id, symbol, 'circRNA' || row_number() OVER (PARTITION BY sample_id, symbol ORDER BY s, chrom, e, strand, gene_id) || '|' || symbol AS circ_id3 FROM u", "v_calls")),
    "w3_number_novel": (lambda s, d: C.merge_calls(v_calls(s, d).withColumn("symbol", C.known_gene(F.when(F.col("s") % 3 == 0, "n/a").otherwise(F.col("symbol")))), ["F", "O"]).select("sample_id", "symbol", "circ_id3"),
        sql(CLUSTERS + """, x AS (SELECT *, CASE WHEN s % 3 = 0 THEN 'novel' ELSE symbol END AS sym FROM u), y AS (SELECT *, row_number() OVER (PARTITION BY sample_id, sym ORDER BY s, chrom, e, strand, gene_id) AS nth FROM x)
        SELECT sample_id, sym AS symbol, CASE WHEN sym = 'novel' THEN chrom || ':' || s || '|' || e || '|novel' ELSE 'circRNA' || nth || '|' || sym END AS circ_id3 FROM y""", "v_calls")),
    "a32_venn_counts": (lambda s, d: C.venn_counts(v_calls(s, d).where("caller = 'F'"), v_calls(s, d).where("caller <> 'F'"), "s"),
        sql("k AS (SELECT s, max(CASE WHEN caller = 'F' THEN 1 ELSE 0 END) AS a, max(CASE WHEN caller <> 'F' THEN 1 ELSE 0 END) AS b FROM v_calls GROUP BY 1) SELECT CAST(sum(a * (1 - b)) AS BIGINT) AS only_a, CAST(sum(b * (1 - a)) AS BIGINT) AS only_b, CAST(sum(a * b) AS BIGINT) AS both FROM k", "v_calls")),
    "j14_annotate_backsplice": (lambda s, d: C.annotate_backsplice(
            table(s, d, "lineitem").selectExpr("l_orderkey as read_id", "l_partkey % 10 as chrom", "(l_partkey + 10 * (l_suppkey % 2)) * 7 + l_linenumber * 3 as donor", "l_partkey * 7 as acceptor", "case when l_partkey % 2 = 0 then '+' else '-' end as strand", "l_partkey % 10 as chrom2", "case when l_partkey % 2 = 0 then '+' else '-' end as strand2"), v_exon(s, d)
        ).groupBy("type", "gene_id").agg(F.count("*").alias("sites"), F.sum("reads").alias("reads")),
        sql("""b AS (SELECT l_partkey % 10 AS chrom, l_partkey * 7 AS s, (l_partkey + 10 * (l_suppkey % 2)) * 7 + l_linenumber * 3 AS e, CASE WHEN l_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_orderkey FROM lineitem),
        t AS (SELECT chrom, s, e, strand, count(DISTINCT l_orderkey) AS reads FROM b WHERE e > s GROUP BY 1, 2, 3, 4),
        k AS (SELECT t.chrom, t.s, t.e, t.strand, min(x.gene_id) AS g FROM t JOIN v_exon x ON x.chrom = t.chrom AND x.s = t.s AND x.strand = t.strand JOIN v_exon y ON y.chrom = t.chrom AND y.e = t.e AND y.strand = t.strand AND y.gene_id = x.gene_id GROUP BY 1, 2, 3, 4)
        SELECT CASE WHEN g IS NULL THEN 'other' ELSE 'exon' END AS type, coalesce(CAST(g AS VARCHAR), 'novel') AS gene_id, count(*) AS sites, CAST(sum(reads) AS BIGINT) AS reads FROM t LEFT JOIN k USING (chrom, s, e, strand) GROUP BY 1, 2""", "v_exon")),
    "a23_signal_expression": (lambda s, d: X.signal_expression(counts(s, d).join(v_exon(s, d).select("gene_id", "strand"), "gene_id").selectExpr("sample_id", "gene_id", "strand", "sense as f1r2", "antisense as f2r1"), v_exon(s, d).selectExpr("gene_id", "e - s as length")).select("sample_id", "gene_id", *[F.round(c, 4).alias(c) for c in ("cpm", "cpm_forward", "cpm_reverse", "tpm", "tpm_forward", "tpm_reverse")]),
        sql(COUNTS + """, y AS (SELECT c.*, CASE WHEN strand = '-' THEN antisense ELSE sense END AS f, CASE WHEN strand = '-' THEN sense ELSE antisense END AS r, length / 1000.0 AS kb FROM c JOIN v_exon USING (gene_id)),
        z AS (SELECT sample_id, sum(count) AS t, sum(sense) AS t1, sum(antisense) AS t2, sum(count / kb) AS k FROM y GROUP BY 1)
        SELECT sample_id, gene_id, round(count * 1e6 / t, 4) AS cpm, round(f * 1e6 / t1, 4) AS cpm_forward, round(r * 1e6 / t2, 4) AS cpm_reverse, round(count / kb * 1e6 / k, 4) AS tpm, round(f / kb * 1e6 / k, 4) AS tpm_forward, round(r / kb * 1e6 / k, 4) AS tpm_reverse FROM y JOIN z USING (sample_id)""", *V)),
    "a24_profile_gene_mean": (lambda s, d: D.profile_gene_mean(v_profile(s, d)).select("gene_id", "label", F.round("value", 6).alias("value")), sql("SELECT gene_id, label, round(avg(value), 6) AS value FROM v_profile GROUP BY 1, 2", "v_profile")),
    "a25_infer_sex": (lambda s, d: D.infer_sex(v_counts(s, d).selectExpr("sample_id", "case when gene_id % 9 = 0 then 'XIST' when gene_id % 9 = 1 then 'DDX3Y' when gene_id % 9 = 2 then 'KDM5D' else 'other' end as gene_id", "sense as value"), margin=0.02).select("sample_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "sex"),
        sql("""g AS (SELECT sample_id, log2(1 + median(CASE WHEN gene_id % 9 = 0 THEN sense END)) AS x, log2(1 + median(CASE WHEN gene_id % 9 IN (1, 2) THEN sense END)) AS y FROM v_counts GROUP BY 1)
        SELECT sample_id, round(x, 6) AS x, round(y, 6) AS y, CASE WHEN x - y >= 0.02 THEN 'Female' WHEN y - x >= 0.02 THEN 'Male' ELSE 'Unknown' END AS sex FROM g""", "v_counts")),
    "a26_overlap_ratio": (lambda s, d: D.overlap_ratio(expr(s, d), v_profile(s, d)).select("sample_id", "found", "wanted", F.round("ratio", 6).alias("ratio")),
        "WITH " + EXPR + " SELECT sample_id, count(DISTINCT gene_id) AS found, CAST(64 AS BIGINT) AS wanted, round(count(DISTINCT gene_id) / 64, 6) AS ratio FROM x GROUP BY 1"),
    "a36_filter_sex_labels": (lambda s, d: D.filter_sex_labels(v_profile(s, d).withColumn("label", F.when(F.col("label") == "1", "Testis tissue").when(F.col("label") == "2", "Ovary").otherwise(F.col("label"))), "Male").groupBy("label").agg(F.count("*").alias("cells")),
        sql("SELECT CASE WHEN label = '1' THEN 'Testis tissue' ELSE label END AS label, count(*) AS cells FROM v_profile WHERE label <> '2' GROUP BY 1", "v_profile")),
    "j11_align_to_reference": (lambda s, d: D.align_to_reference(expr(s, d), v_profile(s, d)), sql(EXPR + ", s AS (SELECT DISTINCT sample_id FROM x), g AS (SELECT DISTINCT gene_id FROM v_profile) SELECT sample_id, gene_id, coalesce(value, 0.0) AS value FROM s CROSS JOIN g LEFT JOIN x USING (sample_id, gene_id)", "v_profile")),
    "a35_deconvolve": (lambda s, d: D.deconvolve(expr(s, d).withColumn("value", F.col("value") / 1000), v_profile(s, d).withColumn("value", F.abs("value"))),
        sql(EXPR + """, p AS MATERIALIZED (SELECT gene_id, label, avg(abs(value)) AS value FROM v_profile GROUP BY 1, 2), g AS (SELECT a.label AS a, b.label AS b, sum(a.value * b.value) AS g FROM p a JOIN p b USING (gene_id) GROUP BY 1, 2),
        m AS MATERIALIZED (SELECT list(r ORDER BY a) AS gram, list(a ORDER BY a) AS labels FROM (SELECT a, list(g ORDER BY b) AS r FROM g GROUP BY a)),
        c AS (SELECT sample_id, list(v ORDER BY label) AS c FROM (SELECT sample_id, label, sum(x.value / 1000 * p.value) AS v FROM x JOIN p USING (gene_id) GROUP BY 1, 2) GROUP BY 1),
        r AS (SELECT 0 AS i, sample_id, c, list_transform(c, lambda y: 0.0::DOUBLE) AS w, 1.0::DOUBLE AS moved FROM c UNION ALL
          SELECT i + 1, sample_id, c, v, list_sum(list_transform(range(1, len(v) + 1), lambda k: abs(v[k] - w[k]))) / greatest(list_sum(v), 1e-300) FROM (
            SELECT i, sample_id, c, w, list_reduce(list_prepend(w, list_transform(range(1, len(w) + 1), lambda k: [CAST(k AS DOUBLE)])),
              lambda u, e: list_transform(range(1, len(u) + 1), lambda j: CASE WHEN j = e[1] THEN greatest(0.0, u[j] + (c[j] - list_sum(list_transform(range(1, len(u) + 1), lambda k: gram[j][k] * u[k]))) / gram[j][j]) ELSE u[j] END)) AS v
            FROM r, m WHERE moved > 1e-12))
        SELECT sample_id, label, fraction FROM (SELECT sample_id, unnest(labels) AS label, round(unnest(w) / list_sum(w), 4) AS fraction FROM r, m WHERE moved <= 1e-12) WHERE fraction > 0""", "v_profile").replace("WITH ", "WITH RECURSIVE ", 1)),
    "o7_fraction_report": (lambda s, d: D.fraction_report(X.share_of_total(table(s, d, "customer").groupBy(F.col("c_nationkey").alias("sample_id"), F.col("c_mktsegment").alias("label")).agg(F.count("*").alias("n")), "n", ["sample_id"], "fraction").select("sample_id", "label", F.round("fraction", 4).alias("fraction"))).select("sample_id", "label", F.round("percent", 6).alias("percent"), F.col("place").cast("long").alias("place")),
        """WITH n AS (SELECT c_nationkey AS sample_id, c_mktsegment AS label, count(*) AS n FROM customer GROUP BY 1, 2), f AS (SELECT *, round(n / sum(n) OVER (PARTITION BY sample_id), 4) AS fraction FROM n)
        SELECT sample_id, label, round(fraction * 100, 6) AS percent, row_number() OVER (PARTITION BY sample_id ORDER BY fraction DESC, label) AS place FROM f WHERE fraction > 0"""),
    "a29_qc_matrix": (lambda s, d: qc(s, d).select("sample_id", F.col("ord").cast("long").alias("ord"), "metric", "value"), qc_sql("SELECT sample_id, ord, metric, value FROM o")),
    "a29_star_metrics": (lambda s, d: Q.star_metrics(log(s, d)).select("sample_id", F.coalesce("input", F.lit(0.0)).alias("input"), "mapped", "unmapped", "mapped_percent"),
        qc_sql("SELECT sample_id, CAST(input AS DOUBLE) AS input, CAST(uniq + several + too_many AS DOUBLE) AS mapped, CAST(short + other AS DOUBLE) AS unmapped, CASE WHEN input > 0 THEN round((uniq + several + too_many) * 100.0 / input, 2) END AS mapped_percent FROM l")),
    "a30_qc_cohort": (lambda s, d: Q.qc_cohort(qc(s, d), ["Total Raw Reads (R1+R2)", "Number of Unmapped Reads (STAR)"]).toDF("sample_id", "raw_reads", "unmapped_reads"),
        qc_sql("SELECT sample_id, max(CASE WHEN metric = 'Total Raw Reads (R1+R2)' THEN value END) AS raw_reads, max(CASE WHEN metric = 'Number of Unmapped Reads (STAR)' THEN value END) AS unmapped_reads FROM o GROUP BY 1")),
    "a31_taxonomy_share": (lambda s, d: Q.taxonomy_share(table(s, d, "customer").selectExpr("c_nationkey as sample_id", "c_acctbal as pct", "case when c_custkey % 3 = 0 then 'Bacteria' when c_custkey % 3 = 1 then ' Homo sapiens' else 'x' end as name")),
        "SELECT c_nationkey AS sample_id, coalesce(max(CASE WHEN c_custkey % 3 = 1 THEN c_acctbal END), 0.0) AS homo_sapiens, coalesce(max(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END), 0.0) AS bacteria FROM customer GROUP BY 1"),
    "a31_clade_rollup": (lambda s, d: Q.clade_rollup(table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("taxid")).agg(F.count("*").alias("reads")), taxa(s, d)),
        """WITH RECURSIVE t AS (SELECT p_partkey AS taxid, nullif(p_partkey // 3, 0) AS parent FROM part), n AS (SELECT taxid FROM t UNION SELECT parent FROM t WHERE parent IS NOT NULL UNION SELECT l_partkey FROM lineitem),
        d AS (SELECT l_partkey AS taxid, count(*) AS reads FROM lineitem GROUP BY 1), r AS (SELECT taxid, taxid AS above FROM n UNION ALL SELECT r.taxid, t.parent FROM r JOIN t ON t.taxid = r.above WHERE t.parent IS NOT NULL)
        SELECT above AS taxid, CAST(coalesce(sum(reads), 0) AS BIGINT) AS reads FROM r LEFT JOIN d USING (taxid) GROUP BY 1"""),
    "a31_report_parents": (lambda s, d: Q.report_parents(report(s, d), ["sample_id"]).withColumn("parent", F.coalesce("parent", F.lit(-1))),
        """WITH r AS (SELECT o_custkey % 5 AS sample_id, o_orderkey AS line, o_orderkey AS taxid, CASE WHEN o_orderkey % 7 < 4 THEN o_orderkey % 7 ELSE 0 END AS depth FROM orders),
        p AS (SELECT a.sample_id, a.taxid, b.taxid AS parent FROM r a ASOF LEFT JOIN r b ON a.sample_id = b.sample_id AND a.depth - 1 = b.depth AND a.line > b.line) SELECT sample_id, taxid, coalesce(parent, -1) AS parent FROM p"""),
    "p28_unpivot_percent": (lambda s, d: Q.unpivot_percent_metrics(table(s, d, "nation").selectExpr("n_nationkey as sample_id", "n_regionkey / 10 as PCT_CODING_BASES", "n_nationkey / 100 as PCT_UTR_BASES")).select("sample_id", "category", F.round("percentage", 6).alias("percentage")),
        "SELECT n_nationkey AS sample_id, 'Coding Bases' AS category, round(n_regionkey / 10 * 100, 6) AS percentage FROM nation UNION ALL SELECT n_nationkey, 'Utr Bases', round(n_nationkey / 100 * 100, 6) FROM nation"),
}
