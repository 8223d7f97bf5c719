"""The driver's tables seen as reads, alignments, intervals, exons, counts, calls and signal: for Spark, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

READ, LETTERS, BASES = 100, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters of every text, whole, as reads of 100 letters (the last one shorter; a text without letters is one
    empty read)."""
    letters = F.translate(F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")), LETTERS, BASES)
    own = table(spark, sf_dir, "documents").select(F.col("source").alias("sample_id"), "doc_id", letters.alias("letters"))
    own = own.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.floor((F.length("letters") - 1) / READ), F.lit(0)))).alias("piece"))
    read_id = F.concat(F.lit("@r"), F.col("doc_id"), F.lit("."), F.col("piece"))
    return own.select("sample_id", read_id.alias("read_id"), "doc_id", "piece", F.substring("letters", (F.col("piece") * READ + 1).cast("int"), F.lit(READ)).alias("seq"))


def v_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads parted into mates; the UMI is taken from the end of mate 1, so that many read through. Short reads have short UMIs."""
    own = v_reads(spark, sf_dir).withColumn("n", F.col("doc_id") + F.col("piece"))
    return own.selectExpr(
        "sample_id", "doc_id", "piece", "concat(read_id, '_', translate(reverse(substring(seq, cast(40 - n % 12 as int), 14)), 'ACGT', 'TGCA')) as read_id",
        "substring(seq, 1, cast(45 - n % 7 as int)) as seq1", "repeat('I', cast(45 - n % 7 as int)) as qual1", "substring(seq, cast(46 - n % 7 as int), 100) as seq2",
    )


def v_aln(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey % 4 as sample_id", "cast(l_orderkey as string) as qname",
        "cast(1 + case when l_linenumber % 2 = 1 then 64 else 128 end + case when l_partkey % 2 = 1 then 16 else 0 end + case when l_quantity > 48 then 256 else 0 end as int) as flag",
        "cast(l_suppkey % 10 as string) as chrom", "l_partkey * 7 as st", "cast(round(l_discount * 100) as double) as score", "cast(l_linenumber * 40 as int) as mapq",
        "cast(case when l_linenumber = 7 then null else 1 + l_partkey % 2 end as int) as nh", "cast(l_quantity * 10 - 100 as bigint) as tlen",
        "concat(cast(cast(l_quantity as int) as string), 'M', cast(10 * l_linenumber as string), 'N', cast(l_partkey % 20 + 5 as string), 'M') as cigar",
    )


def v_pe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read pairs with a UMI in their name: most are proper, some lie on two chromosomes, lack a mate or have several places."""
    own = table(spark, sf_dir, "lineitem").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("second")).where("not (second = 1 and l_linenumber = 6)")
    return own.withColumn("back", F.expr("(l_partkey + second) % 2 = 1")).selectExpr(
        "l_suppkey % 4 as sample_id", "concat(l_orderkey, '.', l_linenumber, '_', substring('AC', cast(l_orderkey % 2 + 1 as int), 1), 'GT', substring('AAAC', cast(l_linenumber % 4 + 1 as int), 1)) as qname",
        "cast(65 + 64 * second + if(back, 16, 0) as int) as flag", "cast((l_suppkey + if(l_linenumber = 5, second, 0)) % 10 as string) as chrom", "l_partkey * 7 + if(back, 30 + cast(l_quantity as bigint), 0) as st",
        "cast(round(l_discount * 100) as double) as score", "255 - cast(l_linenumber as int) as mapq", "cast(if(l_linenumber = 4, 2, 1) as int) as nh", "cast(if(back, -200, 200) as bigint) as tlen",
        "concat(cast(cast(l_quantity as int) as string), 'M', cast(10 * l_linenumber as string), 'N', cast(l_partkey % 20 + 5 as string), 'M') as cigar",
    )


def v_iv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_suppkey % 10 as chrom", "l_partkey * 7 as s", "l_partkey * 7 + cast(l_quantity as bigint) as e", "l_discount as w")


def v_exon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as gene_id", "p_partkey % 10 as chrom", "p_partkey * 7 as s", "p_partkey * 7 + p_size * 3 as e", "case when p_partkey % 2 = 0 then '+' else '-' end as strand", "p_name as symbol", "p_type as gene_type"
    )


def v_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.expr("l_suppkey % 4").alias("sample_id"), F.col("l_partkey").alias("gene_id")).agg(
        F.expr("sum(case when l_returnflag = 'N' then l_quantity else 0 end)").alias("sense"), F.expr("sum(case when l_returnflag <> 'N' then l_quantity else 0 end)").alias("antisense")
    )


def v_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey % 4 as sample_id", "l_linestatus as caller", "l_suppkey % 10 as chrom", "l_orderkey % 500 as e", "l_returnflag as strand", "l_partkey as s", "cast(l_quantity as bigint) as reads",
        "concat('g', l_partkey % 50) as gene_id", "concat('S', l_partkey % 50) as symbol",
    )


def v_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("user_id % 10 as chrom", "event_id * 5 as s", "event_id * 5 + 5 as e", "value")


def v_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("d", "x")).selectExpr("cast(d as bigint) as gene_id", "cast(label as string) as label", "cast(x as double) as value")


SQL = {
    "v_reads": f"""SELECT sample_id, '@r' || doc_id || '.' || piece AS read_id, doc_id, piece, substr(letters, piece * {READ} + 1, {READ}) AS seq FROM (
        SELECT *, unnest(range(0, greatest((length(letters) + {READ - 1}) // {READ}, 1))) AS piece FROM (
        SELECT source AS sample_id, doc_id, translate(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '{LETTERS}', '{BASES}') AS letters FROM documents))""",
    "v_pairs": """SELECT sample_id, doc_id, piece, read_id || '_' || translate(reverse(substr(seq, 40 - n % 12, 14)), 'ACGT', 'TGCA') AS read_id,
        substr(seq, 1, 45 - n % 7) AS seq1, repeat('I', 45 - n % 7) AS qual1, substr(seq, 46 - n % 7, 100) AS seq2 FROM (SELECT *, doc_id + piece AS n FROM v_reads)""",
    "v_aln": """SELECT l_suppkey % 4 AS sample_id, CAST(l_orderkey AS VARCHAR) AS qname,
        1 + CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END + CASE WHEN l_partkey % 2 = 1 THEN 16 ELSE 0 END + CASE WHEN l_quantity > 48 THEN 256 ELSE 0 END AS flag,
        CAST(l_suppkey % 10 AS VARCHAR) AS chrom, l_partkey * 7 AS st, round(l_discount * 100) AS score, l_linenumber * 40 AS mapq,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE 1 + l_partkey % 2 END AS nh, CAST(l_quantity * 10 - 100 AS BIGINT) AS tlen,
        CAST(l_quantity AS BIGINT) AS m1, 10 * l_linenumber AS gap, l_partkey % 20 + 5 AS m2 FROM lineitem""",
    "v_pe": """SELECT l_suppkey % 4 AS sample_id, l_orderkey || '.' || l_linenumber || '_' || substr('AC', CAST(l_orderkey % 2 + 1 AS INTEGER), 1) || 'GT' || substr('AAAC', CAST(l_linenumber % 4 + 1 AS INTEGER), 1) AS qname,
        65 + 64 * second + CASE WHEN back THEN 16 ELSE 0 END AS flag, CAST((l_suppkey + CASE WHEN l_linenumber = 5 THEN second ELSE 0 END) % 10 AS VARCHAR) AS chrom,
        l_partkey * 7 + CASE WHEN back THEN 30 + CAST(l_quantity AS BIGINT) ELSE 0 END AS st, round(l_discount * 100) AS score, 255 - l_linenumber AS mapq, CASE WHEN l_linenumber = 4 THEN 2 ELSE 1 END AS nh,
        CASE WHEN back THEN -200 ELSE 200 END AS tlen, CAST(l_quantity AS BIGINT) AS m1, 10 * l_linenumber AS gap, l_partkey % 20 + 5 AS m2
        FROM (SELECT *, (l_partkey + second) % 2 = 1 AS back FROM lineitem, range(0, 2) t(second) WHERE NOT (second = 1 AND l_linenumber = 6))""",
    "v_iv": "SELECT l_suppkey % 10 AS chrom, l_partkey * 7 AS s, l_partkey * 7 + CAST(l_quantity AS BIGINT) AS e, l_discount AS w FROM lineitem",
    "v_exon": """SELECT p_partkey AS gene_id, p_partkey % 10 AS chrom, p_partkey * 7 AS s, p_partkey * 7 + p_size * 3 AS e, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
        p_name AS symbol, p_type AS gene_type FROM part""",
    "v_counts": """SELECT l_suppkey % 4 AS sample_id, l_partkey AS gene_id, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS sense,
        sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity ELSE 0 END) AS antisense FROM lineitem GROUP BY 1, 2""",
    "v_calls": """SELECT l_suppkey % 4 AS sample_id, l_linestatus AS caller, l_suppkey % 10 AS chrom, l_orderkey % 500 AS e, l_returnflag AS strand, l_partkey AS s, CAST(l_quantity AS BIGINT) AS reads,
        'g' || l_partkey % 50 AS gene_id, 'S' || l_partkey % 50 AS symbol FROM lineitem""",
    "v_signal": "SELECT user_id % 10 AS chrom, event_id * 5 AS s, event_id * 5 + 5 AS e, value FROM events",
    "v_profile": "SELECT CAST(d - 1 AS BIGINT) AS gene_id, CAST(label AS VARCHAR) AS label, CAST(embedding[d] AS DOUBLE) AS value FROM embeddings, range(1, 65) t(d)",
}


def sql(body: str, *views: str) -> str:
    """`body` behind the named views; body may begin with further views and a comma."""
    return "WITH " + ", ".join(f"{v} AS ({SQL[v]})" for v in views) + (" " if body.lstrip().upper().startswith("SELECT") else ", ") + body
