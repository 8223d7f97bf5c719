"""Readers and writers of tab-separated tables. Every reader gives `sample_id` from its argument or the file's name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.align import parse_cigar


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).withColumn("file", F.input_file_name())


def _field(k: int, kind: str = "string") -> Column:
    part = F.try_element_at(F.col("f"), F.lit(k))
    return part if kind == "string" else F.expr(f"try_cast(try_element_at(f, {k}) as {kind})")


def _split(spark: SparkSession, path: str | list[str], sep: str = "\t", skip: str = "#") -> DataFrame:
    kept = _lines(spark, path).where((F.col("value") != "") & ~F.col("value").startswith(skip))
    return kept.withColumn("f", F.split("value", sep))


def gene_id_of(attributes: Column) -> Column:
    quoted = F.regexp_extract(attributes, r'gene_id\s+"([^"]+)"', 1)
    plain = F.regexp_extract(attributes, r"gene_id\s+([^;\s\"]+)", 1)
    return F.coalesce(F.nullif(quoted, F.lit("")), F.nullif(plain, F.lit("")))


def read_gtf_exons(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, chrom, s (0-based), e, strand of the exon rows; rows without gene, strand or extent are left out."""
    rows = _split(spark, path).where(_field(3) == "exon")
    out = rows.select(gene_id_of(_field(9)).alias("gene_id"), _field(1).alias("chrom"), (_field(4, "bigint") - 1).alias("s"), _field(5, "bigint").alias("e"), _field(7).alias("strand"))
    return out.where((F.col("s") >= 0) & (F.col("e") > F.col("s")) & F.col("strand").isin("+", "-") & F.col("gene_id").isNotNull())


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """region_id, chrom, s, e, name, strand from 3 or 6 columns; a strand other than + or - becomes `.`."""
    rows = _split(spark, path).where(~F.col("value").rlike(r"^(track|browser)\b")).where(F.size("f").isin(3, 6))
    out = rows.select(_field(1).alias("chrom"), _field(2, "bigint").alias("s"), _field(3, "bigint").alias("e"), _field(4).alias("name"), F.when(_field(6).isin("+", "-"), _field(6)).otherwise(".").alias("strand"))
    place = F.concat(F.col("chrom"), F.lit("_"), F.col("s"), F.lit(":"), F.col("e"))
    return out.where("s is not null and e > s").select(F.concat_ws(":", place, "name").alias("region_id"), "chrom", "s", "e", "name", "strand")


def read_saf(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """region_class, region_id, chrom, s (0-based), e, strand of one file a class; a file that is missing is skipped."""
    out = None
    for name, path in paths.items():
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
            continue
        rows = _split(spark, path).where(_field(3, "bigint").isNotNull())
        part = rows.select(F.lit(name).alias("region_class"), _field(1).alias("region_id"), _field(2).alias("chrom"), (_field(3, "bigint") - 1).alias("s"), _field(4, "bigint").alias("e"), _field(5).alias("strand"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "region_class string, region_id string, chrom string, s bigint, e bigint, strand string")


def read_counts(spark: SparkSession, path: str, sample_id: str) -> DataFrame:
    """sample_id, gene_id, length, count from a featureCounts table: column 6 and the last; other rows are skipped."""
    rows = _split(spark, path).where(F.size("f") >= 7)
    last = F.expr("try_cast(try_element_at(f, -1) as double)")
    out = rows.select(F.lit(sample_id).alias("sample_id"), _field(1).alias("gene_id"), _field(6, "double").alias("length"), last.alias("count"))
    return out.where("length is not null and count is not null")


def read_rsem(spark: SparkSession, path: str, sample_id: str) -> DataFrame:
    table = spark.read.option("header", True).option("sep", "\t").csv(path)
    return table.select(F.lit(sample_id).alias("sample_id"), "gene_id", F.expr("try_cast(expected_count as double)").alias("count"), F.expr("try_cast(TPM as double)").alias("tpm"))


def read_gene_meta(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, symbol, gene_type; blanks are NA, and of rows with one id the last in the file counts. Rows without tabs are
    split at white space."""
    lines = _lines(spark, path).where("value != ''").withColumn("line", F.monotonically_increasing_id())
    rows = lines.withColumn("f", F.when(F.col("value").contains("\t"), F.split("value", "\t")).otherwise(F.split(F.trim("value"), r"\s+")))
    blank = lambda k: F.coalesce(F.nullif(F.trim(_field(k)), F.lit("")), F.lit("NA"))
    out = rows.select("line", _field(1).alias("gene_id"), blank(2).alias("symbol"), blank(3).alias("gene_type")).where("lower(gene_id) <> 'geneid'")
    last = Window.partitionBy("gene_id").orderBy(F.desc("line"))
    return out.withColumn("nth", F.row_number().over(last)).where("nth = 1").select("gene_id", "symbol", "gene_type")


def read_sam(spark: SparkSession, path: str, sample_id: str) -> DataFrame:
    """Alignment rows of a text SAM file; nh and score are null without their tags."""
    rows = _split(spark, path, skip="@").where(F.size("f") >= 11)
    tag = lambda name: F.expr(f"try_cast(nullif(regexp_extract(value, '\\t{name}:i:(-?[0-9]+)', 1), '') as double)")
    return rows.select(
        F.lit(sample_id).alias("sample_id"), _field(1).alias("qname"), _field(2, "int").alias("flag"), _field(3).alias("chrom"), (_field(4, "bigint") - 1).alias("st"), _field(5, "int").alias("mapq"),
        _field(6).alias("cigar"), _field(9, "bigint").alias("tlen"), _field(10).alias("seq"), _field(11).alias("qual"), tag("NH").cast("int").alias("nh"), tag("AS").alias("score"), parse_cigar(_field(6)).alias("ops"),
    )


def read_star_log(spark: SparkSession, path: str, sample_id: str) -> DataFrame:
    """sample_id, metric, value of the `key | value` lines, percent signs removed."""
    rows = _lines(spark, path).where(F.col("value").contains("|")).withColumn("f", F.split("value", r"\|", 2))
    return rows.select(F.lit(sample_id).alias("sample_id"), F.trim(_field(1)).alias("metric"), F.regexp_replace(F.regexp_replace(_field(2), r"^\s+|\s+$", ""), "%$", "").alias("value"))


def read_taxonomy_report(spark: SparkSession, path: str, sample_id: str) -> DataFrame:
    rows = _split(spark, path).where(F.size("f") >= 6)
    return rows.select(F.lit(sample_id).alias("sample_id"), F.expr("try_cast(trim(f[0]) as double)").alias("pct"), _field(2, "bigint").alias("clade_reads"), _field(3, "bigint").alias("direct_reads"), _field(4).alias("rank"), _field(5, "bigint").alias("taxid"), F.trim(_field(6)).alias("name"))


def sniff_separator(line: str) -> str:
    """The most frequent of comma, tab, semicolon and bar in a line; the first of these without any."""
    marks = (",", "\t", ";", "|")
    return max(marks, key=lambda m: (line.count(m), -marks.index(m)))


def read_profile_matrix(spark: SparkSession, path: str, id_columns: Sequence[str] = ("Ensembl_ID", "Gene_symbol"), wanted: str = "Gene_symbol") -> DataFrame:
    """gene_id, label, value of a gene x label matrix; the id column is `wanted` (case and `_` do not matter), else another
    of `id_columns`, else the first; the other id columns are left out."""
    head = spark.read.text(path).head(1)
    table = spark.read.option("header", True).option("sep", sniff_separator(head[0][0] if head else "")).csv(path)
    plain = lambda c: c.lower().replace("_", "")
    by_name = {plain(c): c for c in table.columns}
    own = next((by_name[plain(c)] for c in (wanted, *id_columns) if plain(c) in by_name), table.columns[0])
    labels = [c for c in table.columns if c != own and plain(c) not in {plain(x) for x in id_columns}]
    long = table.unpivot([own], labels, "label", "value")
    return long.select(F.col(f"`{own}`").alias("gene_id"), "label", F.expr("try_cast(value as double)").alias("value")).where("value is not null")


def read_single_sample_expr(spark: SparkSession, path: str) -> DataFrame:
    """sample_id (the file's stem), gene_id, value of a file of exactly two columns; rows without a number are left out."""
    head = spark.read.text(path).head(1)
    table = spark.read.option("sep", sniff_separator(head[0][0] if head else "")).csv(path)
    if len(table.columns) != 2:
        raise ValueError(f"two columns are needed, {path} has {len(table.columns)}")
    stem = path.rstrip("/").rpartition("/")[2].partition(".")[0]
    return table.select(F.lit(stem).alias("sample_id"), F.col("_c0").alias("gene_id"), F.expr("try_cast(_c1 as double)").alias("value")).where("value is not null")


def read_fastqc_basic(spark: SparkSession, path: str, sample_id: str) -> DataFrame:
    """One row a file: total, gc, length (the middle of a range) of the Basic Statistics block."""
    value = lambda name: F.max(F.when(_field(1) == name, _field(2)))
    rows = _lines(spark, path).withColumn("f", F.split("value", "\t"))
    out = rows.groupBy("file").agg(value("Total Sequences").cast("double").alias("total"), value("%GC").cast("double").alias("gc"), value("Sequence length").alias("range"))
    ends = F.split("range", "-")
    middle = F.when(F.size(ends) == 2, (ends[0].cast("double") + F.try_element_at(ends, F.lit(2)).cast("double")) / 2).otherwise(ends[0].cast("double"))
    return out.select(F.lit(sample_id).alias("sample_id"), "total", "gc", middle.alias("length"))


def read_picard_metrics(spark: SparkSession, path: str | list[str], sample_id: str | None = None) -> DataFrame:
    """sample_id (the file's stem, if not given), metric, value: of every file the first line that is neither empty nor a comment
    as names, and the one behind it as values. A file is one row (they are short), and none is read while the plan is made."""
    files = spark.read.text(path, wholetext=True)
    stem = F.regexp_extract(F.input_file_name(), r"([^/.]+)[^/]*$", 1)
    used = F.filter(F.split("value", r"\r?\n"), lambda x: (F.trim(x) != "") & ~x.startswith("#"))
    part = lambda k: F.split(F.try_element_at("used", F.lit(k)), "\t")
    rows = files.select((F.lit(sample_id) if sample_id is not None else stem).alias("sample_id"), used.alias("used")).where(F.size("used") > 1)
    pairs = rows.select("sample_id", F.inline(F.arrays_zip(part(1).alias("metric"), part(2).alias("value"))).alias("metric", "value"))
    return pairs.where("metric is not null and value is not null")


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_bedgraph(coverage: DataFrame, path: str, lengths: DataFrame | None = None, least: float = 1e-9) -> None:
    """chrom, s, e, value in order of place, clamped to the chromosome (chrom, length); levels up to `least` are left out."""
    own = coverage
    if lengths is not None:
        own = own.join(lengths, "chrom").withColumn("s", F.greatest("s", F.lit(0))).withColumn("e", F.least("e", "length")).where("s < e")
    rows = own.where(F.col("value") > least).select("chrom", "s", "e", "value")
    rows.repartitionByRange("chrom", "s").sortWithinPartitions("chrom", "s").write.mode("overwrite").option("sep", "\t").csv(path)


def write_sorted(df: DataFrame, path: str, key: str = "gene_id") -> None:
    write_tsv(df.orderBy(key), path)
