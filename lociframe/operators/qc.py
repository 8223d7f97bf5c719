"""Quality tables: long rows sample_id, ord, metric, value (text; a zero or missing number is NA)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.reads import format_count
from .tables import dropped, written


def shown(value: Column, zero: str = "NA") -> Column:
    """A number with two decimals at most; `zero` for 0, NA without a number."""
    number = value.cast("double")
    return F.when(number.isNull(), "NA").when(number == 0, zero).otherwise(format_count(F.round(number, 2)))


def wide_to_metrics(row: DataFrame, metrics: Sequence[tuple[str, Column]], first: int = 1, by: str = "sample_id") -> DataFrame:
    """The named numbers of a table of one row a sample, numbered from `first`."""
    parts = F.array(*[F.struct(F.lit(first + k).alias("ord"), F.lit(name).alias("metric"), shown(x).alias("value")) for k, (name, x) in enumerate(metrics)])
    return row.select(by, F.inline(parts))


def star_metrics(log: DataFrame, by: str = "sample_id") -> DataFrame:
    """One row a sample from log rows (metric, value): input, unique, multi, too_many, unmapped, mapped, percentages.

    Mapped at first are unique, multiple and too many loci; unmapped sums its three reasons.
    """
    value = lambda name: F.max(F.when(F.lower("metric") == name, F.expr("try_cast(value as double)")))
    names = {
        "input": "number of input reads", "unique": "uniquely mapped reads number", "multi": "number of reads mapped to multiple loci",
        "too_many": "number of reads mapped to too many loci", "u1": "number of reads unmapped: too many mismatches",
        "u2": "number of reads unmapped: too short", "u3": "number of reads unmapped: other", "splices": "number of splices: total",
    }
    row = log.groupBy(by).agg(*[value(v).alias(k) for k, v in names.items()])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    row = row.withColumn("mapped", zero("unique") + zero("multi") + zero("too_many")).withColumn("unmapped", zero("u1") + zero("u2") + zero("u3")).drop("u1", "u2", "u3")
    percent = lambda x: F.when(F.col("input") > 0, F.round(x * 100 / F.col("input"), 2))
    return row.withColumn("mapped_percent", percent(F.col("mapped"))).withColumn("unique_percent", percent(F.col("unique")))


#: Fixed names and orders of the quality table.
REGION_NAMES = {"3UTR": "3'UTR", "5UTR": "5'UTR", "downstream": "Downstream", "exon": "Exonic", "intergenic": "Intergenic", "intron": "Intronic", "promoter": "Promoter", "blacklist": "Blacklist"}
PICARD_KEYS = (
    "PF_BASES", "PF_ALIGNED_BASES", "RIBOSOMAL_BASES", "CODING_BASES", "UTR_BASES", "INTRONIC_BASES", "INTERGENIC_BASES", "IGNORED_READS", "CORRECT_STRAND_READS",
    "INCORRECT_STRAND_READS", "PCT_RIBOSOMAL_BASES", "PCT_CODING_BASES", "PCT_UTR_BASES", "PCT_INTRONIC_BASES", "PCT_INTERGENIC_BASES", "PCT_MRNA_BASES", "PCT_USABLE_BASES",
    "PCT_CORRECT_STRAND_READS", "MEDIAN_CV_COVERAGE", "MEDIAN_5PRIME_BIAS", "MEDIAN_3PRIME_BIAS", "MEDIAN_5PRIME_TO_3PRIME_BIAS", "MEDIAN_INSERT_SIZE",
)
RNA_TYPES = (
    "protein_coding", "lncRNAs", "pseudogenes", "miRNAs", "snoRNAs", "snRNAs", "rRNAs", "tRNAs", "circRNAs", "ERVs", "LINEs", "SINEs", "IG_genes", "TR_genes", "misc-sncRNAs",
    "TEC_protein_coding", "scaRNAs", "vault_RNAs", "Y_RNAs", "piRNAs", "artifact",
)


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100 / whole, 2)).otherwise(0.0)


def _log_row(log: DataFrame, by: str, prefix: str) -> DataFrame:
    """The numbers of a mapper's log (metric, value) that the quality table uses, as one row a sample."""
    names = {
        "input": "Number of input reads", "length": "Average input read length", "unique": "Uniquely mapped reads number", "several": "Number of reads mapped to multiple loci",
        "too_many": "Number of reads mapped to too many loci", "splices": "Number of splices: Total", "u1": "Number of reads unmapped: too many mismatches",
        "u2": "Number of reads unmapped: too short", "u3": "Number of reads unmapped: other", "chimeric": "Number of chimeric reads", "mismatch": "Mismatch rate per base, %",
    }
    value = lambda name: F.coalesce(F.max(F.when(F.lower("metric") == name.lower(), F.expr("try_cast(replace(value, '%', '') as double)"))), F.lit(0.0))
    return log.groupBy(by).agg(*[value(name).alias(f"{prefix}_{k}") for k, name in names.items()])


def qc_matrix(
    samples: DataFrame, fastqc: DataFrame | None = None, motif: DataFrame | None = None, trimmed: DataFrame | None = None, taxonomy: DataFrame | None = None, contaminants: DataFrame | None = None,
    first_log: DataFrame | None = None, log: DataFrame | None = None, strand: DataFrame | None = None, regions: DataFrame | None = None, picard: DataFrame | None = None, expression: DataFrame | None = None,
    by: str = "sample_id", read_thresholds: Sequence[float] = (1, 5, 10), expression_thresholds: Sequence[float] = (0.01, 0.1, 1.0),
) -> DataFrame:
    """by, ord, metric, value: the ordered quality table of every sample of `samples` (by), the whole cohort at once.

    Sources, each with `by`, any of which may be missing: fastqc (file, reads, gc, length as `n` or `low-high`), motif (ratio),
    trimmed (file, reads, mean_length), taxonomy (pct, name), contaminants (label: ecoli, mycoplasma, rRNA; reads), first_log and
    log (metric, value) of the mapping before and after UMI deduplication, strand (forward, reverse, undetermined as shares,
    splice_per_kb), regions (region_class, reads), picard (metric, value), expression (gene_type, read_counts, norm_expr).

    Every source becomes one row a sample, and the rows one table by joins on the sample. Percentages have two decimals; raw
    pairs are half the reads of two or more files; first-mapped fragments are those of unique, multiple and too many loci, and
    unmapped reads the sum of three reasons. A number that is missing or 0 is NA, but for the share left after trimming and the
    log's splices, unmapped and chimeric reads, mean length and mismatch rate, where 0 is 0.
    """
    wide = samples.select(by).distinct()
    have: set[str] = set()

    def add(source: DataFrame | None, *sums: Column) -> None:
        nonlocal wide
        if source is not None:
            own = source.groupBy(by).agg(*sums)
            have.update(c for c in own.columns if c != by)
            wide = wide.join(own, by, "left")

    col = lambda c: F.col(c) if c in have else F.lit(None).cast("double")
    zero = lambda c: F.coalesce(col(c).cast("double"), F.lit(0.0))
    bounds = F.transform(F.split("length", "-"), lambda x: x.cast("double"))
    length = F.aggregate(bounds, F.lit(0.0), lambda a, x: a + x) / F.size(bounds)
    add(fastqc, F.sum("reads").alias("raw"), F.count_distinct("file").alias("files"), F.avg("gc").alias("gc"), *([F.avg(length).alias("raw_length")] if fastqc is not None else []))
    add(motif, F.max("ratio").alias("motif"))
    add(trimmed, F.sum("reads").alias("left"), F.avg("mean_length").alias("left_length"))
    if taxonomy is not None:
        shares = taxonomy_share(taxonomy, by)
        have.update(c for c in shares.columns if c != by)
        wide = wide.join(shares, by, "left")
    labelled = lambda label: F.sum(F.when(F.col("label") == label, F.col("reads"))).alias(f"of_{label}")
    add(contaminants, *[labelled(x) for x in ("ecoli", "mycoplasma", "rRNA")])
    for prefix, source in (("first", first_log), ("star", log)):
        if source is not None:
            own = _log_row(source, by, prefix)
            have.update(c for c in own.columns if c != by)
            wide = wide.join(own, by, "left")
    add(strand, *[F.max(c).alias(c) for c in ("forward", "reverse", "undetermined", "splice_per_kb")])
    add(regions, *[F.sum(F.when(F.col("region_class") == c, F.col("reads"))).alias(f"in_{c}") for c in REGION_NAMES])
    add(picard, *[F.max(F.when(F.col("metric") == k, F.col("value").cast("string"))).alias(f"picard_{k}") for k in PICARD_KEYS])
    tests = [("read_counts", "Read Counts", t) for t in read_thresholds] + [("norm_expr", "TPM/CPM", t) for t in expression_thresholds]
    of_type = lambda rna, x: F.when(F.col("gene_type") == rna, x)
    number = lambda c: F.coalesce(F.expr(f"try_cast({c} as double)"), F.lit(0.0))
    genes = [F.sum(of_type(rna, (number(c) > t).cast("long"))).alias(f"genes_{r}_{k}") for r, rna in enumerate(RNA_TYPES) for k, (c, _, t) in enumerate(tests)] if expression is not None else []
    reads = [F.sum(of_type(rna, number("read_counts"))).alias(f"reads_{r}") for r, rna in enumerate(RNA_TYPES)] if expression is not None else []
    add(expression, *genes, *reads, F.sum(F.coalesce(F.expr("try_cast(read_counts as double)"), F.lit(0.0))).alias("reads_all"))

    mapped = zero("first_unique") + zero("first_several") + zero("first_too_many")
    multi = zero("star_several") + zero("star_too_many")
    of_regions = sum((zero(f"in_{c}") for c in REGION_NAMES), F.lit(0.0))
    plain = [
        ("Total Raw Reads (R1+R2)", shown(col("raw"))), ("Total Raw Read Pairs (Fragments)", shown(F.floor(F.when(col("files") >= 2, col("raw") / 2).otherwise(col("raw"))))),
        ("%GC of Raw Reads", shown(col("gc"))), ("Average Raw Read Length", shown(F.bround(col("raw_length")))), ("ACC motif fraction from UMI region", F.coalesce(col("motif").cast("string"), F.lit("NA"))),
        ("Total Trimmed Reads (R1+R2)", shown(col("left"))), ("Average Trimmed Read Length", shown(F.bround(col("left_length")))),
        ("Percentage of Reads Remaining after Trimming", F.when(zero("raw") > 0, shown(_percent(zero("left"), zero("raw")), "0")).otherwise("NA")),
        ("Percentage of Reads Mapped to Human (Kraken)", shown(col("homo_sapiens"))), ("Percentage of Reads Mapped to Bacteria (Kraken)", shown(col("bacteria"))),
        ("Number of Reads Mapped to Escherichia coli (BBSplit)", shown(col("of_ecoli"))), ("Percentage of Trimmed Reads Mapped to E. coli (BBSplit)", shown(_percent(zero("of_ecoli"), zero("left")))),
        ("Number of Reads Mapped to Mycoplasma (BBSplit)", shown(col("of_mycoplasma"))), ("Percentage of Trimmed Reads Mapped to Mycoplasma (BBSplit)", shown(_percent(zero("of_mycoplasma"), zero("left")))),
        ("Percentage of Trimmed Reads Mapped to rRNAs (RiboDetector)", shown(_percent(zero("of_rRNA"), zero("left")))),
        ("Total Fragments Mapped to Human (First STAR)", shown(mapped)), ("Number of Reads after UMI-deduplication (STAR Input)", shown(col("star_input"))),
        ("Percentage of UMI-dedup Fragments", shown(_percent(zero("star_input"), mapped))), ("Average Mapped Read Length (STAR)", shown(zero("star_length"), "0")),
        ("Percentage of Mapped Reads on Forward Strand", shown(F.round(zero("forward") * 100, 2))), ("Percentage of Mapped Reads on Reverse Strand", shown(F.round(zero("reverse") * 100, 2))),
        ("Percentage of Mapped Reads with Failed Strand", shown(F.round(zero("undetermined") * 100, 2))), ("Splices per Kilobase (splice/kb, DNA contamination metric)", F.coalesce(col("splice_per_kb").cast("string"), F.lit("NA"))),
        ("Number of Uniquely Mapped Reads (STAR)", shown(col("star_unique"))), ("Percentage of Uniquely Mapped Reads (vs STAR Input)", shown(_percent(zero("star_unique"), zero("star_input")))),
        ("Number of Multi-mapped Reads (STAR)", shown(multi)), ("Percentage of Multi-mapped Reads (vs STAR Input)", shown(_percent(multi, zero("star_input")))),
        ("Number of Splices (from unique reads, STAR)", shown(zero("star_splices"), "0")), ("Number of Unmapped Reads (STAR)", shown(zero("star_u1") + zero("star_u2") + zero("star_u3"), "0")),
        ("Number of Chimeric Reads (STAR)", shown(zero("star_chimeric"), "0")), ("Mismatch Rate per Base (STAR)", F.concat(shown(zero("star_mismatch"), "0"), F.lit("%")) if log is not None else F.lit("NA")),
    ]
    plain += [(f"Number of Reads Mapped to {name} Regions", shown(col(f"in_{c}"))) for c, name in REGION_NAMES.items()]
    plain += [(f"Percentage of Reads Mapped to {name} Regions", shown(_percent(zero(f"in_{c}"), of_regions))) for c, name in REGION_NAMES.items()]
    plain += [(f"PICARD_{k}", F.coalesce(col(f"picard_{k}").cast("string"), F.lit("NA"))) for k in PICARD_KEYS]
    plain += [(f"Expressed {rna} Genes ({name} > {t:g})", shown(col(f"genes_{r}_{k}"))) for r, rna in enumerate(RNA_TYPES) for k, (_, name, t) in enumerate(tests)]
    plain += [(f"Number of Reads Mapped to {rna}", shown(col(f"reads_{r}"))) for r, rna in enumerate(RNA_TYPES)]
    plain += [(f"Percentage of Reads Mapped to {rna}", shown(_percent(zero(f"reads_{r}"), zero("reads_all")))) for r, rna in enumerate(RNA_TYPES)]
    rows = F.array(*[F.struct(F.lit(k + 1).alias("ord"), F.lit(name).alias("metric"), value.alias("value")) for k, (name, value) in enumerate(plain)])
    return wide.select(by, F.inline(rows))


def qc_cohort(matrix: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row a sample, one column a metric."""
    return matrix.groupBy("sample_id").pivot("metric", list(metrics)).agg(F.first("value"))


def taxonomy_share(report: DataFrame, by: str = "sample_id", names: Sequence[str] = ("Homo sapiens", "Bacteria")) -> DataFrame:
    """by and one column a name: its percent in the report (pct, name), 0 without it."""
    part = lambda n: F.coalesce(F.max(F.when(F.trim("name") == n, F.col("pct"))), F.lit(0.0)).alias(n.lower().replace(" ", "_"))
    return report.groupBy(by).agg(*[part(n) for n in names])


def report_parents(report: DataFrame, by: Sequence[str] = ("sample_id",), line: str = "line", name: str = "name", taxid: str = "taxid") -> DataFrame:
    """by, taxid, parent: the taxonomy that a report's lines show by two blanks of indentation a level; a line's parent is the last
    one before it that is indented by one level less (null for none). Lines of one depth are looked at together, not a report."""
    own = report.select(*by, line, taxid, F.floor((F.length(name) - F.length(F.ltrim(name))) / 2).alias("depth"))
    both = own.select(*by, line, taxid, "depth", F.lit(None).cast(own.schema[taxid].dataType).alias("above"))
    both = both.unionByName(own.select(*by, line, F.lit(None).cast(own.schema[taxid].dataType).alias(taxid), (F.col("depth") + 1).alias("depth"), F.col(taxid).alias("above")))
    order = Window.partitionBy(*by, "depth").orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("parent", F.last("above", ignorenulls=True).over(order)).where(F.col(taxid).isNotNull()).select(*by, taxid, "parent")


def clade_rollup(direct: DataFrame, parents: DataFrame) -> DataFrame:
    """taxid, reads: own reads of a taxon (direct: taxid, reads) and of all under it (parents: taxid, parent; a root has none, or
    itself), for every taxon of either table.

    Every round adds to a taxon what its descendants that are 1, 2, 4, 8 ... levels below have gathered and doubles how far a
    pointer reaches, so rounds grow with the logarithm of the depth. Pointers that outlast all levels lie on cycles or lead
    into one: that is an error, which names some of them. A null taxid is left out; of several parents the least counts.
    """
    up = parents.where("taxid is not null and parent is not null and taxid <> parent").groupBy("taxid").agg(F.min("parent").alias("far"))
    jump = written(up)
    names = parents.select("taxid").unionByName(parents.select(F.col("parent").alias("taxid"))).unionByName(direct.select("taxid")).where("taxid is not null").distinct()
    reads = direct.where("taxid is not null").groupBy("taxid").agg(F.sum("reads").alias("reads"))
    sums = written(names.join(reads, "taxid", "left").select("taxid", F.coalesce("reads", F.lit(0)).alias("reads")))
    levels, reach = sums.count(), 1
    while not jump.isEmpty():
        if reach > levels:
            found = [r[0] for r in jump.select("taxid").orderBy("taxid").limit(20).collect()]
            raise ValueError(f"the taxonomy has cycles; among the taxa on or under one: {found}")
        gain = sums.join(jump, "taxid").groupBy(F.col("far").alias("taxid")).agg(F.sum("reads").alias("gain"))
        more = written(sums.join(gain, "taxid", "left").select("taxid", (F.col("reads") + F.coalesce("gain", F.lit(0))).alias("reads")))
        further = written(jump.join(jump.select(F.col("taxid").alias("far"), F.col("far").alias("__far")), "far").select("taxid", F.col("__far").alias("far")))
        dropped(sums, jump)
        sums, jump, reach = more, further, reach * 2
    dropped(jump)
    return sums


def unpivot_percent_metrics(picard: DataFrame, by: str = "sample_id") -> DataFrame:
    """by, category, percentage from the PCT_ columns."""
    columns = [c for c in picard.columns if c.startswith("PCT_")]
    parts = F.array(*[F.struct(F.lit(c[4:].replace("_", " ").title()).alias("category"), (F.col(c).cast("double") * 100).alias("percentage")) for c in columns])
    return picard.select(by, F.inline(parts))
