"""Expression operators: counts to TPM, annotation, biotypes, top genes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Fixed lists: RNA types of the two groups, and threshold sets.
SMALL_RNA = ("piRNAs", "misc-sncRNAs", "miRNAs", "snRNAs", "snoRNAs", "tRNAs", "Y_RNAs", "scaRNAs", "vault_RNAs")
LONG_RNA = ("SINEs", "LINEs", "ERVs", "protein_coding", "lncRNAs", "pseudogenes", "TEC_protein_coding", "IG_genes", "rRNAs", "TR_genes", "circRNAs")
THRESHOLDS = {"norm_expr": (0.001, 0.1, 0.2, 0.5, 1), "read_counts": (1, 5, 10, 20, 50)}
QC_THRESHOLDS = {"read_counts": (1, 5, 10), "norm_expr": (0.01, 0.1, 1.0)}


def share_of_total(df: DataFrame, value: str, by: Sequence[str], name: str = "share") -> DataFrame:
    """value / its sum over `by`, by a join with the totals; null where the total is 0."""
    total = df.groupBy(*by).agg(F.sum(value).alias("__total"))
    return df.join(total, list(by)).withColumn(name, F.when(F.col("__total") != 0, F.col(value) / F.col("__total"))).drop("__total")


def tpm(counts: DataFrame, by: Sequence[str] = ("sample_id",), count: str = "count", length: str = "length") -> DataFrame:
    """Adds tpm; rows without a positive count and length are left out."""
    used = countable(counts, count, length).withColumn("__rpk", F.col(count) * 1000.0 / F.col(length))
    return share_of_total(used, "__rpk", by, "tpm").withColumn("tpm", F.col("tpm") * 1e6).drop("__rpk")


def effective_length(length: Column, mean_fragment: float | Column) -> Column:
    return F.greatest(F.lit(1.0), length - mean_fragment + 1)


def tpm_effective(counts: DataFrame, mean_fragment: float, by: Sequence[str] = ("sample_id",), length: str = "length") -> DataFrame:
    """Adds tpm_uniq and tpm from count_uniq and count_total; both are shares of the total's sum."""
    rpk = lambda c: F.col(c) / (effective_length(F.col(length).cast("double"), mean_fragment) / 1000)
    total = counts.groupBy(*by).agg(F.sum(rpk("count_total")).alias("__all"))
    scaled = lambda c: F.when(F.col("__all") > 0, rpk(c) * 1e6 / F.col("__all")).otherwise(0.0)
    return counts.join(total, list(by)).withColumn("tpm_uniq", scaled("count_uniq")).withColumn("tpm", scaled("count_total")).drop("__all")


def last_wins(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row a key: that of the greatest `order`."""
    last = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("__nth", F.row_number().over(last)).where("__nth = 1").drop("__nth")


def annotate(df: DataFrame, meta: DataFrame, default: str = "NA", key: str = "gene_id", columns: Sequence[str] = ("symbol", "gene_type")) -> DataFrame:
    """Left join with the gene table; what it lacks, or has blank, becomes `default`."""
    clean = meta.select(key, *[F.nullif(F.trim(c), F.lit("")).alias(c) for c in columns])
    joined = df.join(clean, key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(default)) for c in columns})


def annotate_inner(df: DataFrame, meta: DataFrame, key: str = "gene_id") -> DataFrame:
    return df.join(meta, key)


def strand_subtract(sense: DataFrame, antisense: DataFrame, keys: Sequence[str], count: str = "count") -> DataFrame:
    """Sense minus antisense counts, not under 0; a gene without antisense counts keeps its own."""
    other = antisense.select(*keys, F.col(count).alias("__other"))
    return sense.join(other, list(keys), "left").withColumn(count, F.greatest(F.col(count) - F.coalesce("__other", F.lit(0.0)), F.lit(0.0))).drop("__other")


def combine_expression(linear: DataFrame, circ: DataFrame) -> DataFrame:
    """One matrix sample_id, gene_id, symbol, gene_type, read_counts, norm_expr from linear (tpm) and circular (cpm) RNA."""
    a = drop_artifact(linear).select("sample_id", "gene_id", "symbol", "gene_type", F.col("count").cast("double").alias("read_counts"), F.col("tpm").alias("norm_expr"))
    b = circ.select("sample_id", F.col("circ_id1").alias("gene_id"), F.col("circ_id3").alias("symbol"), F.lit("circRNAs").alias("gene_type"), F.col("reads").cast("double").alias("read_counts"), F.col("cpm").alias("norm_expr"))
    return a.unionByName(b)


def project_expression(matrix: DataFrame) -> DataFrame:
    return matrix.select("sample_id", "gene_id", "norm_expr")


def expressed_by_threshold(matrix: DataFrame, metrics: dict[str, Sequence[float]] = THRESHOLDS, by: Sequence[str] = ("sample_id", "gene_type")) -> DataFrame:
    """by, metric, threshold, genes: how many exceed it. Every threshold is one conditional sum of a single pass."""
    tests = [(m, float(t)) for m, ts in metrics.items() for t in ts]
    sums = matrix.groupBy(*by).agg(*[F.sum((F.coalesce(F.expr(f"try_cast({m} as double)"), F.lit(float("-inf"))) > t).cast("int")).alias(f"c{k}") for k, (m, t) in enumerate(tests)])
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(t).alias("threshold"), F.col(f"c{k}").alias("genes")) for k, (m, t) in enumerate(tests)])
    return sums.select(*by, F.inline(rows))


def composition_percent(counts: DataFrame, small: Sequence[str] = SMALL_RNA, long: Sequence[str] = LONG_RNA, by: Sequence[str] = ("sample_id", "metric", "threshold")) -> DataFrame:
    """Adds rna_group (Small, Long) and percent of its genes; other types are left out, an empty group counts 0."""
    group = F.when(F.col("gene_type").isin(*small), "Small").when(F.col("gene_type").isin(*long), "Long")
    used = counts.withColumn("rna_group", group).where("rna_group is not null")
    total = used.groupBy(*by, "rna_group").agg(F.sum("genes").alias("__all"))
    return used.join(total, [*by, "rna_group"]).withColumn("percent", F.col("genes") * 100.0 / F.greatest("__all", F.lit(1))).drop("__all")


def reads_by_biotype(matrix: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """by, gene_type, reads, percent (2 decimals)."""
    sums = matrix.groupBy(*by, "gene_type").agg(F.sum("read_counts").alias("reads"))
    return share_of_total(sums, "reads", by, "percent").withColumn("percent", F.round(F.col("percent") * 100, 2))


def genes_seen(tables: Sequence[DataFrame], valid: DataFrame, key: str = "gene_id") -> DataFrame:
    """The genes that any of the tables holds, among the valid ones."""
    seen = tables[0].select(key)
    for more in tables[1:]:
        seen = seen.union(more.select(key))
    return seen.distinct().join(valid, key, "left_semi")


def id_sets(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Distinct keys that only `a` holds, and those that both hold."""
    return a.select(key).subtract(b.select(key)), a.select(key).intersect(b.select(key))


def drop_artifact(matrix: DataFrame, artifact: str = "artifact") -> DataFrame:
    """Without rows of the type `artifact`; rows without a type stay."""
    return matrix.where(~F.col("gene_type").eqNullSafe(artifact))


def countable(counts: DataFrame, count: str = "count", length: str = "length") -> DataFrame:
    """Rows with a positive count and a positive length."""
    return counts.where((F.col(count) > 0) & (F.col(length) > 0))


def expressed(matrix: DataFrame, value: str = "norm_expr") -> DataFrame:
    return matrix.where(F.col(value) > 0)


def remaining_genes(matrix: DataFrame, selected: DataFrame, keys: Sequence[str] = ("sample_id", "gene_id")) -> DataFrame:
    """The rows whose keys are not among the selected ones."""
    return matrix.join(selected.select(*keys).distinct(), list(keys), "left_anti")


def top_n_per_group(df: DataFrame, group: Sequence[str], n: int, value: str, tie: str) -> DataFrame:
    best = Window.partitionBy(*group).orderBy(F.desc(value), tie)
    return df.withColumn("__nth", F.row_number().over(best)).where(F.col("__nth") <= n).drop("__nth")


def top_genes(matrix: DataFrame, n_per_type: int = 5, total: int = 100, sample: str = "sample_id") -> DataFrame:
    """Of each sample, the n best of every type, filled up with the best of the rest to `total` genes, or cut to it."""
    live = expressed(matrix)
    first = top_n_per_group(live, [sample, "gene_type"], n_per_type, "norm_expr", "gene_id").withColumn("round", F.lit(1))
    rest = remaining_genes(live, first, [sample, "gene_id"]).withColumn("round", F.lit(2))
    ranked = Window.partitionBy(sample).orderBy("round", F.desc("norm_expr"), "gene_id")
    # the rest is cut to `total` rows a sample before it meets the first
    rest = top_n_per_group(rest, [sample], total, "norm_expr", "gene_id")
    both = first.unionByName(rest.select(*first.columns)).withColumn("__nth", F.row_number().over(ranked)).where(F.col("__nth") <= total)
    return both.drop("__nth", "round")


def mean_by_type(selected: DataFrame, by: Sequence[str] = ("sample_id", "gene_type")) -> DataFrame:
    return selected.groupBy(*by).agg(F.avg("norm_expr").alias("mean_expr"))


def order_types_by_total(counts: DataFrame) -> DataFrame:
    """gene_type, total, place: types from the greatest total down."""
    totals = counts.groupBy("gene_type").agg(F.sum("genes").alias("total"))
    return totals.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("total"), "gene_type")))


def gene_model(exons: DataFrame, gene: str = "gene_id", keys: Sequence[str] = ("chrom", "strand")) -> DataFrame:
    """gene_id, length, exons: union length and number of merged exons, summed over places if a gene has several."""
    from .intervals import merge_intervals

    merged = merge_intervals(exons, [gene, *keys])
    return merged.groupBy(gene).agg(F.sum(F.col("e") - F.col("s")).alias("length"), F.count(F.lit(1)).alias("exons"))


def multi_locus_genes(exons: DataFrame, gene: str = "gene_id") -> DataFrame:
    """Genes with exons on more than one chromosome or strand, and on how many."""
    return exons.groupBy(gene).agg(F.count_distinct(F.struct("chrom", "strand")).alias("loci")).where("loci > 1")


def single_locus_exons(exons: DataFrame, gene: str = "gene_id") -> DataFrame:
    return exons.join(multi_locus_genes(exons, gene).select(gene), gene, "left_anti")


def signal_expression(signals: DataFrame, lengths: DataFrame, sample: str = "sample_id") -> DataFrame:
    """CPM and TPM from signal (sample_id, gene_id, strand, f1r2, f2r1): unstranded, forward and reverse.

    On a minus gene forward is F2R1. CPM of forward and reverse divide by the whole F1R2 and F2R1 signal whatever the
    strand; every TPM divides by the unstranded sum. A total of 0 gives null.
    """
    own = signals.join(lengths, "gene_id").withColumn("both", F.col("f1r2") + F.col("f2r1"))
    own = own.withColumn("fwd", F.when(F.col("strand") == "-", F.col("f2r1")).otherwise(F.col("f1r2"))).withColumn("rev", F.when(F.col("strand") == "-", F.col("f1r2")).otherwise(F.col("f2r1")))
    kb = F.col("length") / 1000.0
    total = own.groupBy(sample).agg(F.sum("both").alias("t"), F.sum("f1r2").alias("t1"), F.sum("f2r1").alias("t2"), F.sum(F.col("both") / kb).alias("r"))
    of = lambda x, by: F.when(F.col(by) > 0, x * 1e6 / F.col(by))
    return own.join(total, sample).select(
        sample, "gene_id",
        of(F.col("both"), "t").alias("cpm"), of(F.col("fwd"), "t1").alias("cpm_forward"), of(F.col("rev"), "t2").alias("cpm_reverse"),
        of(F.col("both") / kb, "r").alias("tpm"), of(F.col("fwd") / kb, "r").alias("tpm_forward"), of(F.col("rev") / kb, "r").alias("tpm_reverse"),
    )
