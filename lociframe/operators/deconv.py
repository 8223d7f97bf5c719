"""Comparing expression with reference profiles: long tables gene_id, label, value (profile), sample_id, gene_id, value."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .tables import written

#: Fixed lists: marker genes and labels of one sex.
X_MARKERS, Y_MARKERS = ("XIST",), ("RPS4Y1", "RPS4Y2", "KDM5D", "DDX3Y", "USP9Y")
ENSEMBL_MARKERS = {
    "ENSG00000229807": "XIST", "ENSG00000129824": "RPS4Y1", "ENSG00000280969": "RPS4Y2", "ENSG00000012817": "KDM5D", "ENSG00000067048": "DDX3Y", "ENSG00000114374": "USP9Y",
}
MALE_LABELS = ("Prostate", "Testis")
FEMALE_LABELS = ("Ovary", "Uterus", "Vagina", "Cervix uteri", "Fallopian tube")
SEXLESS_FILE = "brain|cortex|neuron|cerebellum"


def profile_gene_mean(profile: DataFrame) -> DataFrame:
    return profile.groupBy("gene_id", "label").agg(F.avg("value").alias("value"))


def duplicated_genes(expr: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Genes that a sample holds more than once, which is an error in it."""
    return expr.groupBy(*by, "gene_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def align_to_reference(expr: DataFrame, reference: DataFrame) -> DataFrame:
    """sample_id, gene_id, value for every gene of the reference; what a sample lacks is 0.

    The result has a row for each sample and gene by definition. What a sample holds of the reference is taken as it is;
    samples that hold fewer genes than the reference get the rest, by an equality join on parts of the gene list."""
    genes = written(reference.select("gene_id").where("gene_id is not null").distinct())
    held = written(expr.select("sample_id", "gene_id", "value").join(genes, "gene_id", "left_semi"))
    of, parts = genes.count(), F.expr("pmod(xxhash64(gene_id), 64)").cast("int")
    counts = held.groupBy("sample_id").agg(F.count_distinct("gene_id").alias("n"))
    short = expr.select("sample_id").distinct().join(counts, "sample_id", "left").where(F.coalesce("n", F.lit(0)) < of)
    slots = short.select("sample_id", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("part"))
    every = slots.join(genes.withColumn("part", parts), "part").select("sample_id", "gene_id")
    lacking = every.join(held.select("sample_id", "gene_id"), ["sample_id", "gene_id"], "left_anti")
    return held.select("sample_id", "gene_id", F.coalesce("value", F.lit(0.0)).alias("value")).unionByName(lacking.withColumn("value", F.lit(0.0)))


def overlap_ratio(expr: DataFrame, reference: DataFrame) -> DataFrame:
    """sample_id, found, wanted, ratio: share of the reference's genes that the sample holds."""
    genes = reference.select("gene_id").distinct()
    found = expr.select("sample_id", "gene_id").distinct().join(genes, "gene_id", "left_semi").groupBy("sample_id").agg(F.count(F.lit(1)).alias("found"))
    wanted = genes.agg(F.count(F.lit(1)).alias("wanted"))
    out = expr.select("sample_id").distinct().join(found, "sample_id", "left").crossJoin(wanted)  # one row
    return out.select("sample_id", F.coalesce("found", F.lit(0)).alias("found"), "wanted", F.when(F.col("wanted") > 0, F.coalesce("found", F.lit(0)) / F.col("wanted")).alias("ratio"))


def infer_sex(expr: DataFrame, margin: float = 1.0, x: Sequence[str] = X_MARKERS, y: Sequence[str] = Y_MARKERS, symbol: str = "gene_id") -> DataFrame:
    """sample_id, x, y (log2(1 + median) of the markers present), sex: Male, Female or Unknown. Genes are named by symbols,
    Ensembl ids with or without version, or both together."""
    from ..functions.reads import extract_symbol, strip_version

    plain = F.upper(strip_version(F.trim(F.col(symbol))))
    by_id = F.create_map(*[F.lit(x) for pair in ENSEMBL_MARKERS.items() for x in pair])
    name = F.coalesce(F.try_element_at(by_id, plain), extract_symbol(strip_version(F.trim(F.col(symbol)))))
    level = lambda names: F.log2(1 + F.median(F.when(name.isin(*names), F.col("value"))))
    out = expr.groupBy("sample_id").agg(level(x).alias("x"), level(y).alias("y"))
    both = F.when(F.col("x") - F.col("y") >= margin, "Female").when(F.col("y") - F.col("x") >= margin, "Male")
    one = F.when(F.col("x").isNull() & (F.col("y") >= 1), "Male").when(F.col("y").isNull() & (F.col("x") >= 1), "Female")
    return out.withColumn("sex", F.coalesce(both, one, F.lit("Unknown")))


def filter_sex_labels(profile: DataFrame, sex: str, file_name: str = "", male: Sequence[str] = MALE_LABELS, female: Sequence[str] = FEMALE_LABELS) -> DataFrame:
    """The profile without the labels of the other sex (of both if it is not known); brain profiles stay whole."""
    import re

    if re.search(SEXLESS_FILE, file_name.lower()):
        return profile
    gone = {"Male": female, "Female": male}.get(sex, (*male, *female))
    pattern = "|".join(re.escape(x.lower()) for x in gone)
    return profile.where(~F.lower("label").rlike(pattern))


def least_squares(gram: np.ndarray, product: np.ndarray, tolerance: float = 1e-10) -> np.ndarray:
    """The weights of 0 or more that minimise w'Gw / 2 - c'w, by an active set: the label with the greatest gradient joins, the
    labels that joined are solved for exactly, and those that would turn negative leave, until no gradient is left. Where
    labels repeat each other, so that the set could turn in circles, coordinate descent goes on to the same optimum."""
    k, scale = len(product), tolerance * float(np.abs(product).max(initial=0.0))
    w, active = np.zeros(k), np.zeros(k, bool)
    for _ in range(30 * k):
        gradient = product - gram @ w
        open_ = ~active & (gradient > scale)
        if not open_.any():
            return w
        active[np.where(open_, gradient, -np.inf).argmax()] = True
        while active.any():
            own = np.flatnonzero(active)
            solved = np.linalg.lstsq(gram[np.ix_(own, own)], product[own], rcond=None)[0]
            low = solved <= 0
            if not low.any():
                w[:] = 0
                w[own] = solved
                break
            held = w[own]
            step = (held[low] / np.maximum(held[low] - solved[low], 1e-300)).min()
            held = held + step * (solved - held)
            gone = low & (held <= 1e-14 * held.max(initial=0))
            w[own] = np.where(gone, 0, held)
            active[own[gone]] = False
    while residual(gram, product, w) > max(tolerance, 1e-9):
        for j in np.flatnonzero(np.diag(gram) > 0):
            w[j] = max(0.0, w[j] + (product[j] - gram[j] @ w) / gram[j, j])
    return w


def residual(gram: np.ndarray, product: np.ndarray, w: np.ndarray) -> float:
    """How far weights are from the optimum (Karush-Kuhn-Tucker): gradients that are left, by the greatest product."""
    gradient = product - gram @ w
    return float(np.maximum(gradient.max(initial=0), np.abs(gradient[w > 0]).max(initial=0)) / max(1e-300, np.abs(product).max(initial=0)))


def deconvolve(expr: DataFrame, profile: DataFrame, tolerance: float = 1e-10) -> DataFrame:
    """sample_id, label, fraction: plain non-negative least squares on the K x K Gram matrix of the profile's K labels,
    normalised to 1 and rounded to 4 decimals; fractions of 0 are left out. Not the estimator of any published deconvolution
    tool. Genes are summed up by joins; a sample's K numbers are then solved to the optimum in one row (`least_squares`)."""
    p = written(profile_gene_mean(profile))
    gram = p.select("gene_id", F.col("label").alias("a"), F.col("value").alias("x")).join(p.select("gene_id", F.col("label").alias("b"), F.col("value").alias("y")), "gene_id").groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("g"))
    product = expr.select("sample_id", "gene_id", F.col("value").alias("y")).join(p, "gene_id").groupBy("sample_id", "label").agg(F.sum(F.col("y") * F.col("value")).alias("c"))
    cells = gram.collect()  # labels squared
    labels = sorted({r.a for r in cells})
    place = {label: k for k, label in enumerate(labels)}
    matrix = np.zeros((len(labels), len(labels)))
    for r in cells:
        matrix[place[r.a], place[r.b]] = r.g
    own = product.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("label", "c"))).alias("c"))
    own = own.select("sample_id", F.array(*[F.coalesce(F.try_element_at("c", F.lit(x)), F.lit(0.0)) for x in labels]).alias("c"))
    sent = own.sparkSession.sparkContext.broadcast(matrix)

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [least_squares(sent.value, np.asarray(c.as_py(), float), tolerance).tolist() for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["sample_id", "w"])

    kind = T.StructType([own.schema["sample_id"], T.StructField("w", T.ArrayType(T.DoubleType()))])
    found = own.mapInArrow(solved, kind).withColumn("all", F.aggregate("w", F.lit(0.0), lambda s, v: s + v)).where("all > 0")
    parts = found.select("sample_id", "all", F.inline(F.arrays_zip(F.array(*[F.lit(x) for x in labels]).alias("label"), F.col("w").alias("v"))).alias("label", "v"))
    return parts.select("sample_id", "label", F.round(F.col("v") / F.col("all"), 4).alias("fraction")).where("fraction > 0")


def fraction_report(fractions: DataFrame) -> DataFrame:
    """Adds percent and place, high to low; numbers that are not all within 0 to 1 are taken as percent already."""
    inside = F.min((F.col("fraction").between(0, 1)).cast("int")).over(Window.partitionBy("sample_id"))
    out = fractions.withColumn("percent", F.when(inside == 1, F.col("fraction") * 100).otherwise(F.col("fraction"))).where("percent > 0")
    return out.withColumn("place", F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("percent"), "label")))
