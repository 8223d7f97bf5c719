"""Circular RNA calls: chrom, s (0-based), e, strand, gene_id, symbol, reads, type, caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import dropped, written


def known_gene(gene: Column) -> Column:
    """Without trailing commas; empty and n/a become `novel`."""
    clean = F.trim(F.regexp_replace(gene, ",+$", ""))
    return F.when(clean.isNull() | F.lower(clean).isin("", "n/a"), "novel").otherwise(clean)


def circ_ids(chrom: Column, start: Column, end: Column, gene: Column, symbol: Column) -> tuple[Column, Column]:
    """`chrom:start|end|gene` and `chrom:start|end|symbol`."""
    place = F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("|"), end.cast("string"), F.lit("|"))
    return F.concat(place, gene), F.concat(place, symbol)


def parse_circ_id(circ_id: Column) -> Column:
    pattern = r"^(.*):(\d+)\|(\d+)\|(.*)$"
    part = lambda k: F.regexp_extract(circ_id, pattern, k)
    number = lambda k: F.nullif(part(k), F.lit("")).cast("bigint")
    return F.struct(part(1).alias("chrom"), number(2).alias("s"), number(3).alias("e"), part(4).alias("gene"))


def read_count(names: Column) -> Column:
    """Number of names in a comma-separated list; empty ones do not count."""
    return F.size(F.filter(F.split(names, ","), lambda x: F.trim(x) != ""))


def circ_cpm(calls: DataFrame, fragments: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Adds cpm (2 decimals) given the mapped fragments (by, n); calls without reads are left out; n = 0 gives 0."""
    cpm = F.when(F.coalesce(F.col("n"), F.lit(0)) > 0, F.round(F.col("reads") / F.col("n") * 1e6, 2)).otherwise(0.0)
    return calls.where(F.col("reads") > 0).join(fragments, list(by), "left").withColumn("cpm", cpm).drop("n")


def union_calls(a: DataFrame, b: DataFrame, names: tuple[str, str]) -> DataFrame:
    return a.withColumn("caller", F.lit(names[0])).unionByName(b.withColumn("caller", F.lit(names[1])))


def cluster_by_start(rows: DataFrame, keys: Sequence[str], tol: int = 2, start: str = "s", name: str = "cluster") -> DataFrame:
    """Numbers clusters within `keys`: from the least start on, a cluster takes the starts nearer than `tol` to its first.

    With tol 2, starts of an island (no gap of 2 or more) pair up from its least start, which is a closed form. For another
    tolerance see `first_starts`.
    """
    if tol == 2:
        order = Window.partitionBy(*keys).orderBy(start)
        gap = F.coalesce(F.col(start) - F.lag(start).over(order), F.lit(2)) >= 2
        # the last start behind a gap, in the order that is there already
        first = F.last(F.when(F.col("__gap"), F.col(start)), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
        island = rows.withColumn("__gap", gap).withColumn("__first", first)
        return island.withColumn(name, F.col("__first") + F.floor((F.col(start) - F.col("__first")) / 2) * 2).drop("__gap", "__first")
    names = [f"__k{k}" for k in range(len(keys))]  # null keys are keys like any other
    keyed = lambda df: df.select("*", *[F.struct(k).alias(n) for k, n in zip(keys, names)])
    marks = first_starts(keyed(rows).select(*names, F.col(start).cast("bigint").alias("s")), names, tol)
    points = keyed(rows).select(*names, F.col(start).cast("bigint").alias("s")).distinct()
    known = nearest(points, marks, names).select(*names, F.col("s").alias("__s"), F.col("near").alias(name))
    return keyed(rows).withColumn("__s", F.col(start).cast("bigint")).join(known, [*names, "__s"]).drop(*names, "__s")


def nearest(points: DataFrame, marks: DataFrame, keys: list[str], ahead: int | None = None, tile: int = 100_000) -> DataFrame:
    """points (keys, s) with `near`: the last mark (keys, s) at or before s, or with `ahead` the first one from s + ahead on; null
    without one. Looked for inside tiles; where a tile has none, the tiles' outermost marks are asked."""
    at = F.col("s") + (ahead or 0)
    cut = F.floor(F.col("pos") / tile)
    both = points.select(*keys, "s", at.alias("pos"), F.lit(None).cast("bigint").alias("mark")).unionByName(marks.select(*keys, F.lit(None).cast("bigint").alias("s"), F.col("s").alias("pos"), F.col("s").alias("mark")))
    both = both.withColumn("tile", cut)
    edge = F.min if ahead is not None else F.max
    tiles = both.groupBy(*keys, "tile").agg(edge("mark").alias("edge"))
    side = lambda c, *more: Window.partitionBy(*keys, *more).orderBy(F.desc(c) if ahead is not None else F.asc(c))
    tiles = tiles.withColumn("beyond", F.last("edge", ignorenulls=True).over(side("tile").rowsBetween(Window.unboundedPreceding, -1))).drop("edge")
    inside = F.last("mark", ignorenulls=True).over(side("pos", "tile").rangeBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("near", inside).where("s is not null").join(tiles, [*keys, "tile"])
    return found.select(*keys, "s", F.coalesce("near", "beyond").alias("near"))


def first_starts(rows: DataFrame, keys: list[str], tol: int) -> DataFrame:
    """keys, s: the starts that begin a cluster. A start that follows a gap of `tol` or more begins one, whatever lies before, so
    the chains of all islands between such gaps are followed at once. A start points to the first one at least `tol` further
    on; pointers are followed inside islands by doubling: each round knows twice as many members of a chain and jumps twice as
    far, so rounds grow with the logarithm of the longest island's chain. Finished rounds are deleted."""
    starts = written(rows.where("s is not null").select(*keys, "s").distinct())
    behind_gaps = nearest(starts, starts, keys, ahead=1).where(F.col("near") - F.col("s") >= tol).select(*keys, F.col("near").alias("s"))
    reached = written(starts.groupBy(*keys).agg(F.min("s").alias("s")).unionByName(behind_gaps))
    jump = nearest(starts, starts, keys, ahead=tol).where("near is not null")
    jump = written(jump.join(reached.select(*keys, F.col("s").alias("near")), [*keys, "near"], "left_anti").select(*keys, "s", "near"))
    while True:
        more = reached.join(jump, [*keys, "s"]).select(*keys, F.col("near").alias("s"))
        after = written(reached.unionByName(more))
        grown = not more.isEmpty()
        dropped(reached)
        reached = after
        if not grown:
            break
        twice = written(jump.join(jump.select(*keys, F.col("s").alias("near"), F.col("near").alias("far")), [*keys, "near"]).select(*keys, "s", F.col("far").alias("near")))
        dropped(jump)
        jump = twice
    dropped(starts, jump)
    return reached


def cluster_representative(clustered: DataFrame, keys: Sequence[str], callers: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """The call of most reads of each cluster (then the least start, then the first of `callers`), and `source`: its
    caller, marked if several callers share the cluster."""
    rank = F.array_position(F.array(*[F.lit(c) for c in callers]), F.col("caller"))
    best = Window.partitionBy(*keys, cluster).orderBy(F.desc("reads"), "s", rank, "gene_id")
    several = F.size(F.collect_set("caller").over(Window.partitionBy(*keys, cluster))) > 1
    marked = clustered.withColumn("__nth", F.row_number().over(best)).withColumn("source", F.when(several, F.concat("caller", F.lit(" (overlapped)"))).otherwise(F.col("caller")))
    return marked.where("__nth = 1").drop("__nth", cluster)


def number_within_gene(rows: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Adds circ_id3: `circRNA{n}|symbol`, n by place within the symbol; calls without gene (`novel`) carry their place instead,
    and are not ranked: there may be any number of them in a sample."""
    novel = F.coalesce(F.col("symbol") == "novel", F.lit(False))
    order = Window.partitionBy(sample, "symbol").orderBy("s", "chrom", "e", "strand", "gene_id")
    named = rows.where(~novel).withColumn("circ_id3", F.concat(F.lit("circRNA"), F.row_number().over(order), F.lit("|"), F.col("symbol")))
    place = F.concat(F.col("chrom"), F.lit(":"), F.col("s"), F.lit("|"), F.col("e"), F.lit("|"), F.col("symbol"))
    return named.unionByName(rows.where(novel).withColumn("circ_id3", place))


def merge_calls(calls: DataFrame, callers: Sequence[str], keys: Sequence[str] = ("sample_id", "chrom", "e", "strand")) -> DataFrame:
    return number_within_gene(cluster_representative(cluster_by_start(calls, keys), keys, callers))


def venn_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """only_a, only_b, both: numbers of distinct keys."""
    left, right = a.select(key).distinct().withColumn("in_a", F.lit(1)), b.select(key).distinct().withColumn("in_b", F.lit(1))
    both = left.join(right, key, "full_outer").select(F.coalesce("in_a", F.lit(0)).alias("in_a"), F.coalesce("in_b", F.lit(0)).alias("in_b"))
    number = lambda x, y: F.coalesce(F.sum(((F.col("in_a") == x) & (F.col("in_b") == y)).cast("int")), F.lit(0))
    return both.agg(number(1, 0).alias("only_a"), number(0, 1).alias("only_b"), number(1, 1).alias("both"))


def annotate_backsplice(chimeric: DataFrame, exons: DataFrame) -> DataFrame:
    """chrom, s, e, strand, reads, gene_id, type: back-splices (donor behind the acceptor on one chromosome and strand),
    counted, and `exon` if both ends are exon borders of one gene, else `other`.

    `chimeric`: read_id, chrom, donor, acceptor, strand, chrom2, strand2; `exons`: gene_id, chrom, s, e, strand.
    """
    back = chimeric.where((F.col("chrom") == F.col("chrom2")) & (F.col("strand") == F.col("strand2")) & (F.col("donor") > F.col("acceptor")))
    sites = back.groupBy("chrom", F.col("acceptor").alias("s"), F.col("donor").alias("e"), "strand").agg(F.count_distinct("read_id").alias("reads"))
    starts = exons.select("chrom", "s", "strand", F.col("gene_id")).distinct()
    ends = exons.select("chrom", "e", "strand", F.col("gene_id")).distinct()
    known = sites.join(starts, ["chrom", "s", "strand"]).join(ends, ["chrom", "e", "strand", "gene_id"])
    known = known.groupBy("chrom", "s", "e", "strand").agg(F.min("gene_id").alias("gene_id"))
    out = sites.join(known, ["chrom", "s", "e", "strand"], "left")
    return out.withColumn("type", F.when(F.col("gene_id").isNull(), "other").otherwise("exon")).withColumn("gene_id", F.coalesce(F.col("gene_id").cast("string"), F.lit("novel")))
