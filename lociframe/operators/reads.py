"""Operators on read tables: sample_id, read_id, seq, qual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.reads import motif_at
from .tables import written


def pair_mates(r1: DataFrame, r2: DataFrame, keys: list[str] = ["sample_id", "read_id"]) -> DataFrame:  # noqa: B006
    """seq1, qual1, seq2, qual2 of the reads that both mates have."""
    a = r1.select(*keys, F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    return a.join(r2.select(*keys, F.col("seq").alias("seq2"), F.col("qual").alias("qual2")), keys)


def motif_fraction(reads: DataFrame, by: list[str], seq: str = "seq", **motif) -> DataFrame:
    hits = F.sum(motif_at(F.col(seq), **motif).cast("int"))
    return reads.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.coalesce(hits, F.lit(0)).alias("hits")).withColumn("ratio", F.when(F.col("total") > 0, F.round(F.col("hits") / F.col("total"), 4)).otherwise(0.0))


def base_composition(reads: DataFrame, by: list[str], n: int = 14, seq: str = "seq") -> DataFrame:
    """by, pos (from 1), A, C, G, T: shares among the reads of n bases or more; other letters count below only. One pass over
    the first n letters, without a row for each."""
    at = lambda k: F.upper(F.substring(seq, k, 1))
    sums = [F.sum((at(k) == b).cast("int")).alias(f"{b}{k}") for k in range(1, n + 1) for b in "ACGT"]
    own = reads.where(F.length(seq) >= n).groupBy(*by).agg(F.count(F.lit(1)).alias("__all"), *sums)
    rows = F.array(*[F.struct(F.lit(k).alias("pos"), *[(F.col(f"{b}{k}") / F.col("__all")).alias(b) for b in "ACGT"]) for k in range(1, n + 1)])
    return own.select(*by, F.inline(rows))


def read_length_histogram(reads: DataFrame, by: list[str], seq: str = "seq") -> DataFrame:
    return reads.groupBy(*by, F.length(seq).alias("length")).agg(F.count(F.lit(1)).alias("reads")).withColumn("log10_reads", F.log10("reads"))


def trim_summary(trimmed: DataFrame, by: list[str]) -> DataFrame:
    """From `trim_readthrough`: read pairs in, kept, trimmed among the kept, and their ratio."""
    kept, cut = F.col("outcome") != "Too_short", F.col("outcome") == "UMI_readthrough"
    out = trimmed.groupBy(*by).agg(F.count(F.lit(1)).alias("input"), F.sum(kept.cast("int")).alias("output"), F.sum(cut.cast("int")).alias("trimmed"))
    return out.withColumn("ratio", F.when(F.col("output") > 0, F.round(F.col("trimmed") / F.col("output"), 6)).otherwise(0.0))


def trim_log(trimmed: DataFrame) -> DataFrame:
    return trimmed.where(F.col("trimmed") > 0).select("read_id", "adapter", "trimmed", F.length("seq1").alias("length"))


def fastq_stats(reads: DataFrame, by: list[str], file: str, seq: str = "seq") -> DataFrame:
    """Reads, and mean over the files of each file's mean length, GC percent, shortest and longest read."""
    gc = F.length(F.regexp_replace(F.col(seq), "[^GC]", ""))
    files = reads.groupBy(*by, file).agg(
        F.count(F.lit(1)).alias("reads"), F.avg(F.length(seq)).alias("mean_length"), (F.sum(gc) * 100.0 / F.sum(F.length(seq))).alias("gc_percent"),
        F.min(F.length(seq)).alias("min_length"), F.max(F.length(seq)).alias("max_length"),
    )
    return files.groupBy(*by).agg(
        F.sum("reads").alias("reads"), F.avg("mean_length").alias("mean_length"), F.avg("gc_percent").alias("gc_percent"),
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
    )


def sample_rows(df: DataFrame, n: int, seed: int, key: str = "read_id") -> DataFrame:
    """The first n rows in the order of a hash of the key: both mates of a pair come together; rows without a key come last.

    The hash of the n-th row is found from counts of hash prefixes, four hex digits more a pass and only among rows that
    share the digits so far, until a prefix ends at the n-th row; what lies up to it is a filter, and no task holds n rows.
    Only of rows with one and the same hash, where the n-th row is among them, some are taken by a limit."""
    h = F.md5(F.concat_ws(":", F.col(key), F.lit(seed)))
    prefix, left = "", n
    while len(prefix) < 32:
        size = len(prefix) + 4
        counts = df.where(h.startswith(prefix)).groupBy(F.substring(h, 1, size).alias("p")).count().collect()  # 16 ** 4 rows at most
        for p, count in sorted(map(tuple, counts)):
            prefix = p
            if count >= left:
                break
            left -= count
        else:
            return df  # there are fewer rows
        if count == left:
            return df.where(F.substring(h, 1, size) <= prefix)
    return df.where(h < prefix).unionByName(df.where(h == prefix).limit(left))


def sample_fraction(df: DataFrame, fraction: float, seed: int, key: str = "read_id") -> DataFrame:
    """Rows whose key hashes under the fraction; repeatable, whatever the partitions."""
    if fraction >= 1:
        return df
    return df.where(F.substring(F.md5(F.concat_ws(":", F.col(key), F.lit(seed))), 1, 8) < f"{int(fraction * (1 << 32)):08x}")


def limit_reads(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def kmers(seq: Column, k: int) -> Column:
    """The distinct k-mers of a read on either strand, packed two bits a letter (k up to 31): of a k-mer and its reverse
    complement the lesser number. Stretches with other letters than A, C, G and T give none."""
    clean = F.upper(seq)
    places = F.when(F.length(seq) >= k, F.sequence(F.lit(1), F.length(seq) - k + 1)).otherwise(F.array().cast("array<int>"))
    packed = lambda digits: F.conv(digits, 4, 10).cast("bigint")

    def of(both: Column) -> Column:
        pure = F.when(both.ahead.rlike("^[0-3]*$"), both.places).otherwise(F.filter(both.places, lambda i: ~F.substring(both.ahead, i, F.lit(k)).rlike("[^0-3]")))
        return F.transform(pure, lambda i: packed(F.least(F.substring(both.ahead, i, F.lit(k)), F.substring(both.back, F.length(both.ahead) - i - k + 2, F.lit(k)))))

    # as one element of an array, so that the strands are translated once a read and not once a place
    strands = F.struct(F.translate(clean, "ACGT", "0123").alias("ahead"), F.reverse(F.translate(clean, "ACGT", "3210")).alias("back"), places.alias("places"))
    return F.array_distinct(F.flatten(F.transform(F.array(strands), of)))


#: K-mers of more references than this are counted apart.
COMMON = 64
#: The most k-mers of references that are sent to all tasks.
BROADCAST = 1_000_000


def kmer_screen(reads: DataFrame, refs: DataFrame, k: int = 31, common: int = COMMON) -> DataFrame:
    """read_id, ref, kmers: the reference that shares most k-mers with the read, on either strand (the first by name of equals).

    Each distinct k-mer of the references is one row with its class, the set of references that hold it, so a k-mer is a
    join key once on that side. Classes of up to `common` references are counted for each of these. Larger ones are counted
    as classes: what they give a reference that a read shares rarer k-mers with is looked up, and which reference they favour
    by themselves is worked out once for each combination of such classes and counts that reads show."""
    known = refs.where("ref is not null").select("ref", F.explode(kmers(F.col("seq"), k)).alias("kmer"))
    known = written(known.groupBy("kmer").agg(F.sort_array(F.collect_set("ref")).alias("refs")).select("kmer", "refs", F.md5(F.concat_ws("\n", F.transform("refs", lambda r: F.concat(F.length(r).cast("string"), F.lit(":"), r)))).alias("class")))
    members = known.groupBy("class").agg(F.first("refs").alias("refs"))
    wide = members.where(F.size("refs") > common).select("class", F.explode("refs").alias("ref"))
    own = reads.select("read_id", F.explode(kmers(F.col("seq"), k)).alias("kmer"))
    # k-mers that no reference has are gone before anything is shuffled, if the references' go into memory
    of = known.select("kmer", "class", (F.size("refs") > common).alias("wide"))
    met = own.join(F.broadcast(of) if known.count() <= BROADCAST else of, "kmer").distinct()
    met = written(met.groupBy("read_id", "class", "wide").agg(F.count(F.lit(1)).alias("n")))
    rare = met.where(~F.col("wide")).join(members, "class").select("read_id", "n", F.explode("refs").alias("ref")).groupBy("read_id", "ref").agg(F.sum("n").alias("n"))
    often = met.where("wide").select("read_id", "class", "n")
    added = rare.select("read_id", "ref").join(often, "read_id").join(wide, ["class", "ref"]).select("read_id", "ref", "n")
    shown = often.groupBy("read_id").agg(F.sort_array(F.collect_list(F.struct("class", "n"))).alias("shown"))
    kinds = shown.select("shown").distinct()
    alone = kinds.select("shown", F.inline("shown")).join(wide, "class").groupBy("shown", "ref").agg(F.sum("n").alias("n"))
    first = alone.groupBy("shown").agg(F.min_by(F.struct("ref", "n"), F.struct((-F.col("n")).alias("order"), "ref")).alias("best")).select("shown", "best.*")
    both = rare.unionByName(added).groupBy("read_id", "ref").agg(F.sum("n").alias("kmers")).unionByName(shown.join(first, "shown").select("read_id", "ref", F.col("n").alias("kmers")))
    most = both.groupBy("read_id").agg(F.min_by(F.struct("ref", "kmers"), F.struct((-F.col("kmers")).alias("order"), "ref")).alias("best"))
    return most.select("read_id", "best.ref", "best.kmers")


def contaminant_share(labelled: DataFrame, by: list[str], label: str = "label") -> DataFrame:
    """by, label, reads, percent of all reads of the group (rows without a label count below only)."""
    total = labelled.groupBy(*by).agg(F.count(F.lit(1)).alias("all"))
    found = labelled.where(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count(F.lit(1)).alias("reads"))
    return found.join(total, by).select(*by, label, "reads", F.round(F.col("reads") * 100.0 / F.col("all"), 2).alias("percent"))
