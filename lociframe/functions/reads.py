"""Row functions on read sequences, qualities and read names. All are native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values of the library protocol.
MOTIF, MOTIF_START, MOTIF_END = "ACC", 9, 11
UMI_LENGTH, UMI_KEPT = 14, 8
ADAPTER = "AGATCGGAAGAGC"


def motif_at(seq: Column, motif: str = MOTIF, start: int = MOTIF_START, end: int = MOTIF_END) -> Column:
    """Whether 1-based positions start..end spell the motif; a shorter read never does."""
    return F.coalesce((F.length(seq) >= end) & (F.substring(seq, start, end - start + 1) == motif), F.lit(False))


def reverse_complement(seq: Column) -> Column:
    """Letters other than A, C, G, T, N become N."""
    return F.reverse(F.translate(F.regexp_replace(seq, "[^ACGTN]", "N"), "ACGT", "TGCA"))


def umi_of(read_id: Column) -> Column:
    """What follows the first `_` of the read name's first token; null without one."""
    token = F.substring_index(read_id, " ", 1)
    at = F.instr(token, "_")
    return F.when(at > 0, F.substring(token, at + 1, F.length(token)))


def rewrite_umi_header(read_id: Column, umi: Column) -> Column:
    """The read name's first token with what follows its last `_` replaced; without `_` it stays."""
    token = F.substring_index(read_id, " ", 1)
    rest = F.substring(read_id, F.length(token) + 1, F.length(read_id))
    cut = F.length(token) - F.length(F.substring_index(token, "_", -1))
    return F.when(F.instr(token, "_") > 0, F.concat(F.substring(token, F.lit(1), cut), umi, rest)).otherwise(read_id)


def _mismatches(a: Column, b: Column) -> Column:
    """Hamming distance of two strings of one length."""
    places = F.sequence(F.lit(1), F.length(a))
    return F.when(F.length(a) > 0, F.size(F.filter(places, lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))).otherwise(0)


def _within(a: Column, b: Column, most: Column) -> Column:
    """Whether two words of one length differ in `most` letters at most; up to one letter that is what their edit distance says."""
    return F.when(most < 1, a == b).when(most < 2, F.levenshtein(a, b, 1) >= 0).otherwise(_mismatches(a, b) <= most)


def overlap_length(seq: Column, adapter: Column, min_overlap: int = 3, error_rate: float = 0.1, longest: int = UMI_LENGTH) -> Column:
    """The longest end of the read, of `longest` letters at most, that is, but for int(length * error_rate) letters, a beginning of
    the adapter; else 0. A condition for each length, the longest first, so that all is compiled and the first fit ends it."""
    out = F.lit(0)
    for n in range(min_overlap, longest + 1):
        a, b, most = F.right(seq, F.lit(n)), F.substring(adapter, 1, n), int(n * error_rate + 1e-9)
        close = a == b if most < 1 else F.levenshtein(a, b, 1) >= 0 if most < 2 else _mismatches(a, b) <= most
        out = F.when((F.length(seq) >= n) & (F.length(adapter) >= n) & close, n).otherwise(out)
    return out


def trim_readthrough(pairs: DataFrame, min_overlap: int = 3, error_rate: float = 0.1, min_length: int = 10) -> DataFrame:
    """Adds adapter, trimmed, seq1, qual1 (cut), read_id (UMI shortened) and outcome to pairs (read_id, seq1, qual1, seq2).

    The adapter is the reverse complement of the UMI's first 14 letters. outcome: UMI_readthrough, No_UMI_readthrough or
    Too_short (a mate shorter than `min_length` after trimming, or a UMI under 14 letters). A UMI under 14 letters gives
    no adapter and trims nothing.
    """
    umi = umi_of(F.col("read_id"))
    long_enough = F.coalesce(F.length(umi) >= UMI_LENGTH, F.lit(False))
    adapter = F.when(long_enough, reverse_complement(F.substring(umi, 1, UMI_LENGTH)))
    kept = [c for c in pairs.columns if c not in ("adapter", "trimmed")]
    found = pairs.select(*kept, F.explode(F.array(adapter)).alias("adapter"))
    trimmed = F.coalesce(F.when(F.col("adapter").isNotNull(), overlap_length(F.col("seq1"), F.col("adapter"), min_overlap, error_rate)), F.lit(0))
    # exploded from arrays of one, so that each is worked out once a row, however often the columns and filters behind use it
    out = found.select("*", F.explode(F.array(trimmed)).alias("trimmed"))
    keep = F.length("seq1") - F.col("trimmed")
    out = out.withColumn("__keep", keep)
    cut = lambda c: F.substring(F.col(c), F.lit(1), F.col("__keep"))
    short = F.col("adapter").isNull() | (F.col("__keep") < min_length) | (F.length("seq2") < min_length)
    outcome = F.when(short, "Too_short").when(F.col("trimmed") > 0, "UMI_readthrough").otherwise("No_UMI_readthrough")
    shortened = F.when(F.col("adapter").isNotNull(), rewrite_umi_header(F.col("read_id"), F.substring(umi, 1, UMI_KEPT))).otherwise(F.col("read_id"))
    out = out.withColumn("outcome", outcome).withColumn("seq1", cut("seq1")).withColumn("qual1", cut("qual1")).withColumn("read_id", shortened)
    return out.drop("__keep")


def extract_umi(pairs: DataFrame, n: int = UMI_LENGTH) -> DataFrame:
    """Moves the first n letters of mate 2 to the end of the read name, after a `_`."""
    umi = F.substring("seq2", 1, n)
    cut = lambda c: F.substring(F.col(c), F.lit(n + 1), F.length(c))
    return pairs.withColumn("read_id", F.concat_ws("_", "read_id", umi)).withColumn("seq2", cut("seq2")).withColumn("qual2", cut("qual2"))


def adapter_start(seq: Column, adapter: str = ADAPTER, overlap: int = 3, error_rate: float = 0.1) -> Column:
    """1-based first place from which the read agrees with the adapter, up to the end of either, in all but
    int(overlap length * error_rate) letters; null if there is none. No insertions or deletions."""
    sizes = F.when(F.length(seq) >= overlap, F.sequence(F.lit(1), F.length(seq) - overlap + 1)).otherwise(F.array().cast("array<int>"))

    def fits(i: Column) -> Column:
        n = F.least(F.length(seq) - i + 1, F.lit(len(adapter)))
        return _within(F.substring(seq, i, n), F.substring(F.lit(adapter), F.lit(1), n), F.floor(n * F.lit(error_rate)))

    return F.array_min(F.filter(sizes, fits))


def trim_adapter(seq: Column, adapter: str = ADAPTER, overlap: int = 3, error_rate: float = 0.1) -> Column:
    at = adapter_start(seq, adapter, overlap, error_rate)
    return F.coalesce(F.substring(seq, F.lit(1), at - 1), seq)


def phred(qual: Column) -> Column:
    """Base qualities of a Phred+33 string."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def quality_cut(quals: Column, q: int = 20) -> Column:
    """How many bases stay: from the end, sums of q - quality are followed until one is negative, and the read is cut
    where the sum was greatest (the first of equals)."""
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("best"), F.lit(0).alias("cut"), F.lit(0).alias("i"), F.lit(False).alias("over"))

    def step(s: Column, x: Column) -> Column:
        total, i = s["sum"] + (q - x), s["i"] + 1
        over = s["over"] | (total < 0)
        better = ~over & (total > s["best"])
        return F.struct(
            F.when(over, s["sum"]).otherwise(total).alias("sum"), F.when(better, total).otherwise(s["best"]).alias("best"),
            F.when(better, i).otherwise(s["cut"]).alias("cut"), i.alias("i"), over.alias("over"),
        )

    return F.size(quals) - F.aggregate(F.reverse(quals), zero, step, lambda s: s["cut"])


def strip_version(gene_id: Column) -> Column:
    return F.regexp_replace(gene_id, r"\.\d+$", "")


def extract_symbol(name: Column) -> Column:
    """The last part of a composed name that is not an Ensembl id, upper-cased."""
    parts = F.filter(F.split(name, r"[|;,\s/]+"), lambda p: (p != "") & ~p.rlike(r"^ENS[A-Z]*\d+"))
    return F.upper(F.try_element_at(parts, F.lit(-1)))


def gene_label(symbol: Column, gene_id: Column) -> Column:
    base_s, base_i = strip_version(symbol), strip_version(gene_id)
    return F.when(base_s == base_i, base_s).otherwise(F.concat(symbol, F.lit("("), gene_id, F.lit(")")))


def format_count(x: Column) -> Column:
    """Two decimals at most, without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.2f", x.cast("double")), r"0+$", ""), r"\.$", "")


def validate_fastq(reads: DataFrame) -> DataFrame:
    """The records whose name does not begin with `@`, or whose sequence and quality differ in length."""
    good = F.col("read_id").startswith("@") & (F.length("seq") == F.length("qual"))
    return reads.where(~F.coalesce(good, F.lit(False)))
