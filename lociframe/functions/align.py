"""Row functions on alignments: CIGAR, flags, strands, poly(A) tails."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Flag bits of the SAM format (fixed values).
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, READ1, READ2 = 1, 2, 4, 8, 16, 64, 128
SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 256, 512, 1024, 2048
#: Shortest intron, shortest poly(A) run, least base quality in it.
MIN_INTRON, MIN_RUN, MIN_QUALITY = 20, 8, 20
MIN_INSERT, MAX_INSERT = 10, 2_000_000


def flag(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(bit) != 0


def alignment_filter(flags: Column, include_secondary: bool = False, keep_duplicates: bool = False) -> Column:
    mask = UNMAPPED | QC_FAIL | SUPPLEMENTARY | (0 if include_secondary else SECONDARY) | (0 if keep_duplicates else DUPLICATE)
    return flags.bitwiseAND(mask) == 0


def parse_cigar(cigar: Column) -> Column:
    """array<struct<len, op>>; empty for `*`, null for null."""
    pattern = r"(\d+)([MIDNSHP=X])"
    lens = F.regexp_extract_all(cigar, F.lit(pattern), 1)
    ops = F.regexp_extract_all(cigar, F.lit(pattern), 2)
    return F.zip_with(lens, ops, lambda n, o: F.struct(n.cast("bigint").alias("len"), o.alias("op")))


def cigar_junctions(cigar: Column) -> Column:
    return F.size(F.regexp_extract_all(cigar, F.lit(r"(\d+)N"), 1))


def cigar_mapped_length(cigar: Column) -> Column:
    """Bases under M only (not `=` and `X`)."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)M"), 1), F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint"))


def has_splice(cigar: Column, min_intron: int = MIN_INTRON) -> Column:
    return F.exists(F.regexp_extract_all(cigar, F.lit(r"(\d+)N"), 1), lambda x: x.cast("bigint") >= min_intron)


#: One or two blocks, clipped or not: most CIGARs are such, and need no walk over their operations.
PLAIN = r"^(\d+[SH])*\d+M(\d+N\d+M)?(\d+[SH])*$"


def alignment_blocks(start: Column, cigar: Column) -> Column:
    """array<struct<s, e>>, 0-based half-open. M, = and X open or extend a block, D extends an open one, N closes it;
    I, S, H and P take no reference bases."""
    return F.when(cigar.rlike(PLAIN), _plain_blocks(start, cigar)).otherwise(_walked_blocks(start, cigar))


def has_blocks(cigar: Column) -> Column:
    """Whether `alignment_blocks` has any, without making them."""
    return cigar.rlike(r"\d[M=X]")


def _plain_blocks(start: Column, cigar: Column) -> Column:
    block = lambda s, e: F.struct(s.alias("s"), e.alias("e"))
    size = lambda x, k: F.element_at(x, k).cast("bigint")
    s = start.cast("bigint")

    def made(x: Column) -> Column:
        one = block(s, s + size(x, 1))
        return F.when(F.size(x) == 1, F.array(one)).otherwise(F.array(one, block(s + size(x, 1) + size(x, 2), s + size(x, 1) + size(x, 2) + size(x, 3))))

    # inside a function, so that the lengths are looked for once
    return F.element_at(F.transform(F.array(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MN]"), 1)), made), 1)


def _walked_blocks(start: Column, cigar: Column) -> Column:
    zero = F.struct(start.cast("bigint").alias("pos"), F.lit(False).alias("open"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("done"))

    def step(a: Column, x: Column) -> Column:
        end = a.pos + x.len
        matched = x.op.isin("M", "=", "X")
        last = F.element_at(a.done, -1)
        extended = F.concat(F.slice(a.done, 1, F.size(a.done) - 1), F.array(F.struct(last.s.alias("s"), end.alias("e"))))
        opened = F.concat(a.done, F.array(F.struct(a.pos.alias("s"), end.alias("e"))))
        grows = a.open & (matched | (x.op == "D"))
        return F.struct(
            F.when(matched | x.op.isin("D", "N"), end).otherwise(a.pos).alias("pos"),
            F.when(matched, True).when(x.op == "N", False).otherwise(a.open).alias("open"),
            F.when(grows, extended).when(matched, opened).otherwise(a.done).alias("done"),
        )

    return F.aggregate(parse_cigar(cigar), zero, step, lambda a: a.done)


def no_blocks() -> Column:
    return F.array().cast("array<struct<s:bigint,e:bigint>>")


def blocks_length(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("bigint"), lambda s, b: s + b.e - b.s)


def clip_blocks(blocks: Column, length: Column) -> Column:
    moved = F.transform(blocks, lambda b: F.struct(F.greatest(b.s, F.lit(0).cast("bigint")).alias("s"), F.least(b.e, length.cast("bigint")).alias("e")))
    return F.filter(moved, lambda b: b.e > b.s)


def is_unique(nh: Column, mapq: Column, threshold: Column | int) -> Column:
    return F.coalesce(nh == 1, mapq >= threshold)


def strand_bucket(is_read2: Column, is_reverse: Column) -> Column:
    return F.when(is_read2 != is_reverse, "F2R1").otherwise("F1R2")


def strand_compatible(r1_reverse: Column, r2_reverse: Column, gene_strand: Column, library: str) -> Column:
    """Whether the mates present (null: absent) agree with the gene's strand; no mates agree with any."""
    if library == "unstrand":
        return F.lit(True)
    minus = gene_strand == "-"
    r1 = r1_reverse == minus if library == "forward" else r1_reverse != minus
    r2 = r2_reverse != minus if library == "forward" else r2_reverse == minus
    return F.coalesce(r1, F.lit(True)) & F.coalesce(r2, F.lit(True))


def sense_read(is_read1: Column, library: str) -> Column:
    return {"reverse": ~is_read1, "forward": is_read1, "unstrand": F.lit(True)}[library]


def proper_pair(s1: Column, e1: Column, rev1: Column, s2: Column, e2: Column, rev2: Column, low: int = MIN_INSERT, high: int = MAX_INSERT) -> Column:
    """Opposite strands, the reverse mate not starting left of the forward one, and a span in range."""
    span = F.greatest(e1, e2) - F.least(s1, s2)
    ordered = F.when(rev1, s1 >= s2).otherwise(s2 >= s1)
    return (rev1 != rev2) & ordered & span.between(low, high)


def polya_clip(seq: Column, quals: Column, cigar: Column, is_reverse: Column) -> Column:
    """Whether the clipped end opposite to the read's start holds a run of 8 or more A (T on the reverse strand), at
    least 8 bases of the first longest run having quality 20 or more. Reads without such a run, or such a clip, are told first."""
    may = cigar.rlike(rf"([{MIN_RUN}-9]|\d\d)S") & F.when(is_reverse, F.contains(seq, F.lit("T" * MIN_RUN))).otherwise(F.contains(seq, F.lit("A" * MIN_RUN)))
    parsed = parse_cigar(cigar)
    end = F.when(is_reverse, F.try_element_at(parsed, F.lit(1))).otherwise(F.try_element_at(parsed, F.lit(-1)))
    size = F.when(end.op == "S", end.len).otherwise(0).cast("int")
    first = F.when(is_reverse, F.lit(1)).otherwise(F.length(seq) - size + 1)
    clip = F.substring(seq, first, size)
    runs = F.when(is_reverse, F.regexp_extract_all(clip, F.lit("(T+)"), 1)).otherwise(F.regexp_extract_all(clip, F.lit("(A+)"), 1))
    longest = F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r))), F.lit(0))
    run = F.when(is_reverse, F.repeat(F.lit("T"), longest)).otherwise(F.repeat(F.lit("A"), longest))
    at = F.when(longest > 0, F.instr(clip, run)).otherwise(1)
    good = F.size(F.filter(F.slice(quals, first + at - 1, F.greatest(longest, F.lit(1))), lambda q: q >= MIN_QUALITY))
    return F.when(may, F.coalesce((longest >= MIN_RUN) & (good >= MIN_RUN), F.lit(False))).otherwise(F.lit(False))
