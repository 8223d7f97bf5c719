"""Small tables with results worked out by hand or by a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from lociframe.functions import align as A, reads as R
from lociframe.operators import circ, deconv, em, express, intervals
from lociframe.operators import align as L
from lociframe.sources import sequences, tables


def test_trim_readthrough(spark):
    umi, short = "ACGTACGTACCTTT", "ACGTACGT"
    data = [
        (1, umi, "T" * 15 + "TAAAGG", "C" * 20), (2, umi, "C" * 20, "C" * 20), (3, umi, "C" * 12 + "AAAGGTACGA", "C" * 20), (4, umi, "TTTTTTAAAGG", "C" * 20), (5, short, "C" * 20, "C" * 20), (6, None, "C" * 20, "C" * 20),
    ]
    df = spark.createDataFrame([(k, "@r" + (f"_{u}" if u else ""), s, s, t) for k, u, s, t in data], "k int, read_id string, seq1 string, qual1 string, seq2 string")
    got = {r.k: (r.trimmed, len(r.seq1), r.outcome) for r in R.trim_readthrough(df).collect()}
    assert got == {1: (5, 16, "UMI_readthrough"), 2: (0, 20, "No_UMI_readthrough"), 3: (10, 12, "UMI_readthrough"), 4: (5, 6, "Too_short"), 5: (0, 20, "Too_short"), 6: (0, 20, "Too_short")}


@pytest.mark.parametrize("start, cigar, blocks, junctions, mapped", [
    (100, "30M500N30M200N30M", [(100, 130), (630, 660), (860, 890)], 2, 90), (100, "5S20M2D10M3I5M", [(100, 137)], 0, 35), (10, "1S65M", [(10, 75)], 0, 65), (10, "*", [], 0, 0),
])
def test_cigar(spark, start, cigar, blocks, junctions, mapped):
    r = spark.createDataFrame([(start, cigar)], "s int, c string").select(A.alignment_blocks(F.col("s"), F.col("c")).alias("b"), A.cigar_junctions(F.col("c")).alias("j"), A.cigar_mapped_length(F.col("c")).alias("m")).first()
    assert ([tuple(x) for x in r.b], r.j, r.m) == (blocks, junctions, mapped)


def test_merge_and_coverage(spark):
    iv = spark.createDataFrame([("a", 100, 200), ("a", 150, 250), ("a", 300, 400), ("b", 0, 10), ("b", 10, 20)], "chrom string, s bigint, e bigint")
    assert sorted(map(tuple, intervals.merge_intervals(iv, ["chrom"]).collect())) == [("a", 100, 250), ("a", 300, 400), ("b", 0, 20)]
    w = spark.createDataFrame([("a", 0, 10, 1.0), ("a", 5, 15, 0.5)], "chrom string, s bigint, e bigint, w double")
    for tile in (3, 5, 7, 1000):
        assert sorted(map(tuple, intervals.coverage(w, ["chrom"], weight=F.col("w"), tile=tile).collect())) == [("a", 0, 5, 1.0), ("a", 5, 10, 1.5), ("a", 10, 15, 0.5)]


def test_overlap_join_of_very_different_lengths(spark):
    rng = random.Random(3)
    iv = [(k, rng.randrange(5000), rng.choice([1, 3, 50, 4000])) for k in range(120)]
    a = spark.createDataFrame([("c", k, s, s + n) for k, s, n in iv[:60]], "chrom string, i int, s bigint, e bigint")
    b = spark.createDataFrame([("c", k, s, s + n) for k, s, n in iv[60:]], "chrom string, j int, s2 bigint, e2 bigint")
    got = sorted((r.i, r.j, r.overlap) for r in intervals.overlap_join(a, b, ["chrom"], width=2).collect())
    want = sorted((i, j, min(s + n, t + m) - max(s, t)) for i, s, n in iv[:60] for j, t, m in iv[60:] if s < t + m and t < s + n)
    assert got == want


@pytest.mark.parametrize("tol", [2, 5])
def test_cluster_by_start(spark, tol):
    rng = random.Random(tol)
    data = [(k, rng.randrange(60)) for k in range(5) for _ in range(20)]
    df = spark.createDataFrame(data, "k int, s bigint")
    want = set()
    for key in range(5):
        first = None
        for s in sorted(s for k, s in data if k == key):
            if first is None or s - first >= tol:
                first = s
            want.add((key, s, first))
    assert {tuple(r) for r in circ.cluster_by_start(df, ["k"], tol).select("k", "s", "cluster").collect()} == want


def test_cluster_representative(spark):
    df = spark.createDataFrame([(10, "CIRCexplorer2", 5), (11, "CIRI2", 5), (12, "CIRCexplorer2", 9)], "s bigint, caller string, reads bigint").withColumn("chrom", F.lit("c")).withColumn("gene_id", F.lit("g"))
    out = circ.cluster_representative(circ.cluster_by_start(df, ["chrom"]), ["chrom"], ["CIRCexplorer2", "CIRI2"])
    assert sorted((r.s, r.source) for r in out.collect()) == [(10, "CIRCexplorer2 (overlapped)"), (12, "CIRCexplorer2")]


def test_tpm(spark):
    df = spark.createDataFrame([("s", "g1", 10.0, 1000.0), ("s", "g2", 20.0, 2000.0), ("s", "g3", 0.0, 500.0), ("s", "g4", 5.0, 250.0)], "sample_id string, gene_id string, count double, length double")
    assert {r.gene_id: round(r.tpm) for r in express.tpm(df).collect()} == {"g1": 250000, "g2": 250000, "g4": 500000}


def test_strand_subtract(spark):
    a = spark.createDataFrame([("g", 10.0), ("h", 3.0), ("i", 1.0)], "gene_id string, count double")
    b = spark.createDataFrame([("g", 4.0), ("h", 8.0)], "gene_id string, count double")
    assert {r.gene_id: r["count"] for r in express.strand_subtract(a, b, ["gene_id"]).collect()} == {"g": 6.0, "h": 0.0, "i": 1.0}


def test_gene_em(spark):
    counts = spark.createDataFrame([("g1", 1000, 2, 3.0), ("g2", 500, 2, 1.0)], "gene_id string, length bigint, exons int, count double")
    amb = spark.createDataFrame([(1, ["g1", "g2"], 1.0, False), (2, ["g1", "g2"], 1.0, False)], "frag int, genes array<string>, p double, spliced boolean")
    got, _ = em.gene_em(amb, counts, 250.0)
    assert {r.gene_id: round(r.em_count, 6) for r in got.collect()} == {"g1": 0.691294, "g2": 1.308706}


def test_positional_em_sums_to_one_and_follows_coverage(spark):
    blocks = spark.createDataFrame([("s", "c", "q", "a", 1.0, 0, 10), ("s", "c", "q", "b", 1.0, 100, 110), ("s", "c", "r", "a", 0.0, 500, 510)], "sample_id string, chrom string, qname string, locus string, score double, s bigint, e bigint")
    unique = spark.createDataFrame([("s", "c", 0, 10, 4.0)], "sample_id string, chrom string, s bigint, e bigint, value double")
    got = {(r.qname, r.locus): r.fraction for r in em.positional_em(blocks, unique).collect()}
    cover = {"a": 4.0, "b": 0.0}
    f = {"a": 0.5, "b": 0.5}
    for _ in range(100):
        w = {k: (10 * (cover[k] + f[k]) + 1e-9) for k in f}
        new = {k: w[k] / sum(w.values()) for k in w}
        moved, f = max(abs(new[k] - f[k]) for k in f), new
        if moved < 1e-3:
            break
    assert got["r", "a"] == 1.0 and abs(got["q", "a"] - f["a"]) < 1e-9 and abs(got["q", "a"] + got["q", "b"] - 1) < 1e-12


@pytest.mark.parametrize("values, sex", [({"XIST": 7.0, "RPS4Y1": 0.0, "DDX3Y": 0.0}, "Female"), ({"XIST": 1.0, "RPS4Y1": 3.0}, "Male"), ({"XIST": 3.0, "RPS4Y1": 3.0}, "Unknown"), ({"RPS4Y1": 2.0}, "Male"), ({"ENSG00000229807.12": 7.0, "ensg00000129824": 0.0}, "Female"), ({"ENSG00000229807.12|XIST": 1.0, "ENSG00000129824|RPS4Y1": 9.0}, "Male"), ({"ENSG00000000003.1": 9.0}, "Unknown")])
def test_infer_sex(spark, values, sex):
    df = spark.createDataFrame([("s", k, v) for k, v in values.items()], "sample_id string, gene_id string, value double")
    assert deconv.infer_sex(df).first().sex == sex


def test_top_genes(spark):
    df = spark.createDataFrame([("s", g, t, float(x)) for g, t, x in (("a", "T1", 9), ("b", "T1", 8), ("c", "T2", 1), ("d", "T2", 0))], "sample_id string, gene_id string, gene_type string, norm_expr double")
    assert {r.gene_id for r in express.top_genes(df, 1, 3).collect()} == {"a", "b", "c"}


def test_quality_cut(spark):
    rng = random.Random(1)
    data = [[rng.randrange(2, 40) for _ in range(rng.randrange(0, 25))] for _ in range(200)]

    def loop(q):
        total = best = 0
        keep = len(q)
        for i in range(len(q) - 1, -1, -1):
            total += 20 - q[i]
            if total < 0:
                break
            if total > best:
                best, keep = total, i
        return keep

    df = spark.createDataFrame(list(enumerate(data)), "k int, q array<int>")
    assert {r.k: r.n for r in df.select("k", R.quality_cut(F.col("q")).alias("n")).collect()} == {k: loop(q) for k, q in enumerate(data)}


def test_umi_dedup_absorbs_neighbours(spark):
    umis = ["AAAA"] * 8 + ["AAAT"] * 4 + ["AATT"] * 2 + ["CCCC"] * 3
    df = spark.createDataFrame([("s", "c", 1, "+", u) for u in umis], "sample_id string, chrom string, pos int, strand string, umi string")
    assert {r.umi: r.cluster for r in L.umi_clusters(df).collect()} == {"AAAA": "AAAA", "AAAT": "AAAA", "AATT": "AAAA", "CCCC": "CCCC"}


def test_pair_alignments(spark):
    schema = "sample_id string, qname string, flag int, chrom string, st bigint, cigar string, mapq int, nh int, score double"
    df = spark.createDataFrame([("s", "q", 65, "c", 100, "10M", 255, 1, 5.0), ("s", "q", 145, "c", 150, "10M", 255, 1, 4.0), ("s", "q", 145, "d", 1, "10M", 255, 1, None), ("s", "q", 65, "c", 100, "10M", 255, 1, 3.0)], schema)
    got = sorted((r.chrom, r.blocks_r1 is not None, r.blocks_r2 is not None, r.score) for r in L.pair_alignments(df).collect())
    assert got == [("c", True, True, 9.0), ("d", False, True, 1.0)]


def alignments(spark, rows):
    schema = "sample_id string, qname string, flag int, chrom string, st bigint, cigar string, mapq int, nh int, score double, seq string, qual string"
    return spark.createDataFrame([("s", q, f, "c", st, cigar, 255, nh, 1.0, seq, "I" * len(seq)) for q, f, st, cigar, nh, seq in rows], schema)


def test_quantify_marks_introns_and_tails(spark):
    exons = spark.createDataFrame([("g1", "c", 100, 200, "+"), ("g1", "c", 210, 300, "+"), ("g2", "c", 1000, 1300, "+")], "gene_id string, chrom string, s bigint, e bigint, strand string")
    tail, plain = "C" * 30 + "A" * 9, "C" * 39
    rows = [
        ("intron", 0, 150, "20M25N20M", 1, plain),  # an intron of 20 bases or more
        ("short", 0, 120, "20M15N20M", 1, plain),  # too short, and no junction of the gene
        ("known", 0, 180, "20M10N20M", 1, plain),  # as short, but the gap between the exons
        ("tail", 0, 1100, "30M9S", 1, tail), ("primed", 0, 1180, "20M9S", 1, tail[10:]), ("back", 16, 1050, "9S30M", 1, "T" * 9 + "C" * 30), ("none", 0, 1100, "39M", 1, plain),
    ]
    tiles = spark.createDataFrame([("c", 1, "C" * 200 + "A" * 20 + "C" * 780)], "chrom string, tile bigint, seq string")
    got = {r.gene_id: (r.counts_total, r.counts_splice, r.counts_pas) for r in em.quantify(alignments(spark, rows), exons, tiles=tiles).collect()}
    assert got == {"g1": (3.0, 2.0, 0.0), "g2": (4.0, 0.0, 2.0)}
    assert {r.gene_id: r.counts_pas for r in em.quantify(alignments(spark, rows).drop("seq"), exons).collect()} == {"g1": 0.0, "g2": 0.0}


def test_tracks_share_a_read_among_its_places(spark):
    exons = spark.createDataFrame([("g", "c", 0, 900, "+")], "gene_id string, chrom string, s bigint, e bigint, strand string")
    rows = [("u", 0, 100, "10M", 1, "C"), ("v", 16, 105, "10M", 1, "C"), ("m", 0, 100, "10M", 2, "C"), ("m", 0, 500, "10M", 2, "C")]
    fragments, fractions = em.placed_fragments(alignments(spark, rows), exons)
    share = {r.st: r.fraction for r in fragments.join(fractions, "frag").select(F.element_at("blocks_r1", 1).s.alias("st"), "fraction").collect()}
    assert abs(sum(share.values()) - 1) < 1e-9 and share[100] > share[500]
    got = sorted((r.part, r.bucket, r.s, r.e, round(r.value, 9)) for r in em.quantification_tracks(fragments, fractions).collect())
    want = [("multi", "F1R2", 100, 110, share[100]), ("multi", "F1R2", 500, 510, share[500]), ("unique", "F1R2", 100, 110, 1.0), ("unique", "F2R1", 105, 115, 1.0)]
    assert got == [(*x[:4], round(x[4], 9)) for x in want if x[4] > 1e-9]


def test_align_to_reference(spark):
    expr = spark.createDataFrame([("a", "g1", 1.0), ("a", "x", 5.0), ("b", "x", 2.0)], "sample_id string, gene_id string, value double")
    reference = spark.createDataFrame([("g1", "l", 0.0), ("g2", "l", 0.0), ("g1", "m", 0.0)], "gene_id string, label string, value double")
    assert sorted(map(tuple, deconv.align_to_reference(expr, reference).collect())) == [("a", "g1", 1.0), ("a", "g2", 0.0), ("b", "g1", 0.0), ("b", "g2", 0.0)]


def test_internal_priming_on_either_strand(spark):
    tiles = spark.createDataFrame([("c", 0, "C" * 50 + "A" * 30 + "C" * 20), ("c", 1, "T" * 30 + "G" * 70)], "chrom string, tile bigint, seq string")
    ends = spark.createDataFrame([("c", 50, False), ("c", 64, False), ("c", 65, False), ("c", 80, True), ("c", 130, True), ("c", 100, False), ("d", 5, False), ("c", 0, True)], "chrom string, pos bigint, is_reverse boolean")
    got = {(r.pos, r.is_reverse) for r in L.internal_priming(ends, tiles, tile=100).where("priming").collect()}
    assert got == {(50, False), (64, False), (80, True), (130, True), (100, False)}


def test_files(spark, tmp_path):
    write = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    fq = write("a.fastq", "@r1_ACG\nACGT\n+\nIIII\n@r2\nAC\n+\nII\n")
    assert [(r.read_id, r.seq, r.qual) for r in sequences.read_fastq(spark, fq, "s", 1).collect()] == [("@r1_ACG", "ACGT", "IIII"), ("@r2", "AC", "II")]
    fa = write("a.fa", ">c1 x\nACGTA\nCGT\n>c2\nTT\n")
    assert sorted(map(tuple, sequences.read_fasta_tiles(spark, fa, 3).collect())) == [("c1", 0, "ACG"), ("c1", 1, "TAC"), ("c1", 2, "GT"), ("c2", 0, "TT")]
    gtf = write("a.gtf", '#x\nc\tz\texon\t11\t20\t.\t+\t.\tgene_id "g1"; x\nc\tz\tgene\t1\t20\t.\t+\t.\tgene_id "g1"\nc\tz\texon\t5\t9\t.\t.\t.\tgene_id "g2"\nc\tz\texon\t5\t9\t.\t-\t.\tgene_id g3;\n')
    assert sorted(map(tuple, tables.read_gtf_exons(spark, gtf).collect())) == [("g1", "c", 10, 20, "+"), ("g3", "c", 4, 9, "-")]
    bed = write("a.bed", "track x\nc\t1\t5\nc\t7\t9\tn\t0\t-\nc\t1\n")
    assert sorted((r.region_id, r.strand) for r in tables.read_bed(spark, bed).collect()) == [("c_1:5", "."), ("c_7:9:n", "-")]
    saf = write("a.saf", "GeneID\tChr\tStart\tEnd\tStrand\nx\tc\t1\t9\t+\n")
    assert [tuple(r) for r in tables.read_saf(spark, {"Exon": saf, "Intron": str(tmp_path / "none")}).collect()] == [("Exon", "x", "c", 0, 9, "+")]
    counts = write("a.txt", "# c\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tb\ng\tc\t1\t2\t+\t100\t7\nbad\tc\n")
    assert [tuple(r) for r in tables.read_counts(spark, counts, "s").collect()] == [("s", "g", 100.0, 7.0)]
    meta = write("m.tsv", "GeneID\tGeneSymbol\tGeneType\ng\tA\tx\ng\tB\t \n")
    assert [tuple(r) for r in tables.read_gene_meta(spark, meta).collect()] == [("g", "B", "NA")]
    sam = write("a.sam", "@HD\nq\t16\tc\t5\t60\t4M\t*\t0\t9\tACGT\tIIII\tNH:i:2\tAS:i:-3\n")
    r = tables.read_sam(spark, sam, "s").first()
    assert (r.st, r.nh, r.score, r.tlen, r.mapq) == (4, 2, -3.0, 9, 60)
    log = write("log", "  Number of input reads |\t100\n  Uniquely % |\t5.5%\nx\n")
    assert [(r.metric, r.value) for r in tables.read_star_log(spark, log, "s").collect()] == [("Number of input reads", "100"), ("Uniquely %", "5.5")]
    tax = write("tax", " 12.5\t10\t3\tS\t9606\t  Homo sapiens\n")
    assert tables.read_taxonomy_report(spark, tax, "s").first().name == "Homo sapiens"
    prof = write("p.csv", "Ensembl_ID,Gene_symbol,Liver,Lung\nE1,A,1,2\nE2,B,x,4\n")
    assert sorted(map(tuple, tables.read_profile_matrix(spark, prof).collect())) == [("A", "Liver", 1.0), ("A", "Lung", 2.0), ("B", "Lung", 4.0)]
    one = write("x.tsv", "gene\tTPM\nA\t1.5\n")
    assert [tuple(r) for r in tables.read_single_sample_expr(spark, one).collect()] == [("x", "A", 1.5)]
    rsem = write("r", "gene_id\texpected_count\tTPM\ng\t1.5\t2\n")
    assert [tuple(r) for r in tables.read_rsem(spark, rsem, "s").collect()] == [("s", "g", 1.5, 2.0)]
    fqc = write("f", ">>Basic Statistics\tpass\n#Measure\tValue\nTotal Sequences\t9\nSequence length\t30-50\n%GC\t44\n>>END_MODULE\n")
    assert [tuple(r) for r in tables.read_fastqc_basic(spark, fqc, "s").collect()] == [("s", 9.0, 44.0, 40.0)]
    picard = write("pic", "## x\n# y\nA\tPCT_B\n1\t0.5\n")
    assert sorted((r.metric, r.value) for r in tables.read_picard_metrics(spark, picard, "s").collect()) == [("A", "1"), ("PCT_B", "0.5")]
    several = [write("p1.txt", "# x\n\nA\tB\n1\t2\n3\t4\n"), write("p2.txt", "A\tC\r\n5\t6\r\n"), write("p3.txt", "# only comments\n")]
    assert sorted(map(tuple, tables.read_picard_metrics(spark, several).collect())) == [("p1", "A", "1"), ("p1", "B", "2"), ("p2", "A", "5"), ("p2", "C", "6")]
    cov = spark.createDataFrame([("c", 0, 5, 1.0), ("c", 5, 20, 2.0), ("c", 30, 40, 0.0)], "chrom string, s bigint, e bigint, value double")
    tables.write_bedgraph(cov, str(tmp_path / "bg"), spark.createDataFrame([("c", 10)], "chrom string, length bigint"))
    assert sorted(map(tuple, spark.read.option("sep", "\t").csv(str(tmp_path / "bg")).collect())) == [("c", "0", "5", "1.0"), ("c", "5", "10", "2.0")]
