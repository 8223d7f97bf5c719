"""Operators that were rebuilt for scale: the work they cause, hot keys, and results against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.operators import align as L, circ as C, deconv as D, em as E, intervals as I, qc as Q, reads as O
from lociframe.operators.tables import bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_meet_in_bins_only(spark):
    """1000 places a mate on one chromosome, far apart: each meets its own partner, not all of the other mate's."""
    rows = []
    for k in range(1000):
        at = k * 5_000_000
        rows += [("s", "r", "1", at, at + 50, False, 1), ("s", "r", "1", at + 200, at + 250, True, 2)]
    own = spark.createDataFrame(rows, "sample_id string, qname string, chrom string, s bigint, e bigint, rev boolean, mate int")
    assert L.proper_pairs(own).count() == 1000
    # rows of the join before distances are looked at
    place = F.floor(F.col("s") / L.A.MAX_INSERT)
    ahead = own.where("not rev").select("s", F.explode(F.array(place, place + 1)).alias("b"))
    assert ahead.join(own.where("rev").select(F.col("s").alias("s2"), place.alias("b")), "b").count() < 4000


@pytest.mark.parametrize("high", [50, 700, 2_000_000])
def test_proper_pairs_of_all_pairs(spark, high):
    rng = random.Random(high)
    rows = {(rng.randrange(3), "c%d" % rng.randrange(2), s := rng.randrange(3000), s + rng.randrange(1, 90), rng.random() < 0.5, rng.randrange(1, 3)) for _ in range(250)}
    df = spark.createDataFrame([("x", str(q), *rest) for q, *rest in rows], "sample_id string, qname string, chrom string, s bigint, e bigint, rev boolean, mate int")
    got = sorted((r.qname, r.chrom, r.s1, r.e1, r.rev1, r.s2, r.e2, r.rev2) for r in L.proper_pairs(df, high=high).collect())
    want = []
    for q, c, s1, e1, r1, m1 in rows:
        for q2, c2, s2, e2, r2, m2 in rows:
            ordered = s1 >= s2 if r1 else s2 >= s1
            if (q, c, m1, m2) == (q2, c2, 1, 2) and r1 != r2 and ordered and 10 <= max(e1, e2) - min(s1, s2) <= high:
                want.append((str(q), c, s1, e1, r1, s2, e2, r2))
    assert got == sorted(want)


def test_gene_classes_do_not_grow_with_fragments(spark):
    genes = spark.createDataFrame([(k, 1 + k % 2) for k in range(6)], "gene_id bigint, exons int")
    sets = [[0, 1], [1, 0], [2, 4], [1, 3, 5]]
    rows = [(n, sets[n % 4], 0.5, n % 3 == 0) for n in range(4000)]
    found = E.gene_classes(spark.createDataFrame(rows, "frag bigint, genes array<bigint>, p double, spliced boolean"), genes).collect()
    classes = {}
    for r in found:
        classes.setdefault(r["class"], (r.p, set()))[1].add(r.gene_id)
    want = {}
    for _, own, p, spliced in rows:
        left = {g for g in own if g % 2 == 1} if spliced and any(g % 2 == 1 for g in own) else set(own)
        want[frozenset(left)] = want.get(frozenset(left), 0) + p
    assert {frozenset(g): round(p, 6) for p, g in classes.values()} == {k: round(v, 6) for k, v in want.items()}


def test_a_round_of_positional_em_shuffles_no_large_table(spark):
    place = ["sample_id", "chrom", "qname", "locus"]
    rows = [("s", "1", f"q{k % 40}", f"l{k}", 10 * (k % 7), 5, 1, 2.0) for k in range(200)]
    pieces = spark.createDataFrame(rows, "sample_id string, chrom string, qname string, locus string, s2 bigint, bases bigint, times bigint, base double")
    by_piece, by_place = bucketed(pieces, ["sample_id", "chrom", "s2"]), bucketed(pieces.select(*place, "s2", "times"), place)
    state = bucketed(pieces.select(*place).distinct().selectExpr("*", "1.0d as score", "1.0d as boost", "0.2d as fraction"), place)
    text = plan(E.next_fractions(by_place, by_piece, state))
    # only sums are exchanged: by piece, by place (both after partial sums), and the state by read group
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 3 and text.count("FileScan parquet") >= 3
    below = [text.splitlines()[k + 1] for k, line in enumerate(text.splitlines()) if "Exchange hashpartitioning" in line]
    assert not any("FileScan" in line for line in below)


def test_least_squares_reaches_the_optimum():
    rng = np.random.default_rng(4)
    for trial in range(120):
        x = rng.uniform(0, 1, (30, rng.integers(1, 12))) if trial % 2 else rng.normal(0, 1, (30, rng.integers(1, 12)))
        if trial % 5 == 0 and x.shape[1] > 2:
            x[:, 0] = x[:, 1]  # a label that repeats another
        y = rng.normal(0.3, 1, 30)
        w = D.least_squares(x.T @ x, x.T @ y)
        assert (w >= 0).all() and D.residual(x.T @ x, x.T @ y, w) < 1e-8


def test_deconvolve_finds_the_mixture(spark):
    rng = np.random.default_rng(1)
    profile = rng.uniform(0, 5, (60, 4))
    mix = {"a": [0.6, 0.3, 0.1, 0.0], "b": [0.0, 0.0, 1.0, 0.0]}
    cells = spark.createDataFrame([(g, f"l{k}", float(profile[g, k])) for g in range(60) for k in range(4)], "gene_id bigint, label string, value double")
    expr = spark.createDataFrame([(s, g, float(profile[g] @ np.array(w))) for s, w in mix.items() for g in range(60)], "sample_id string, gene_id bigint, value double")
    got = {(r.sample_id, r.label): r.fraction for r in D.deconvolve(expr, cells).collect()}
    assert got == {("a", "l0"): 0.6, ("a", "l1"): 0.3, ("a", "l2"): 0.1, ("b", "l2"): 1.0}


def test_a_place_with_very_many_umis(spark):
    umi = "concat_ws('', transform(sequence(0, 8), i -> substring('ACGT', cast(shiftright(id, 2 * i) % 4 + 1 as int), 1)))"
    rows = spark.range(100_000).selectExpr("'s' as sample_id", f"concat('r', id, '_', {umi}) as qname", "99 as flag", "'1' as chrom", "1000L as st", "'50M' as cigar", "cast(id % 60 as int) as mapq", "200L as tlen")
    kept = L.umi_dedup(rows)
    assert kept.columns == rows.columns and 0 < kept.count() < 100_000


def test_umi_dedup_by_hand(spark):
    rows = [
        ("s", "a_AAAA", 99, "1", 100, "5S45M", 10, 200), ("s", "a_AAAA", 147, "1", 250, "50M", 10, -200), ("s", "b_AAAA", 99, "1", 95, "50M", 30, 200), ("s", "b_AAAA", 147, "1", 250, "50M", 30, -200),
        ("s", "c_AAAT", 99, "1", 95, "50M", 50, 200), ("s", "d_TTTT", 99, "1", 95, "50M", 5, 200), ("s", "e_AAAA", 99, "1", 95, "50M", 9, 300), ("s", "f_AAAA", 83, "1", 46, "49M5S", 9, 200), ("s", "nothing", 99, "1", 95, "50M", 60, 200), ("s", "g_AAAA", 4, "1", 95, "50M", 60, 200),
    ]
    df = spark.createDataFrame(rows, "sample_id string, qname string, flag int, chrom string, st bigint, cigar string, mapq int, tlen bigint")
    # AAAA has two reads and absorbs AAAT; c has the greatest MAPQ of that cluster and has no second mate here
    assert sorted((r.qname, r.flag) for r in L.umi_dedup(df).collect()) == [("c_AAAT", 99), ("d_TTTT", 99), ("e_AAAA", 99), ("f_AAAA", 83)]
    assert sorted((r.qname, r.flag) for r in L.umi_dedup(df, exact=True).collect()) == [("b_AAAA", 99), ("b_AAAA", 147), ("c_AAAT", 99), ("d_TTTT", 99), ("e_AAAA", 99), ("f_AAAA", 83)]


def test_umis_alone_in_their_place_take_no_part_in_rounds(spark, monkeypatch):
    rows = [("s", "1", k, "+", "AAAA") for k in range(500)] + [("s", "1", 7, "+", u) for u in ("AAAA", "AAAT", "CCCC")] + [("s", None, 7, "+", u) for u in ("AAAA", "AAAT")]
    df = spark.createDataFrame(rows, "sample_id string, chrom string, pos bigint, strand string, umi string")
    sent, spread = [], L.minimum_labels
    monkeypatch.setattr(L, "minimum_labels", lambda nodes, *args: sent.append(nodes.count()) or spread(nodes, *args))
    got = {(r.chrom, r.pos, r.umi): (r.reads, r.cluster) for r in L.umi_clusters(df).collect()}
    assert sent == [3] and len(got) == 504
    assert [got["1", 7, u] for u in ("AAAA", "AAAT", "CCCC")] == [(2, "AAAA"), (1, "AAAA"), (1, "CCCC")] and got["1", 8, "AAAA"] == (1, "AAAA")


def test_region_classes_are_counted_apart(spark):
    regions = [("exon", "x1", "1", 0, 100, "+"), ("exon", "x2", "1", 150, 300, "+"), ("intron", "i1", "1", 90, 400, "+"), ("intergenic", "g", "1", 0, 1000, "-"), ("other", "o", "1", 0, 1000, "+")]
    r = spark.createDataFrame(regions, "region_class string, region_id string, chrom string, s2 bigint, e2 bigint, strand string")
    frags = [("s", "one", [(10, 50)], [(60, 95)]), ("s", "two", [(50, 95)], [(160, 200)]), ("s", "lone", [(10, 20)], None), ("t", "far", [(5000, 5010)], [(5020, 5030)])]
    df = spark.createDataFrame([(a, b, "1", [{"s": x, "e": y} for x, y in m1], [{"s": x, "e": y} for x, y in m2] if m2 else None, True, False if m2 else None, 1.0, True) for a, b, m1, m2 in frags],
        "sample_id string, qname string, chrom string, blocks_r1 array<struct<s:bigint,e:bigint>>, blocks_r2 array<struct<s:bigint,e:bigint>>, rev1 boolean, rev2 boolean, score double, is_unique boolean")
    got = {(x.sample_id, x.region_class): (x.reads, x.share) for x in L.region_class_counts(L.with_fragment_key(df), r, "reverse").collect()}
    assert len(got) == 16 and all(got["t", c] == (0, None) for c in L.REGION_CLASSES)
    # `two` meets two exons, so it counts for none, but for one intron and the unstranded class; `lone` lacks a mate
    assert {c: got["s", c][0] for c in L.REGION_CLASSES if got["s", c][0]} == {"exon": 1, "intron": 2, "intergenic": 2} and got["s", "exon"][1] == 0.2


def test_mates_on_two_chromosomes(spark):
    block = lambda a, b: [{"s": a, "e": b}]
    frags = [("s", "q", "1", block(0, 50), None, False, None, 1.0, True), ("s", "q", "2", None, block(0, 50), None, True, 1.0, True)]
    df = L.with_fragment_key(spark.createDataFrame(frags, "sample_id string, qname string, chrom string, blocks_r1 array<struct<s:bigint,e:bigint>>, blocks_r2 array<struct<s:bigint,e:bigint>>, rev1 boolean, rev2 boolean, score double, is_unique boolean"))
    exons = spark.createDataFrame([("g", "1", 0, 100, "+")], "gene_id string, chrom string, s2 bigint, e2 bigint, strand string")
    assert L.feature_counts(df, exons).count() == 0
    assert [tuple(r) for r in L.feature_counts(df, exons, chimeric=True).collect()] == [("g", 1)]


@pytest.mark.parametrize("tol", [1, 3, 5, 40])
def test_clusters_of_any_tolerance(spark, tol):
    rng = random.Random(tol)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.randrange(300), 99_990 + rng.randrange(30), 500_000])) for _ in range(300)]
    got = sorted(((r.k, r.s, r.cluster) for r in C.cluster_by_start(spark.createDataFrame(rows, "k string, s bigint"), ["k"], tol=tol).collect()), key=str)
    want = []
    for key in {k for k, _ in rows}:
        first = None
        for s in sorted(s for k, s in rows if k == key):
            first = s if first is None or s - first >= tol else first
            want.append((key, s, first))
    assert got == sorted(want, key=str)


def test_rounds_of_clusters_grow_with_islands_only(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("'a' as k", "(id div 3) * 50 + id % 3 * 4 as s")
    tables, write = [], C.written
    monkeypatch.setattr(C, "written", lambda df: tables.append(1) or write(df))
    got = C.cluster_by_start(rows, ["k"], tol=5)
    assert len(tables) <= 8
    assert sorted((r.s, r.cluster) for r in got.collect()) == sorted((50 * k + d, 50 * k + (0 if d < 5 else d)) for k in range(1000) for d in (0, 4, 8))


def test_novel_calls_are_not_ranked(spark):
    rows = spark.range(10).selectExpr("1 as sample_id", "'1' as chrom", "id as s", "id + 5 as e", "'+' as strand", "'g' as gene_id", "if(id < 7, 'novel', 'SYM') as symbol")
    got = {r.s: r.circ_id3 for r in C.number_within_gene(rows).collect()}
    assert got[0] == "1:0|5|novel" and got[7] == "circRNA1|SYM" and len(got) == 10


def test_taxonomy(spark):
    parents = [(k, k - 1 if k > 1 else None) for k in range(1, 40)] + [(100, 100), (101, 100)]
    direct = [(k, 1) for k in range(1, 40)] + [(101, 5), (7, 2), (500, 3), (None, 9)]
    df = spark.createDataFrame(parents, "taxid bigint, parent bigint")
    got = dict(map(tuple, Q.clade_rollup(spark.createDataFrame(direct, "taxid bigint, reads bigint"), df).collect()))
    assert got == {k: 40 - k + (2 if k <= 7 else 0) for k in range(1, 40)} | {100: 5, 101: 5, 500: 3}
    looped = df.unionByName(spark.createDataFrame([(900, 901), (901, 902), (902, 900), (903, 902)], "taxid bigint, parent bigint"))
    with pytest.raises(ValueError, match="900, 901, 902, 903"):
        Q.clade_rollup(spark.createDataFrame(direct, "taxid bigint, reads bigint"), looped)
    lines = [(1, 1, "root"), (2, 2, "  bacteria"), (3, 3, "    coli"), (4, 4, "  human"), (5, 5, "    x"), (6, 6, "unclassified")]
    report = spark.createDataFrame([("s", *x) for x in lines], "sample_id string, line int, taxid int, name string")
    assert {r.taxid: r.parent for r in Q.report_parents(report).collect()} == {1: None, 2: 1, 3: 2, 4: 1, 5: 4, 6: None}


@pytest.mark.parametrize("common", [64, 2, 0])
def test_kmer_screen_on_both_strands_and_with_common_kmers(spark, common):
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    shared = letters(40)
    refs = [(f"r{k}", letters(60) + shared * (k < 5) + letters(20)) for k in range(8)] + [("rn", "ACGNNACGT"), ("none", None)]
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = [("ahead", refs[3][1][5:50]), ("back", turn(refs[6][1][5:50])), ("common", shared), ("half", shared[20:] + refs[4][1][100:118]), ("foreign", letters(50)), ("short", "ACG"), ("empty", ""), ("n", "N" * 40)]
    got = {r.read_id: (r.ref, r.kmers) for r in O.kmer_screen(spark.createDataFrame(reads, "read_id string, seq string"), spark.createDataFrame(refs, "ref string, seq string"), k=15, common=common).collect()}

    def grams(s):
        return {min(s[i : i + 15], turn(s[i : i + 15])) for i in range(len(s or "") - 14) if set(s[i : i + 15]) <= set("ACGT")}

    want = {}
    for name, seq in reads:
        best = sorted((-len(grams(seq) & grams(s)), ref) for ref, s in refs if grams(seq) & grams(s))
        if best:
            want[name] = (best[0][1], -best[0][0])
    assert got == want and got["back"][0] == "r6"


def test_sample_of_rows_is_a_filter(spark):
    df = spark.range(20_000).selectExpr("concat('r', id % 15000) as read_id", "id")
    wanted = sorted(r.h for r in df.select(F.md5(F.concat_ws(":", "read_id", F.lit(5))).alias("h")).collect())
    for n in (0, 1, 777, 20_000, 50_000):
        got = O.sample_rows(df, n, 5)
        assert sorted(r.h for r in got.select(F.md5(F.concat_ws(":", "read_id", F.lit(5))).alias("h")).collect()) == wanted[:n]
    text = plan(O.sample_rows(spark.range(5000).selectExpr("concat('r', id) as read_id"), 500, 5))
    assert "Limit" not in text and "Sort" not in text and "Exchange" not in text
    same = spark.range(100).selectExpr("'one' as read_id", "id")
    assert O.sample_rows(same, 30, 1).count() == 30


def test_gene_list_is_filled_up_by_a_join(spark):
    reference = spark.range(300).selectExpr("id as gene_id", "'l' as label", "1.0d as value")
    expr = spark.createDataFrame([("full", g, 1.0) for g in range(300)] + [("few", 5, 2.0), ("few", 900, 3.0), ("null", 7, None)], "sample_id string, gene_id bigint, value double")
    got = D.align_to_reference(expr, reference)
    rows = {(r.sample_id, r.gene_id): r.value for r in got.collect()}
    assert len(rows) == 900 == got.count() and rows["few", 5] == 2.0 and rows["few", 6] == 0.0 and rows["null", 7] == 0.0 and ("few", 900) not in rows
    assert "CartesianProduct" not in plan(got) and "BroadcastNestedLoopJoin" not in plan(got)


def test_quality_table_of_one_source(spark):
    samples = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    fastqc = spark.createDataFrame([("a", "1", 1001, 50, "35-76"), ("a", "2", 1000, 47, "50")], "sample_id string, file string, reads long, gc int, length string")
    got = {(r.sample_id, r.metric): r.value for r in Q.qc_matrix(samples, fastqc).collect()}
    assert got["a", "Total Raw Reads (R1+R2)"] == "2001" and got["a", "Total Raw Read Pairs (Fragments)"] == "1000" and got["a", "%GC of Raw Reads"] == "48.5" and got["a", "Average Raw Read Length"] == "53"
    assert got["a", "Percentage of Reads Remaining after Trimming"] == "0" and got["b", "Percentage of Reads Remaining after Trimming"] == "NA" and got["b", "Total Raw Reads (R1+R2)"] == "NA"
    assert got["b", "Number of Unmapped Reads (STAR)"] == "0" and got["a", "Number of Reads Mapped to 3'UTR Regions"] == "NA" and len(got) == 2 * 238


def test_base_composition_does_not_explode_reads(spark):
    df = spark.createDataFrame([("s", "ACGTN"), ("s", "acgta"), ("s", "AC")], "sample_id string, seq string")
    got = {r.pos: (r.A, r.C, r.G, r["T"]) for r in O.base_composition(df, ["sample_id"], n=5).collect()}
    assert got == {1: (1, 0, 0, 0), 2: (0, 1, 0, 0), 3: (0, 0, 1, 0), 4: (0, 0, 0, 1), 5: (0.5, 0, 0, 0)}


def fragments_of(spark, all_pairs=True, n=400):
    rng = random.Random(n)
    rows = [("s", f"q{rng.randrange(n // 4)}", rng.choice([99, 147, 83, 163]), rng.choice("12"), rng.choice([rng.randrange(300), 1_999_900 + rng.randrange(300), 4_000_000]), float(rng.randrange(4)), rng.choice(["20M", "10M5N10M", "10M5I10M", "25M", "5S"]), rng.choice([255, 3]), rng.choice([1, 2, None])) for _ in range(n)]
    df = spark.createDataFrame(rows, "sample_id string, qname string, flag int, chrom string, st bigint, score double, cigar string, mapq int, nh int")
    return rows, L.pair_alignments(df, all_pairs=all_pairs)


@pytest.mark.parametrize("all_pairs", [True, False])
def test_pairing_is_one_shuffle(spark, all_pairs):
    _, frags = fragments_of(spark, all_pairs)
    assert plan(L.counting_units(frags)).count("Exchange") == 1
    # every alignment with a base is in a fragment; a place is in a pair or alone, never both
    got = frags.collect()
    pairs = [r for r in got if r.blocks_r1 and r.blocks_r2]
    used = {(r.qname, r.chrom, k, str(r[f"blocks_r{k}"]), r[f"rev{k}"]) for r in pairs for k in (1, 2)}
    alone = {(r.qname, r.chrom, k, str(r[f"blocks_r{k}"]), r[f"rev{k}"]) for r in got for k in (1, 2) if r[f"blocks_r{k}"] and not r[f"blocks_r{3 - k}"]}
    assert pairs and alone and not used & alone and len(got) == len(pairs) + len(alone)
    if not all_pairs:
        assert len({r.qname for r in pairs}) == len(pairs)


def test_fragments_meet_genes_without_further_joins(spark):
    frags = L.with_fragment_key(spark.createDataFrame([("s", "q", "1", [(0, 50)], None, False, None, 1.0, True)], "sample_id string, qname string, chrom string, blocks_r1 array<struct<s:bigint,e:bigint>>, blocks_r2 array<struct<s:bigint,e:bigint>>, rev1 boolean, rev2 boolean, score double, is_unique boolean"))
    exons = spark.createDataFrame([("g", "1", 0, 100, "+")], "gene_id string, chrom string, s2 bigint, e2 bigint, strand string")
    text = plan(L.fragment_gene_overlap(frags, exons))
    # blocks, exons, the sums, and the few levels that exons stand on
    assert text.count("Exchange hashpartitioning") == 4 and "ShuffledHashJoin" in text and "SortMergeJoin" not in text


def test_profile_cuts_what_has_signal(spark):
    rng = random.Random(3)
    regions = [(k, rng.choice("ab"), "1", rng.choice("+-"), s := rng.randrange(3000), s + rng.choice([5, 20, 33, 150])) for k in range(40)]
    signal = [("1", s := rng.randrange(3000), s + rng.choice([1, 7, 60]), float(rng.randrange(1, 9))) for _ in range(60)]
    r = spark.createDataFrame(regions, "region_id int, region_class string, chrom string, strand string, s2 bigint, e2 bigint")
    found = I.scaled_profile(spark.createDataFrame(signal, "chrom string, s bigint, e bigint, value double"), r, ["chrom"], width=64)
    want = {}
    for _, g, _, strand, s, e in regions:
        for i in range(20) if e - s >= 20 else ():
            a, b = s + i * (e - s) // 20, s + (i + 1) * (e - s) // 20
            want.setdefault((g, 19 - i if strand == "-" else i), []).append(sum(v * max(0, min(b, y) - max(a, x)) for _, x, y, v in signal) / (b - a))
    assert {(x.region_class, x.bin): round(x.value, 6) for x in found.collect()} == {k: round(sum(v) / len(v), 6) for k, v in want.items()}
    # regions are not joined back, part by part
    assert "LeftOuter" not in plan(found)


def test_clusters_of_two_starts_sort_once(spark):
    rows = spark.range(50).selectExpr("'k' as k", "id + cast(id / 7 as bigint) * 3 as s")
    text = plan(C.cluster_by_start(rows, ["k"]))
    assert text.count("Sort ") == 1


def test_annotations_are_not_sorted_against(spark):
    left, right = spark.range(9).selectExpr("1 as chrom", "id as s", "id + 2 as e", "1.0d as value"), spark.range(9).selectExpr("1 as chrom", "id as s2", "id + 3 as e2", "id as region_id")
    text = plan(I.signal_in_regions(left, right, ["chrom"]))
    assert "ShuffledHashJoin" in text


def test_lone_places_take_no_part_in_rounds(spark, monkeypatch):
    """Groups of one place keep the fraction 1, weigh as fixed coverage, and are in no round's tables."""
    seen, plain = [], E.next_fractions
    monkeypatch.setattr(E, "next_fractions", lambda by_place, by_piece, state, keys=(): (seen.append((by_place.select("locus").distinct().count(), state.count())), plain(by_place, by_piece, state, keys))[1])
    rows = [("s", "1", f"one{k}", f"o{k}", 1.0, 0, 100) for k in range(30)] + [("s", "1", "two", "t1", 1.0, 50, 150), ("s", "1", "two", "t2", 1.0, 500, 600)]
    blocks = spark.createDataFrame(rows, "sample_id string, chrom string, qname string, locus string, score double, s bigint, e bigint")
    unique = spark.createDataFrame([], "sample_id string, chrom string, s bigint, e bigint, value double")
    got = {r.locus: r.fraction for r in E.positional_em(blocks, unique).collect()}
    assert set(seen) == {(2, 2)} and len(got) == 32 and all(got[f"o{k}"] == 1.0 for k in range(30)) and got["t1"] > 0.9 and abs(got["t1"] + got["t2"] - 1) < 1e-9


def test_rows_meet_a_tiles_features_whole(spark):
    """Every shared base is counted once, over tiles' edges and for features of any length; a row is shuffled once a tile."""
    rng = random.Random(5)
    length = lambda: rng.choice([3, 40, 90, 2000, 200_000])
    features = [(f"g{k % 50}", rng.choice("12"), s := rng.randrange(4000), s + length()) for k in range(80)] + [("none", "1", 5, 5)]
    rows = [(k, rng.choice("12"), [(a := rng.randrange(4000), a + rng.choice([0, 5, 30])), (b := a + rng.choice([10, 3000]), b + 20)]) for k in range(60)]
    f = spark.createDataFrame(features, "gene string, chrom string, s2 bigint, e2 bigint")
    r = spark.createDataFrame([(k, c, [{"s": a, "e": b} for a, b in x]) for k, c, x in rows], "id int, chrom string, blocks array<struct<s:bigint,e:bigint>>")
    for some in (f, f.where("e2 - s2 < 100")):
        found, got = I.tiled_overlaps(r, some, ["chrom"], ["gene"], width=8).collect(), {}
        for x in found:
            for y in x.met:
                got[x.id, y.gene] = got.get((x.id, y.gene), 0) + y.overlap
        want = {}
        for g, c, s, e in some.collect():
            for k, d, own in rows:
                n = sum(max(0, min(e, y) - max(s, x)) for x, y in own) if c == d else 0
                want[k, g] = want.get((k, g), 0) + n
        assert got == {k: n for k, n in want.items() if n}
        # what is whole is there once
        assert all(sum(y.id == x.id for y in found) == 1 for x in found if x.whole)


def test_only_counts_of_whole_units_are_shuffled(spark):
    rng = random.Random(6)
    block = lambda a: [{"s": a, "e": a + 30}]
    frags = [("s", f"q{k}", "1", block(a := rng.randrange(5000)), block(a + rng.choice([40, 900, 2500])), False, True, 1.0, True) for k in range(120)]
    df = L.with_fragment_key(spark.createDataFrame(frags, "sample_id string, qname string, chrom string, blocks_r1 array<struct<s:bigint,e:bigint>>, blocks_r2 array<struct<s:bigint,e:bigint>>, rev1 boolean, rev2 boolean, score double, is_unique boolean"))
    exons = [(k // 2, "1", s := 50 * k, s + rng.choice([10, 45, 70]), "+") for k in range(110)]
    e = spark.createDataFrame(exons, "gene_id int, chrom string, s2 bigint, e2 bigint, strand string")
    want = {}
    for f in frags:
        hit = {}
        for x in (*f[3], *f[4]):
            for g, _, s, t, _ in exons:
                hit[g] = hit.get(g, 0) + max(0, min(t, x["e"]) - max(s, x["s"]))
        genes = [g for g, n in hit.items() if n >= 12]
        if len(genes) == 1:
            want[genes[0]] = want.get(genes[0], 0) + 1
    for chimeric in (False, True):
        found = L.feature_counts(df, e, min_bp=12, width=16, chimeric=chimeric)
        assert want and dict(map(tuple, found.collect())) == want
        # sums are by unit only where it is not whole
        assert "whole" in plan(found) and "SortMergeJoin" not in plan(found)


def test_rounds_cost_the_ends_of_blocks(spark):
    """What lies over a place is summed from the ends of blocks, over tiles' edges too, however deep these lie."""
    rng = random.Random(8)
    rows = [("q", None if k % 9 == 0 else k % 20, s := rng.randrange(150), s + rng.choice([0, 1, 7, 40]), float(rng.randrange(1, 5))) for k in range(120)]
    df = spark.createDataFrame(rows, "qname string, locus int, s bigint, e bigint, w double")
    found = {x.locus: x.cover for x in E.covered(E.tiled(df, 2).withColumn("cell", F.col("tile")), ["qname", "locus"]).collect()}
    want = {}
    for _, k, s, e, _ in rows:
        if k is not None and s < e:
            want[k] = want.get(k, 0) + sum(w * max(0, min(e, y) - max(s, x)) for _, _, x, y, w in rows)
    assert {k: round(x, 6) for k, x in found.items()} == want
    by_place = bucketed(E.tiled(df.where("locus is not null"), 64).selectExpr("qname", "locus", "tile as cell", "s", "e"), ["qname", "locus"])
    state = bucketed(df.where("locus is not null").select("qname", "locus").distinct().selectExpr("*", "1.0d as score", "1.0d as boost", "0.5d as fraction", "0.0d as base"), ["qname", "locus"])
    text = plan(E.next_fractions(by_place, None, state, ()))
    # ends by cell, sums by place, the state by read group
    assert text.count("Exchange hashpartitioning") == 3 and text.count("FileScan parquet") == 3


@pytest.mark.parametrize("most", [0, 1000])
def test_kmers_of_reads_are_not_shuffled_unless_references_are_large(spark, monkeypatch, most):
    seen, plain = [], O.written
    monkeypatch.setattr(O, "written", lambda df: (seen.append(plan(df)), plain(df))[1])
    monkeypatch.setattr(O, "BROADCAST", most)
    reads = spark.createDataFrame([("a", "ACGTTGCAAC"), ("a", "ACGTTGCAAC"), ("b", "ACGNTGCAACG"), ("c", None)], "read_id string, seq string")
    refs = spark.createDataFrame([("r", "ACGTTGCAACG"), ("t", "TTTTTTTT")], "ref string, seq string")
    # rows of one name are one read
    assert sorted(map(tuple, O.kmer_screen(reads, refs, k=6).collect())) == [("a", "r", 4), ("b", "r", 2)]
    assert most == 0 or "BroadcastHashJoin" in seen[1]


FRAGMENT = "sample_id string, qname string, chrom string, blocks_r1 array<struct<s:bigint,e:bigint>>, blocks_r2 array<struct<s:bigint,e:bigint>>, rev1 boolean, rev2 boolean, score double, is_unique boolean"


def test_blocks_go_to_tiles_packed(spark):
    """Small integers where all are such, whatever the place; names only with rows that are not whole."""
    at = 5_000_000_000
    rows = [("near", [(at, at + 20), (at - 30_000, at - 29_900)]), ("far", [(7, 20), (40_000, 40_010)]), ("long", [(0, 32_768)]), ("edge", [(0, 32_767)]), ("whole", [(100, 120)])]
    df = spark.createDataFrame([(k, "1", [{"s": a, "e": b} for a, b in x]) for k, x in rows], "name string, chrom string, blocks array<struct<s:bigint,e:bigint>>")
    _, near, far = I.packed(F.col("blocks"))
    assert {r.name: (r.n, r.f) for r in df.select("name", near.isNotNull().alias("n"), far.isNotNull().alias("f")).collect()} == {k: (k in ("near", "edge", "whole"), k in ("far", "long")) for k, _ in rows}
    features = spark.createDataFrame([(k, "1", a, b) for k, x in rows for a, b in x], "gene string, chrom string, s2 bigint, e2 bigint")
    got = {}
    for x in I.tiled_overlaps(df.withColumn("of", F.col("name")), features, ["chrom"], ["gene"], width=64, among=F.col("name") != "edge", apart=["of"]).collect():
        assert (x.of is None) == x.whole and x.whole == (x.name == "whole") and [(b.s, b.e) for b in x.blocks] == dict(rows)[x.name]
        for y in x.met:
            got[x.name, y.gene] = got.get((x.name, y.gene), 0) + y.overlap
    want = {(k, g): n for k, x in rows for g, y in rows if (n := sum(max(0, min(b, d) - max(a, c)) for a, b in x for c, d in y))}
    assert got == want
    lines = plan(I.tiled_overlaps(df, features, ["chrom"], ["gene"])).split("\n")
    shuffled = [b for a, b in zip(lines, lines[1:]) if "Exchange hashpartitioning" in a and " AS __" in b and "__tile" in a]
    assert any(" AS __near" in x and ", blocks#" not in x.split("CASE")[0] for x in shuffled)


def test_lone_genes_without_sets(spark):
    rng = random.Random(8)
    block = lambda a: [{"s": a, "e": a + rng.choice([5, 12, 30])}]
    frags = [("s", f"q{k}", "1", block(a := rng.randrange(5000)), block(a + rng.choice([40, 900, 2500])) if rng.random() < 0.7 else None, rng.random() < 0.5, rng.random() < 0.5, float(k), True) for k in range(300)]
    df = L.with_fragment_key(spark.createDataFrame(frags, FRAGMENT)).withColumn("spliced", F.col("score") % 2 == 0).withColumn("pas", F.col("score") % 3 == 0)
    exons = spark.createDataFrame([(f"g{k % 70}", "1", s := rng.randrange(7000), s + rng.choice([4, 15, 80]), "+-"[k % 70 % 2]) for k in range(150)], "gene_id string, chrom string, s2 bigint, e2 bigint, strand string")
    models = exons.groupBy("gene_id").agg(F.count("*").alias("exons")).where("gene_id <> 'g5'")
    for library in ("unstrand", "reverse"):
        found = L.lone_gene_counts(df, exons, models, library, min_fraction=0.3, width=8)
        want = L.unique_gene_counts(L.gene_sets(L.fragment_gene_overlap(df, exons, library, min_fraction=0.3, width=8, carried=["spliced", "pas"]), ["spliced", "pas"]), models)
        rows = sorted(map(tuple, found.select("gene_id", "count", "splice", "pas").collect()))
        assert len(rows) > 10 and rows == sorted(map(tuple, want.select("gene_id", "count", "splice", "pas").collect()))


def test_tracks_ask_for_no_marks(spark):
    """Without marks neither reads nor exons are looked at, and fragments are shuffled once, by read group."""
    rng = random.Random(4)
    rows = [(f"q{rng.randrange(100)}", rng.choice([99, 147, 83, 163]), rng.randrange(3000), rng.choice(["20M", "10M50N10M"]), rng.choice([1, 2])) for _ in range(200)]
    aln = spark.createDataFrame([("s", q, f, "1", at, cigar, 255, nh, 1.0, "C" * 20, "I" * 20) for q, f, at, cigar, nh in rows], "sample_id string, qname string, flag int, chrom string, st bigint, cigar string, mapq int, nh int, score double, seq string, qual string")
    exons = spark.createDataFrame([("g", "1", 0, 900, "+"), ("g", "1", 950, 1900, "+")], "gene_id string, chrom string, s bigint, e bigint, strand string")
    bare, none = E.placed_fragments(aln, exons, mode="primary", marks=False)
    text = plan(bare)
    assert none is None and not {"spliced", "pas"} & set(bare.columns) and text.count("Exchange") == 1 and "Join" not in text
    marked, _ = E.placed_fragments(aln, exons, mode="primary")
    tracks = lambda x: sorted(map(tuple, E.quantification_tracks(x).collect()))
    assert {"spliced", "pas"} <= set(marked.columns) and tracks(bare) == tracks(marked) != []
    assert plan(E.quantification_tracks(bare)).count("Scan") == 2  # those of the coverage, which share a shuffle


def test_base_classes_are_not_broadcast(spark):
    """The ruled stretches are as many as the annotation has ends: blocks meet them in tasks, not in a table that the driver sends."""
    classes = spark.createDataFrame([("coding", "1", 0, 10), ("utr", "1", 5, 30), ("utr", "2", 0, 4)], "base_class string, chrom string, s2 bigint, e2 bigint")
    blocks = spark.createDataFrame([("s", "1", 2, 12), ("s", "1", 25, 40), ("t", "2", 1, 3)], "sample_id string, chrom string, s bigint, e bigint")
    found = L.base_class_metrics(blocks, classes, ["coding", "utr"])
    assert {(r.sample_id, r.base_class): r.bases for r in found.collect()} == {("s", "coding"): 8, ("s", "utr"): 7, ("s", "intergenic"): 10, ("t", "utr"): 2, ("t", "intergenic"): 0}
    joins = [line for line in plan(found).splitlines() if "Join" in line and "__bin" in line]
    assert joins and all("ShuffledHashJoin" in line for line in joins)


@pytest.mark.parametrize("few", [50_000, 7])
def test_rounds_in_parts_are_rounds_of_places(spark, monkeypatch, few):
    """However many parts there are: fractions, and the number of rounds, are those of plain Python, over tiles' edges too."""
    from lociframe.operators import parts

    monkeypatch.setattr(parts, "FEW", (few, 64))
    rng = random.Random(3)
    places = [("s%d" % rng.randrange(2), rng.choice("12"), f"q{rng.randrange(25)}", f"l{k}", float(rng.randrange(3)), [(a := rng.randrange(400), a + rng.choice([5, 60])), (a + rng.choice([70, 200]), a + 230)]) for k in range(60)]
    unique = [("s%d" % rng.randrange(2), rng.choice("12"), a := rng.randrange(500), a + rng.choice([3, 40, 200]), float(rng.randrange(1, 4))) for _ in range(40)]
    p = spark.createDataFrame(places, "sample_id string, chrom string, qname string, locus string, score double, spans array<struct<s:bigint,e:bigint>>")
    u = spark.createDataFrame(unique, "sample_id string, chrom string, s bigint, e bigint, value double")
    rounds, plain = [], E.next_fractions
    monkeypatch.setattr(E, "next_fractions", lambda *a: (rounds.append(1), plain(*a))[1])
    got = {r.locus: r.fraction for r in E.positional_em(p, u, width=4).collect()}
    groups = {}
    for s, c, q, k, score, spans in places:
        groups.setdefault((s, q), []).append((k, (s, c), score, spans))
    share = lambda ws: [w / sum(ws) for w in ws]
    now = {k: f for own in groups.values() for (k, *_), f in zip(own, share([np.exp(x[2] - max(y[2] for y in own)) for x in own]))}
    over = lambda one, two: sum(max(0, min(b, d) - max(a, c)) for a, b in one for c, d in two)
    met = {k: [(j, n) for _, _, _, j, _, other in [x for x in places if x[:2] == (s, c)] if (n := over(spans, other))] for s, c, _, k, _, spans in places}
    base = {k: sum(v * over(spans, [(a, b)]) for t, d, a, b, v in unique if (t, d) == (s, c)) for s, c, _, k, _, spans in places}
    moved, times = 1.0, 0
    while moved >= 1e-3 and times < 100:
        after = {}
        for own in groups.values():
            best = max(x[2] for x in own)
            ws = [(base[k] + sum(now[j] * n for j, n in met[k] if now[j] >= E.LEAST) + E.EPSILON) * np.exp(score - best) for k, _, score, _ in own]
            after.update(zip((x[0] for x in own), share(ws)))
        moved, now, times = max(abs(after[k] - now[k]) for k in now), after, times + 1
    assert got.keys() == now.keys() and max(abs(got[k] - now[k]) for k in now) < 1e-9 and len(rounds) == times > 2


def test_plain_cigars_are_not_walked(spark):
    """Blocks of one or two matches need no walk over operations, and a filter on blocks does not make them twice."""
    from lociframe.functions import align as A

    cigars = ["20M", "5S20M", "10M5N10M3S", "2H5S10M5N10M3S2H", "10M2D10M", "10M5N10M5N10M", "3I10M", "5S", "*", None, "", "0M5N3M", "10=5X", "5M2P3M", "1M1N0M"]
    df = spark.createDataFrame([(100, c) for c in cigars], "st bigint, cigar string")
    rows = df.select("cigar", A.alignment_blocks(F.col("st"), F.col("cigar")).alias("a"), A._walked_blocks(F.col("st"), F.col("cigar")).alias("b"), A.has_blocks(F.col("cigar")).alias("has"), F.col("cigar").rlike(A.PLAIN).alias("plain")).collect()
    assert all(r.a == r.b and bool(r.has) == bool(r.a) for r in rows) and sum(bool(r.plain) for r in rows) == 6
    _, frags = fragments_of(spark)
    assert plan(frags).count("aggregate(zip_with") == 1


def test_rows_take_few_features_of_a_tile_along(spark):
    """A tile of 16,000 bases with 800 features: a row is compared with those about its blocks, whatever long ones there are."""
    rng = random.Random(9)
    features = [(f"g{k}", "1", s := 20 * k, s + rng.choice([5, 30, 60])) for k in range(800)] + [("long", "1", 3000, 15_000), ("all", "1", 0, 16_000)]
    rows = [(k, [(a := rng.randrange(15_800), a + 20), (b := rng.choice([a, a + 100, max(a - 300, 0)]), b + 30)]) for k in range(40)]
    f = spark.createDataFrame(features, "gene string, chrom string, s2 bigint, e2 bigint")
    r = spark.createDataFrame([(k, "1", [{"s": a, "e": b} for a, b in x]) for k, x in rows], "id int, chrom string, blocks array<struct<s:bigint,e:bigint>>")
    found = I.tiled_overlaps(r, f, ["chrom"], ["gene"])
    got = {}
    for x in found.collect():
        for y in x.met:
            got[x.id, y.gene] = got.get((x.id, y.gene), 0) + y.overlap
    assert got == {(k, g): n for k, own in rows for g, _, s, e in features if (n := sum(max(0, min(e, b) - max(s, a)) for a, b in own))}
    # the generators behind the join carry the slice, not the tile's features
    lines = [line for line in plan(found).splitlines() if "Generate inline" in line and "__numbers" in line]
    assert lines and all("__beside" in line and "__here" not in line for line in lines)


def test_a_summary_pairs_alignments_once(spark, monkeypatch):
    from lociframe.plans import alignment_queries as P

    calls, plain = [], L.pair_alignments
    monkeypatch.setattr(L, "pair_alignments", lambda *a, **k: (calls.append(1), plain(*a, **k))[1])
    assert P.QUERIES["a37_quant_summary"][0](spark, "/root/testdata/sf0.001").columns == ["read_groups", "ambiguous", "genes_unique", "genes_multi"]
    assert len(calls) == 1
