"""What holds whatever the data and the partitions."""

import inspect
import random

import pytest
from pyspark.sql import functions as F

from lociframe.operators import em, express, intervals
from lociframe.plans import alignment_queries, expression_queries, interval_queries
from lociframe.plans.adapters import v_iv
from lociframe.sources import sequences

SF = "/root/testdata/sf0.001"


def test_tpm_sums_to_a_million(spark):
    sums = express.tpm(expression_queries.counts(spark, SF)).groupBy("sample_id").agg(F.sum("tpm").alias("t")).collect()
    assert sums and all(abs(r.t - 1e6) < 1e-3 for r in sums)


def test_coverage_integral(spark):
    iv = v_iv(spark, SF)
    want = iv.agg(F.sum((F.col("e") - F.col("s")) * F.col("w"))).first()[0]
    for tile in (50, 100_000):
        got = intervals.coverage(iv, ["chrom"], weight=F.col("w"), tile=tile).agg(F.sum((F.col("e") - F.col("s")) * F.col("value"))).first()[0]
        assert abs(got - want) < 1e-6 * want


def test_partitions_do_not_matter(spark):
    iv = v_iv(spark, SF)
    rows = lambda df: sorted(map(tuple, intervals.merge_intervals(df, ["chrom"]).collect()))
    assert rows(iv) == rows(iv.repartition(7)) == rows(iv.orderBy(F.desc("s")))


def test_em_counts_add_up(spark):
    amb = alignment_queries.ambiguous(spark, SF)
    counts, alpha = em.gene_em(amb, alignment_queries.em_counts(spark, SF), 250.0, max_iter=5)
    assert abs(counts.agg(F.sum("em_count")).first()[0] - amb.count()) < 1e-6
    assert abs(alpha.agg(F.sum("alpha")).first()[0] - 1) < 1e-9


@pytest.mark.parametrize("name, operator", [("e1_positional_em", "positional_em"), ("e2_gene_em", "gene_em"), ("e4_quantify", "quantify"), ("a37_quant_summary", "quantify")])
def test_em_queries_run_to_the_tolerance(spark, monkeypatch, name, operator):
    asked, whole = [], inspect.signature(getattr(em, operator))

    def seen(*args, **kw):
        call = whole.bind(*args, **kw)
        call.apply_defaults()
        asked.append((call.arguments["max_iter"], call.arguments["tol"]))
        raise InterruptedError

    monkeypatch.setattr(em, operator, seen)
    with pytest.raises(InterruptedError):
        alignment_queries.QUERIES[name][0](spark, SF)
    assert asked == [(100, 1e-3)]


def test_short_rows_do_not_meet_in_coarse_bins(spark, monkeypatch):
    """The rows that the join of bins makes, before pairs are picked out, are few times the pairs."""
    frame, seen = type(spark.range(0)), []
    where = frame.where

    def counted(df, condition):
        if {"__kind", "s", "s2"} <= set(df.columns):
            seen.append(df.count())
        return where(df, condition)

    monkeypatch.setattr(frame, "where", counted)
    a, b = v_iv(spark, SF), interval_queries.regions(spark, SF)
    pairs = intervals.overlap_join(a, b, ["chrom"], 64).count()
    assert pairs and len(seen) == 1 and seen[0] <= 4 * (pairs + a.count() + b.count())


def test_merge_intervals_by_tiles(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), s := rng.randrange(0, 400), s + rng.choice([0, 1, 5, 60])) for _ in range(120)]
    want = set()
    for key in "ab":
        run = None
        for s, e in sorted((s, e) for k, s, e in rows if k == key):
            if run and s <= run[1]:
                run[1] = max(run[1], e)
            else:
                if run:
                    want.add((key, *run))
                run = [s, e]
        want.add((key, *run))
    df = spark.createDataFrame(rows, "chrom string, s bigint, e bigint")
    for tile in (1, 7, 50, 100_000):
        assert {tuple(r) for r in intervals.merge_intervals(df, ["chrom"], tile=tile).collect()} == want


def test_readers_put_splits_together(spark, tmp_path):
    """Files that are read in many splits: lines and bases are counted through all of them."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    rng = random.Random(9)
    base = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    reads = [(f"@r{k}", base(n := rng.randrange(0, 40)), "@" * n) for k in range(60)]
    (tmp_path / "a.fastq").write_text("".join(f"{r}\n{s}\n+\n{q}\n" for r, s, q in reads))
    contigs = {f"c{k}": base(rng.randrange(0, 300)) for k in range(12)}
    (tmp_path / "a.fa").write_text("".join(f">{c} x\n" + "".join(f"{s[i : i + 50]}\n" for i in range(0, len(s), 50)) for c, s in contigs.items()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = [(r.read_id, r.seq, r.qual) for r in sequences.read_fastq(spark, str(tmp_path / "a.fastq"), "s", 1).collect()]
        assert sorted(got) == sorted(reads)
        tiles = {(r.chrom, r.tile): r.seq for r in sequences.read_fasta_tiles(spark, str(tmp_path / "a.fa"), 70).collect()}
        assert tiles == {(c, i // 70): s[i : i + 70] for c, s in contigs.items() for i in range(0, len(s), 70)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
