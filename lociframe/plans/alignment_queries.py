"""Queries of the alignment and EM families: name -> (query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import align as A
from ..operators import align as L, em as E, express as X, intervals as I
from .adapters import SQL, sql, table, v_aln, v_exon, v_pe


def exons(s, d):
    return v_exon(s, d).select("gene_id", F.col("chrom").cast("string").alias("chrom"), "s", "e", "strand")


def merged(s, d):
    return exons(s, d).withColumnsRenamed({"s": "s2", "e": "e2"})


def fragments(s, d, **kw):
    own = v_aln(s, d).where(A.alignment_filter(F.col("flag")))
    return L.with_fragment_key(L.pair_alignments(own, **kw))


def paired(s, d, **kw):
    own = v_pe(s, d).where(A.alignment_filter(F.col("flag")))
    return L.with_fragment_key(L.pair_alignments(own, **kw))


def regions(s, d):
    """The exons as regions of eight classes, which overlap each other."""
    classes = F.array(*[F.lit(c) for c in L.REGION_CLASSES])
    return merged(s, d).select(F.element_at(classes, (F.col("gene_id") % len(L.REGION_CLASSES) + 1).cast("int")).alias("region_class"), F.col("gene_id").alias("region_id"), "chrom", "s2", "e2", "strand")


def sets(s, d, own=None, carried=()):
    own = fragments(s, d) if own is None else own
    return L.gene_sets(L.fragment_gene_overlap(own, merged(s, d), width=64, carried=carried), carried)


def marked(fragments):
    """Splice and poly(A) marks by the score, so that every kind is there."""
    return fragments.withColumn("spliced", F.col("score") % 2 == 0).withColumn("pas", F.col("score") % 3 == 0)


def tracts(s, d):
    """A reference of a thousand A, C, T and G on every chromosome that has alignments."""
    own = v_aln(s, d).select("chrom").distinct().select("chrom", F.explode(F.sequence(F.lit(0), F.lit(3)).cast("array<bigint>")).alias("tile"))
    return own.withColumn("seq", F.repeat(F.element_at(F.split(F.lit("A,C,T,G"), ","), (F.col("tile") + 1).cast("int")), F.lit(1000)))


def tailed(s, d):
    """Alignments with reads, of which those of every third line end in a clipped poly(A) tail (poly(T) on the reverse strand)."""
    own = v_aln(s, d)
    tail = F.when(A.flag(F.col("flag"), A.REVERSE), F.concat(F.lit("10S"), "cigar")).otherwise(F.concat("cigar", F.lit("10S")))
    bases = F.when(A.flag(F.col("flag"), A.REVERSE), F.concat(F.repeat(F.lit("T"), F.lit(10)), F.repeat(F.lit("C"), F.lit(60)))).otherwise(F.concat(F.repeat(F.lit("C"), F.lit(60)), F.repeat(F.lit("A"), F.lit(10))))
    has = F.col("mapq") % 120 == 0
    return own.withColumns({"cigar": F.when(has, tail).otherwise(F.col("cigar")), "seq": F.when(has, bases).otherwise(F.repeat(F.lit("C"), F.lit(60))), "qual": F.repeat(F.lit("I"), F.lit(70))})


def quantified(s, d, **kw):
    return E.quantify(tailed(s, d), exons(s, d), **kw)


def summarised(counts, fragments, sets):
    """The summary of one quantification, from the fragments and sets that it has made."""
    return E.quant_summary(fragments, sets, counts)


def ambiguous(s, d):
    """Pseudo-fragments of two or three genes among 50."""
    own = table(s, d, "lineitem").selectExpr("xxhash64(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as frag", "array_sort(array_distinct(array(l_partkey % 50, l_suppkey % 50, l_linenumber))) as genes", "1.0d as p", "false as spliced")
    return own.where("size(genes) > 1").dropDuplicates(["frag"])


def em_counts(s, d):
    return table(s, d, "lineitem").groupBy(F.expr("l_partkey % 50").alias("gene_id")).agg(F.sum("l_quantity").alias("count")).selectExpr("gene_id", "cast(300 + gene_id * 10 as bigint) as length", "2 as exons", "count")


bit = lambda b: f"(flag & {b}) <> 0"
PRIMARY = "(flag & 2304) = 0"
#: Fragments as SQL: mates paired (`pr`), all fragments (`f`, of 4 blocks at most), their blocks (`fb`) and genes (`hit`, `gs`).
PAIRS = """n AS (SELECT *, CASE WHEN (flag & 128) <> 0 THEN 2 ELSE 1 END AS mate, (flag & 16) <> 0 AS rev, coalesce(nh = 1, mapq >= 255) AS u, st + m1 + gap + m2 AS en FROM v_aln WHERE (flag & 3844) = 0),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, qname, chrom, st, m1, gap, m2, mate ORDER BY score DESC NULLS LAST, flag, mapq DESC) AS nth FROM n) WHERE nth = 1),
pa AS (SELECT a.sample_id, a.qname, a.chrom, a.st AS s1, a.m1 AS a1, a.gap AS g1, a.m2 AS b1, a.rev AS rev1, b.st AS s2, b.m1 AS a2, b.gap AS g2, b.m2 AS b2, b.rev AS rev2, a.score + b.score AS score, a.u AND b.u AS u,
  row_number() OVER (PARTITION BY a.sample_id, a.qname ORDER BY a.score + b.score DESC, a.chrom, a.st, b.st, a.en, b.en) AS place
  FROM o a JOIN o b USING (sample_id, qname, chrom) WHERE a.mate = 1 AND b.mate = 2 AND a.rev <> b.rev AND CASE WHEN a.rev THEN a.st >= b.st ELSE b.st >= a.st END AND greatest(a.en, b.en) - least(a.st, b.st) BETWEEN 10 AND 2000000),
pr AS (SELECT * FROM pa WHERE WANTED)"""
FRAGMENTS = PAIRS + """, us AS (SELECT sample_id, qname, chrom, 1 AS mate, s1 AS st, a1 AS m1, g1 AS gap, b1 AS m2, rev1 AS rev FROM pr UNION SELECT sample_id, qname, chrom, 2, s2, a2, g2, b2, rev2 FROM pr),
al AS (SELECT * FROM o ANTI JOIN us USING (sample_id, qname, chrom, mate, st, m1, gap, m2, rev)),
f AS MATERIALIZED (SELECT *, row_number() OVER () AS frag, count(*) OVER (PARTITION BY sample_id, qname) AS loci FROM (
  SELECT sample_id, qname, chrom, s1, a1, g1, b1, rev1, s2, a2, g2, b2, rev2, score, u FROM pr UNION ALL
  SELECT sample_id, qname, chrom, st, m1, gap, m2, rev, NULL, NULL, NULL, NULL, NULL, score, u FROM al WHERE mate = 1 UNION ALL
  SELECT sample_id, qname, chrom, NULL, NULL, NULL, NULL, NULL, st, m1, gap, m2, rev, score, u FROM al WHERE mate = 2))"""
HITS = FRAGMENTS + """, fb AS (SELECT frag, chrom, s1 AS s, s1 + a1 AS e FROM f WHERE s1 IS NOT NULL UNION ALL SELECT frag, chrom, s1 + a1 + g1, s1 + a1 + g1 + b1 FROM f WHERE s1 IS NOT NULL
  UNION ALL SELECT frag, chrom, s2, s2 + a2 FROM f WHERE s2 IS NOT NULL UNION ALL SELECT frag, chrom, s2 + a2 + g2, s2 + a2 + g2 + b2 FROM f WHERE s2 IS NOT NULL),
x AS (SELECT gene_id, CAST(chrom AS VARCHAR) AS chrom, s, e, strand FROM v_exon), mp AS (SELECT frag, sum(e - s) AS mapped FROM fb GROUP BY 1),
hit AS MATERIALIZED (SELECT frag, gene_id, bases FROM (SELECT frag, gene_id, sum(least(fb.e, x.e) - greatest(fb.s, x.s)) AS bases FROM fb JOIN x ON fb.chrom = x.chrom AND fb.s < x.e AND x.s < fb.e GROUP BY 1, 2) JOIN mp USING (frag)
  WHERE bases >= LEAST_BASES AND bases >= LEAST_SHARE * mapped),
gs AS (SELECT frag, min(gene_id) AS gene_id, count(*) AS genes FROM hit GROUP BY 1)"""


def fragment_sql(body, of=HITS, every="true", bases=10, share=0.01):
    return sql(of.replace("WANTED", every).replace("LEAST_BASES", str(bases)).replace("LEAST_SHARE", str(share)) + " " + body, "v_aln", "v_exon")


def paired_sql(body, of=HITS, **kw):
    """Over the view of read pairs, under the name that the fragments of SQL are made from."""
    return fragment_sql(body, of, **kw).replace(SQL["v_aln"], SQL["v_pe"], 1)


UNITS = """, un AS (SELECT sample_id, qname FROM f GROUP BY 1, 2 HAVING bool_and(u) AND (count(*) = 1 OR (CHIMERIC AND count(*) = 2 AND count(s1) = 1 AND count(s2) = 1)) AND count(s1) > 0 AND count(s2) > 0)"""

LABELS = """u AS (SELECT DISTINCT sample_id, qname, chrom, st, m1, gap, m2, flag FROM v_aln), b AS (SELECT *, st AS s, st + m1 AS e FROM u UNION ALL SELECT *, st + m1 + gap, st + m1 + gap + m2 FROM u),
h AS (SELECT b.sample_id, qname, b.chrom, st, m1, gap, m2, flag, min(strand) AS lo, max(strand) AS hi FROM b JOIN v_exon x ON b.chrom = CAST(x.chrom AS VARCHAR) AND b.s < x.e AND x.s < b.e GROUP BY ALL),
l AS (SELECT sample_id, CASE WHEN lo <> hi THEN 'both' ELSE (CASE WHEN (flag & 128) <> 0 THEN '2' ELSE '1' END) || (CASE WHEN (flag & 16) <> 0 THEN '-' ELSE '+' END) || lo END AS label FROM h)"""
UMIS = "l_suppkey % 4 AS sample_id, l_suppkey % 10 AS chrom, l_partkey % 50 AS pos, substr('ACGT', CAST(l_orderkey % 4 + 1 AS INTEGER), 1) || 'ACG' || substr('AAAC', CAST(l_linenumber % 4 + 1 AS INTEGER), 1) AS umi"
#: From c (places, UMIs, reads and their rank): which UMI of most reads reaches each one.
REACHED = """k_links AS (SELECT a.sample_id, a.chrom, a.pos, a.umi, b.umi AS umi2 FROM c a JOIN c b USING (sample_id, chrom, pos) WHERE a.reads >= 2 * b.reads - 1 AND length(a.umi) = length(b.umi) AND len(list_filter(range(1, length(a.umi) + 1), lambda i: substr(a.umi, i, 1) <> substr(b.umi, i, 1))) = 1),
r AS (SELECT sample_id, chrom, pos, umi AS source, place, umi FROM c UNION SELECT r.sample_id, r.chrom, r.pos, source, place, k.umi2 FROM r JOIN k_links k USING (sample_id, chrom, pos, umi)),
m AS (SELECT sample_id, chrom, pos, umi, arg_min(source, place) AS cluster FROM r GROUP BY 1, 2, 3, 4)"""

#: Rounds as recursion: the state of a round is a row of lists by gene (E2), or a row for each place (E1).
GENE_EM = """WITH RECURSIVE f AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem),
s AS MATERIALIZED (SELECT genes, count(*) AS c FROM (SELECT list_sort(list_distinct([l_partkey % 50, l_suppkey % 50, CAST(l_linenumber AS BIGINT)])) AS genes FROM f) WHERE len(genes) > 1 GROUP BY 1),
g AS (SELECT l_partkey % 50 AS gene, sum(l_quantity) AS own, 51 + 10 * (l_partkey % 50) AS eff FROM lineitem GROUP BY ALL),
h AS MATERIALIZED (SELECT list(gene ORDER BY gene) AS genes, list(own ORDER BY gene) AS own, list(eff ORDER BY gene) AS eff FROM g),
z AS (SELECT own, list_transform(range(1, len(own) + 1), lambda k: (own[k] + 0.1) / eff[k]) AS raw FROM h),
r AS (SELECT 0 AS i, list_transform(raw, lambda x: x / list_sum(raw)) AS alpha, list_transform(own, lambda x: 0.0::DOUBLE) AS em, 1.0::DOUBLE AS moved FROM z
UNION ALL
SELECT i, alpha, em, list_max(list_transform(range(1, len(alpha) + 1), lambda k: abs(alpha[k] - old[k]))) FROM (
  SELECT i, old, em, list_transform(raw, lambda x: x / list_sum(raw)) AS alpha FROM (
    SELECT i, old, em, list_transform(range(1, len(em) + 1), lambda k: (own[k] + em[k] + 0.1) / eff[k]) AS raw FROM (
      SELECT i + 1 AS i, alpha AS old, list(x ORDER BY gene) AS em FROM (
        SELECT i, alpha, gene, sum(c * alpha[list_position(h.genes, gene)] / total) AS x FROM (
          SELECT i, alpha, c, unnest(s.genes) AS gene, list_sum(list_transform(s.genes, lambda x: alpha[list_position(h.genes, x)])) AS total FROM r, s, h WHERE moved >= 1e-3 AND i < 100), h GROUP BY ALL)
      GROUP BY i, alpha), h)))
SELECT unnest(h.genes) AS gene_id, round(unnest(em), 3) AS em_count FROM r, h WHERE i = (SELECT max(i) FROM r)"""
PLACE_ROUNDS = """ev AS (SELECT sample_id, chrom, pos, sum(d) AS d, sum(h) AS h FROM (SELECT sample_id, chrom, unnest([s, e]) AS pos, unnest([1, -1]) AS d, 0 AS h FROM ab UNION ALL SELECT sample_id, chrom, unnest([s, e]), 0, unnest([1, -1]) FROM bl) GROUP BY 1, 2, 3),
pc AS MATERIALIZED (SELECT sample_id, chrom, pos AS s, lead(pos) OVER w AS e, sum(d) OVER w AS base, sum(h) OVER w AS held FROM ev WINDOW w AS (PARTITION BY sample_id, chrom ORDER BY pos)),
sh AS MATERIALIZED (SELECT bl.frag, pc.sample_id, pc.chrom, pc.s, max(pc.base) AS base, sum(least(bl.e, pc.e) - greatest(bl.s, pc.s)) AS bases, count(*) AS times FROM bl JOIN pc ON bl.sample_id = pc.sample_id AND bl.chrom = pc.chrom AND bl.s < pc.e AND pc.s < bl.e WHERE held > 0 GROUP BY ALL),
ca AS (SELECT DISTINCT sample_id, chrom, qname, frag, score FROM bl), cb AS (SELECT *, exp(greatest(score - max(score) OVER (PARTITION BY sample_id, qname), -700)) AS boost FROM ca),
r AS (SELECT 0 AS i, sample_id, chrom, qname, frag, score, boost, boost / sum(boost) OVER (PARTITION BY sample_id, qname) AS fraction, 1.0::DOUBLE AS moved FROM cb
UNION ALL
SELECT i + 1, sample_id, chrom, qname, frag, score, boost, after, max(abs(after - fraction)) OVER () FROM (
  SELECT *, weight / sum(weight) OVER (PARTITION BY sample_id, qname) AS after FROM (
    SELECT i, sample_id, chrom, qname, frag, score, boost, fraction, (cover + 1e-9) * boost AS weight FROM (
      SELECT i, sample_id, chrom, qname, frag, score, boost, fraction, sum(bases * (base + extra)) AS cover FROM (
      SELECT i, r.sample_id, r.chrom, qname, r.frag, score, boost, fraction, bases, base, sum(CASE WHEN fraction >= 1e-9 THEN fraction * times ELSE 0 END) OVER (PARTITION BY r.sample_id, r.chrom, sh.s) AS extra
      FROM r JOIN sh ON r.frag = sh.frag WHERE moved >= 1e-3 AND i < 100) GROUP BY ALL)))),
placed AS MATERIALIZED (SELECT * FROM r WHERE i = (SELECT max(i) FROM r))"""
PLACE_EM = (
    FRAGMENTS.replace("WANTED", "true")
    + """, bl AS (SELECT sample_id, chrom, qname, frag, score, unnest([s1, s1 + a1 + g1]) AS s, unnest([s1 + a1, s1 + a1 + g1 + b1]) AS e FROM f WHERE s1 IS NOT NULL
  UNION ALL SELECT sample_id, chrom, qname, frag, score, unnest([s2, s2 + a2 + g2]), unnest([s2 + a2, s2 + a2 + g2 + b2]) FROM f WHERE s2 IS NOT NULL),
ab AS (SELECT sample_id, chrom, st AS s, st + m1 AS e FROM v_aln UNION ALL SELECT sample_id, chrom, st + m1 + gap, st + m1 + gap + m2 FROM v_aln), """
    + PLACE_ROUNDS + " SELECT sample_id, chrom, qname, score, round(fraction, 6) AS fraction FROM placed"
)
#: The whole quantification (EM for places and for genes) as SQL, up to `q`, a row a gene.
QUANTIFIED = (
    HITS.replace("WANTED", "true").replace("LEAST_BASES", "10").replace("LEAST_SHARE", "0.01")
    + """, fm AS MATERIALIZED (SELECT *, loci = 1 AND u AS alone, coalesce(g1 % 30 = 0, false) OR coalesce(g2 % 30 = 0, false) AS pas FROM f),
bl AS (SELECT sample_id, fb.chrom, qname, frag, score, fb.s, fb.e FROM fb JOIN fm USING (frag) WHERE NOT alone), ab AS (SELECT sample_id, fb.chrom, fb.s, fb.e FROM fb JOIN fm USING (frag) WHERE alone), """
    + PLACE_ROUNDS + """, fp AS MATERIALIZED (SELECT fm.frag, alone, pas, CASE WHEN alone THEN 1.0 ELSE fraction END AS p FROM fm LEFT JOIN placed USING (frag) WHERE alone OR fraction > 1e-9),
t AS MATERIALIZED (SELECT v.gene_id, v.e - v.s AS length, greatest(v.e - v.s - 249, 1)::DOUBLE AS eff, coalesce(n, 0)::DOUBLE AS uniq, coalesce(m, 0)::DOUBLE AS multi, coalesce(pas, 0)::DOUBLE AS pas FROM v_exon v LEFT JOIN (
  SELECT gene_id, sum(p) FILTER (alone) AS n, sum(p) FILTER (NOT alone) AS m, sum(p) FILTER (pas) AS pas FROM gs JOIN fp USING (frag) WHERE genes = 1 GROUP BY 1) USING (gene_id)),
am AS MATERIALIZED (SELECT frag, hit.gene_id, p FROM hit JOIN gs USING (frag) JOIN fp USING (frag) WHERE genes > 1),
e AS (SELECT 0 AS i, gene_id, eff, uniq + multi AS own, (uniq + multi + 0.1) / eff / sum((uniq + multi + 0.1) / eff) OVER () AS alpha, 0.0::DOUBLE AS em, 1.0::DOUBLE AS moved FROM t
UNION ALL
SELECT i + 1, gene_id, eff, own, after, em, max(abs(after - alpha)) OVER () FROM (
  SELECT *, (own + em + 0.1) / eff / sum((own + em + 0.1) / eff) OVER () AS after FROM (
    SELECT i, gene_id, eff, own, alpha, coalesce(sum(share), 0.0) AS em FROM (
      SELECT i, e.gene_id, eff, own, alpha, CASE WHEN frag IS NOT NULL THEN p * alpha / sum(alpha) OVER (PARTITION BY frag) END AS share FROM e LEFT JOIN am USING (gene_id) WHERE moved >= 1e-3 AND i < 100) GROUP BY ALL))),
q AS (SELECT gene_id, length, uniq, multi + em AS multi, uniq + multi + em AS total, uniq / eff * 1e6 / sum((uniq + multi + em) / eff) OVER () AS tpm_uniq, (uniq + multi + em) / eff * 1e6 / sum((uniq + multi + em) / eff) OVER () AS tpm, pas FROM t JOIN (SELECT gene_id, em FROM e WHERE i = (SELECT max(i) FROM e)) USING (gene_id))"""
)


def quantified_sql(body):
    return sql(QUANTIFIED + " " + body, "v_aln", "v_exon").replace("WITH ", "WITH RECURSIVE ", 1)


QUERIES = {
    "p9_cigar_junctions": (lambda s, d: v_aln(s, d).select("qname", "st", A.cigar_junctions(F.col("cigar")).cast("long").alias("junctions"), A.cigar_mapped_length(F.col("cigar")).alias("mapped")), sql("SELECT qname, st, CAST(1 AS BIGINT) AS junctions, m1 + m2 AS mapped FROM v_aln", "v_aln")),
    "p10_alignment_blocks": (lambda s, d: v_aln(s, d).select("qname", F.inline(A.alignment_blocks(F.col("st"), F.col("cigar")))), sql("SELECT qname, st AS s, st + m1 AS e FROM v_aln UNION ALL SELECT qname, st + m1 + gap, st + m1 + gap + m2 FROM v_aln", "v_aln")),
    "s10_parse_cigar": (lambda s, d: v_aln(s, d).select("qname", F.explode(A.parse_cigar(F.col("cigar"))).alias("x")).groupBy("x.op").agg(F.count("*").alias("ops"), F.sum("x.len").alias("bases")), sql("SELECT 'M' AS op, 2 * count(*) AS ops, CAST(sum(m1 + m2) AS BIGINT) AS bases FROM v_aln UNION ALL SELECT 'N', count(*), CAST(sum(gap) AS BIGINT) FROM v_aln", "v_aln")),
    "p11_is_unique": (lambda s, d: v_aln(s, d).groupBy(A.is_unique(F.col("nh"), F.col("mapq"), 255).alias("u")).agg(F.count("*").alias("n")), sql("SELECT coalesce(nh = 1, mapq >= 255) AS u, count(*) AS n FROM v_aln GROUP BY 1", "v_aln")),
    "p12_auto_mapq_threshold": (lambda s, d: L.auto_mapq_threshold(v_aln(s, d)), sql("SELECT sample_id, CAST(CASE WHEN count(nh) > 0 OR max(mapq) >= 255 THEN 255 WHEN max(mapq) >= 60 THEN 60 WHEN max(mapq) >= 40 THEN 40 ELSE 30 END AS INTEGER) AS threshold FROM v_aln GROUP BY 1", "v_aln")),
    "p13_strand_bucket": (lambda s, d: v_aln(s, d).groupBy(A.strand_bucket(A.flag(F.col("flag"), 128), A.flag(F.col("flag"), 16)).alias("bucket")).agg(F.count("*").alias("n")), sql(f"SELECT CASE WHEN ({bit(128)}) <> ({bit(16)}) THEN 'F2R1' ELSE 'F1R2' END AS bucket, count(*) AS n FROM v_aln GROUP BY 1", "v_aln")),
    "p14_strand_compatible": (lambda s, d: v_aln(s, d).select("sample_id", *[A.strand_compatible(F.when(A.flag(F.col("flag"), 64), A.flag(F.col("flag"), 16)), F.when(A.flag(F.col("flag"), 128), A.flag(F.col("flag"), 16)), F.lit("+"), x).alias(x) for x in ("forward", "reverse")]).groupBy("forward", "reverse").agg(F.count("*").alias("n")),
        sql(f"SELECT (({bit(64)}) AND NOT ({bit(16)})) OR (({bit(128)}) AND ({bit(16)})) AS forward, (({bit(64)}) AND ({bit(16)})) OR (({bit(128)}) AND NOT ({bit(16)})) AS reverse, count(*) AS n FROM v_aln GROUP BY 1, 2", "v_aln")),
    "p15_sense_read": (lambda s, d: v_aln(s, d).where(A.sense_read(A.flag(F.col("flag"), 64), "reverse")).groupBy("sample_id").agg(F.count("*").alias("n")), sql(f"SELECT sample_id, count(*) AS n FROM v_aln WHERE NOT ({bit(64)}) GROUP BY 1", "v_aln")),
    "p17_has_splice": (lambda s, d: v_aln(s, d).where(A.has_splice(F.col("cigar"), 30)).groupBy("sample_id").agg(F.count("*").alias("n")), sql("SELECT sample_id, count(*) AS n FROM v_aln WHERE gap >= 30 GROUP BY 1", "v_aln")),
    "p20_alignment_filter": (lambda s, d: v_aln(s, d).where(A.alignment_filter(F.col("flag"))).groupBy("sample_id").agg(F.count("*").alias("n")), sql("SELECT sample_id, count(*) AS n FROM v_aln WHERE (flag & 3844) = 0 GROUP BY 1", "v_aln")),
    "p21_clip_to_chrom": (lambda s, d: v_aln(s, d).select("sample_id", F.inline(A.clip_blocks(A.alignment_blocks(F.col("st"), F.col("cigar")), F.lit(5000)))).groupBy("sample_id").agg(F.sum(F.col("e") - F.col("s")).alias("bases")),
        sql("b AS (SELECT sample_id, st AS s, st + m1 AS e FROM v_aln UNION ALL SELECT sample_id, st + m1 + gap, st + m1 + gap + m2 FROM v_aln) SELECT sample_id, CAST(sum(least(e, 5000) - s) AS BIGINT) AS bases FROM b WHERE s < 5000 AND e > s GROUP BY 1", "v_aln")),
    "a7_splice_per_kb": (lambda s, d: L.splice_per_kb(v_aln(s, d), mapq=240), sql("SELECT sample_id, count(*) AS junctions, CAST(sum(m1 + m2) AS BIGINT) AS bases, round(count(*) * 1000.0 / sum(m1 + m2), 4) AS splice_per_kb FROM v_aln WHERE (flag & 256) = 0 AND mapq = 240 GROUP BY 1", "v_aln")),
    "a9_mapped_fragments": (lambda s, d: L.mapped_fragment_count(v_aln(s, d)), sql("SELECT sample_id, count(DISTINCT qname) AS n FROM v_aln GROUP BY 1", "v_aln")),
    "a22_rpm_scale": (lambda s, d: L.rpm_scale(v_aln(s, d)).select("sample_id", F.round("scale", 6).alias("scale")), sql("SELECT sample_id, round(1e6 / count(DISTINCT qname), 6) AS scale FROM v_aln GROUP BY 1", "v_aln")),
    "a27_flagstat": (lambda s, d: L.flagstat(v_aln(s, d)).select("sample_id", "total", "secondary", "primary_mapped", "read1", "read2"),
        sql(f"SELECT sample_id, count(*) AS total, CAST(count(*) FILTER ({bit(256)}) AS BIGINT) AS secondary, count(*) FILTER ({PRIMARY}) AS primary_mapped, count(*) FILTER ({PRIMARY} AND {bit(64)}) AS read1, count(*) FILTER ({PRIMARY} AND {bit(128)}) AS read2 FROM v_aln GROUP BY 1", "v_aln")),
    "a21_fragment_length": (lambda s, d: L.fragment_length_stats(v_aln(s, d).withColumn("flag", F.col("flag") + 2)).select("sample_id", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd")),
        sql("u AS (SELECT sample_id, tlen FROM v_aln WHERE (flag & 256) = 0 AND tlen > 0), q AS (SELECT sample_id, quantile_cont(tlen, 0.25) AS a, quantile_cont(tlen, 0.75) AS b FROM u GROUP BY 1) SELECT sample_id, round(avg(tlen), 4) AS mean, round(stddev_pop(tlen), 4) AS sd FROM u JOIN q USING (sample_id) WHERE tlen BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) GROUP BY 1", "v_aln")),
    "a28_insert_size": (lambda s, d: L.insert_size_metrics(v_aln(s, d)).select("sample_id", "median", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"), "low", "high"),
        sql(f"SELECT sample_id, median(abs(tlen)) AS median, round(avg(abs(tlen)), 4) AS mean, round(stddev_pop(abs(tlen)), 4) AS sd, min(abs(tlen)) AS low, max(abs(tlen)) AS high FROM v_aln WHERE {bit(64)} AND (flag & 256) = 0 AND tlen <> 0 GROUP BY 1", "v_aln")),
    "w13_dedup_alignments": (lambda s, d: L.dedup_alignments(v_aln(s, d)).select("sample_id", "qname", "chrom", "st", "cigar", "flag", "score", "mapq"),
        sql(f"""n AS (SELECT *, row_number() OVER (PARTITION BY sample_id, qname, chrom, st, m1, gap, m2, {bit(128)} ORDER BY score DESC NULLS LAST, flag, mapq DESC) AS nth FROM v_aln)
        SELECT sample_id, qname, chrom, st, m1 || 'M' || gap || 'N' || m2 || 'M' AS cigar, flag, score, mapq FROM n WHERE nth = 1""", "v_aln")),
    "w10_cap_alignments": (lambda s, d: L.cap_alignments_per_mate(v_aln(s, d), 1).select("sample_id", "qname", "chrom", "st", "cigar", "flag", "score"),
        sql(f"""c AS (SELECT *, m1 || 'M' || gap || 'N' || m2 || 'M' AS cigar FROM v_aln), n AS (SELECT *, row_number() OVER (PARTITION BY sample_id, qname, {bit(128)} ORDER BY score DESC NULLS LAST, chrom, st, cigar, flag) AS nth FROM c)
        SELECT sample_id, qname, chrom, st, cigar, flag, score FROM n WHERE nth = 1""", "v_aln")),
    "j2_pair_alignments": (lambda s, d: fragments(s, d).groupBy("sample_id", "is_unique", F.col("blocks_r1").isNotNull().alias("r1"), F.col("blocks_r2").isNotNull().alias("r2")).agg(F.count("*").alias("n"), F.sum("score").alias("score")),
        fragment_sql("SELECT sample_id, u AS is_unique, s1 IS NOT NULL AS r1, s2 IS NOT NULL AS r2, count(*) AS n, sum(score) AS score FROM f GROUP BY 1, 2, 3, 4", FRAGMENTS)),
    "w9_dedup_fragments": (lambda s, d: L.dedup_fragments_by_locus(fragments(s, d).unionByName(fragments(s, d).withColumn("score", F.col("score") - 1))).select("sample_id", "qname", "chrom", F.element_at("blocks_r1", 1).s.alias("s1"), F.element_at("blocks_r2", 1).s.alias("s2"), "score").fillna(-1, ["s1", "s2"]),
        fragment_sql("SELECT sample_id, qname, chrom, coalesce(s1, -1) AS s1, coalesce(s2, -1) AS s2, score FROM f", FRAGMENTS)),
    "j4_fragment_gene_overlap": (lambda s, d: L.fragment_gene_overlap(fragments(s, d), merged(s, d), width=64).groupBy("gene_id").agg(F.count("*").alias("fragments"), F.sum("bases").alias("bases")),
        fragment_sql("SELECT gene_id, count(*) AS fragments, CAST(sum(bases) AS BIGINT) AS bases FROM hit GROUP BY 1")),
    "j12_infer_strand": (lambda s, d: L.infer_strand(v_aln(s, d), merged(s, d), width=64).groupBy("sample_id", "label").agg(F.count("*").alias("n")), sql(LABELS + " SELECT sample_id, label, count(*) AS n FROM l GROUP BY 1, 2", "v_aln", "v_exon")),
    "a8_strand_fractions": (lambda s, d: L.strand_fractions(L.infer_strand(v_aln(s, d), merged(s, d), width=64)).select("sample_id", *[F.round(c, 8).alias(c) for c in ("forward", "reverse", "undetermined")]),
        sql(LABELS + """ SELECT sample_id, round(avg(CASE WHEN label IN ('1++', '1--', '2+-', '2-+') THEN 1 ELSE 0 END), 8) AS forward, round(avg(CASE WHEN label IN ('1+-', '1-+', '2++', '2--') THEN 1 ELSE 0 END), 8) AS reverse,
        round(avg(CASE WHEN label = 'both' THEN 1 ELSE 0 END), 8) AS undetermined FROM l GROUP BY 1""", "v_aln", "v_exon")),
    "a15_feature_counts": (lambda s, d: L.feature_counts(paired(s, d), merged(s, d), width=64),
        paired_sql("SELECT gene_id, count(*) AS count FROM gs JOIN f USING (frag) WHERE genes = 1 AND loci = 1 AND u AND s1 IS NOT NULL AND s2 IS NOT NULL GROUP BY 1", bases=1, share=0.0)),
    "a15_feature_counts_stranded": (lambda s, d: L.feature_counts(paired(s, d), merged(s, d), "reverse", width=64),
        paired_sql("""SELECT gene_id, count(*) AS count FROM (SELECT frag, min(hit.gene_id) AS gene_id FROM hit JOIN f USING (frag) JOIN v_exon v ON v.gene_id = hit.gene_id WHERE loci = 1 AND u AND s1 IS NOT NULL AND s2 IS NOT NULL
        AND rev1 <> (v.strand = '-') AND rev2 = (v.strand = '-') GROUP BY 1 HAVING count(*) = 1) GROUP BY 1""", bases=1, share=0.0)),
    "a15_feature_counts_chimeric": (lambda s, d: L.feature_counts(paired(s, d), merged(s, d), chimeric=True, width=64),
        paired_sql(UNITS.replace("CHIMERIC", "true")[2:] + """, ug AS (SELECT sample_id, qname, gene_id FROM hit JOIN f USING (frag) SEMI JOIN un USING (sample_id, qname) GROUP BY 1, 2, 3)
        SELECT gene_id, count(*) AS count FROM (SELECT min(gene_id) AS gene_id FROM ug GROUP BY sample_id, qname HAVING count(*) = 1) GROUP BY 1""", HITS + ",", bases=1, share=0.0)),
    "a15_feature_counts_single": (lambda s, d: L.feature_counts(fragments(s, d), merged(s, d), require_both=False, width=64), fragment_sql("SELECT gene_id, count(*) AS count FROM gs JOIN f USING (frag) WHERE genes = 1 AND loci = 1 AND u GROUP BY 1", bases=1, share=0.0)),
    "a16_region_class_counts": (lambda s, d: L.region_class_counts(paired(s, d), regions(s, d), "reverse", width=64).select("sample_id", F.col("ord").cast("long").alias("ord"), "region_class", "reads", F.round("share", 8).alias("share")),
        paired_sql(UNITS.replace("CHIMERIC", "false")[2:] + f""", c AS (SELECT unnest(range(0, 8)) AS k, unnest({list(L.REGION_CLASSES)}) AS region_class),
        r AS (SELECT gene_id % 8 AS k, gene_id AS region_id, CAST(chrom AS VARCHAR) AS chrom, s, e, strand FROM v_exon),
        h AS (SELECT f.sample_id, f.qname, r.k, r.region_id FROM fb JOIN r ON fb.chrom = r.chrom AND fb.s < r.e AND r.s < fb.e JOIN f ON f.frag = fb.frag SEMI JOIN un ON un.sample_id = f.sample_id AND un.qname = f.qname
          WHERE r.k >= 6 OR (coalesce(rev1 <> (r.strand = '-'), true) AND coalesce(rev2 = (r.strand = '-'), true)) GROUP BY 1, 2, 3, 4),
        one AS (SELECT sample_id, k FROM h GROUP BY sample_id, qname, k HAVING count(*) = 1), nk AS (SELECT sample_id, k, count(*) AS reads FROM one GROUP BY 1, 2)
        SELECT s.sample_id, c.k + 1 AS ord, region_class, coalesce(reads, 0) AS reads, round(coalesce(reads, 0) / sum(coalesce(reads, 0)) OVER (PARTITION BY s.sample_id), 8) AS share
        FROM (SELECT DISTINCT sample_id FROM f) s CROSS JOIN c LEFT JOIN nk n ON n.sample_id = s.sample_id AND n.k = c.k""", HITS + ",", bases=1, share=0.0)),
    "a20_unique_gene_counts": (lambda s, d: L.lone_gene_counts(L.unique_fragments(marked(fragments(s, d))), merged(s, d), X.gene_model(exons(s, d)).withColumn("exons", 1 + F.col("gene_id") % 2), width=64),
        fragment_sql("SELECT gene_id, count(*) AS count, count(*) FILTER (score % 2 = 0 AND gene_id % 2 = 1) AS splice, count(*) FILTER (score % 3 = 0) AS pas FROM gs JOIN f USING (frag) WHERE genes = 1 AND loci = 1 AND u GROUP BY 1")),
    "a28_base_classes": (lambda s, d: L.base_class_metrics(v_aln(s, d).select("sample_id", "chrom", F.inline(A.alignment_blocks(F.col("st"), F.col("cigar")))), merged(s, d).withColumn("base_class", F.when(F.col("gene_id") % 3 == 0, "coding").when(F.col("gene_id") % 3 == 1, "utr").otherwise("intron")), ["coding", "utr", "intron"], width=64).select("sample_id", "base_class", "bases", F.round("fraction", 6).alias("fraction")),
        sql("""b AS (SELECT sample_id, chrom, st AS s, st + m1 AS e FROM v_aln UNION ALL SELECT sample_id, chrom, st + m1 + gap, st + m1 + gap + m2 FROM v_aln), x AS (SELECT CAST(chrom AS VARCHAR) AS chrom, s, e, gene_id % 3 AS c FROM v_exon),
        p AS (SELECT chrom, s AS pos FROM x UNION SELECT chrom, e FROM x), q AS (SELECT chrom, pos AS s, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS e FROM p),
        r AS (SELECT q.chrom, q.s, q.e, min(c) AS c FROM q JOIN x ON q.chrom = x.chrom AND x.s <= q.s AND q.e <= x.e GROUP BY 1, 2, 3), t AS (SELECT sample_id, sum(e - s) AS total FROM b GROUP BY 1),
        h AS (SELECT sample_id, c, sum(least(b.e, r.e) - greatest(b.s, r.s)) AS bases FROM b JOIN r ON b.chrom = r.chrom AND b.s < r.e AND r.s < b.e GROUP BY 1, 2),
        y AS (SELECT sample_id, CASE c WHEN 0 THEN 'coding' WHEN 1 THEN 'utr' ELSE 'intron' END AS base_class, bases FROM h UNION ALL SELECT sample_id, 'intergenic', total - coalesce(met, 0) FROM t LEFT JOIN (SELECT sample_id, sum(bases) AS met FROM h GROUP BY 1) USING (sample_id))
        SELECT sample_id, base_class, CAST(bases AS BIGINT) AS bases, round(bases / total, 6) AS fraction FROM y JOIN t USING (sample_id)""", "v_aln", "v_exon")),
    "a34_umi_clusters": (lambda s, d: L.umi_clusters(table(s, d, "lineitem").selectExpr("l_suppkey % 4 as sample_id", "l_suppkey % 10 as chrom", "l_partkey % 50 as pos", "'+' as strand", "concat(substring('ACGT', cast(l_orderkey % 4 + 1 as int), 1), 'ACG', substring('AAAC', cast(l_linenumber % 4 + 1 as int), 1)) as umi")),
        f"WITH RECURSIVE c AS (SELECT *, row_number() OVER (PARTITION BY sample_id, chrom, pos ORDER BY reads DESC, umi) AS place FROM (SELECT {UMIS}, count(*) AS reads FROM lineitem GROUP BY ALL)), {REACHED} SELECT sample_id, chrom, pos, '+' AS strand, umi, reads, cluster FROM c JOIN m USING (sample_id, chrom, pos, umi)"),
    "a34_umi_dedup": (lambda s, d: L.umi_dedup(v_pe(s, d)).select("sample_id", "qname", F.col("flag").cast("long").alias("flag"), "chrom", "st"),
        sql(f"""a AS (SELECT *, split_part(qname, '_', 2) AS umi, CASE WHEN {bit(16)} THEN st + m1 + gap + m2 ELSE st END AS five, ({bit(16)}) AS back, NOT ({bit(128)}) AS one FROM v_pe),
        b AS (SELECT sample_id, chrom || back AS chrom, five AS pos, umi, qname, mapq FROM a WHERE one), c AS (SELECT *, row_number() OVER (PARTITION BY sample_id, chrom, pos ORDER BY reads DESC, umi) AS place FROM (SELECT sample_id, chrom, pos, umi, count(*) AS reads FROM b GROUP BY ALL)), {REACHED},
        k AS (SELECT DISTINCT sample_id, chrom, pos, qname FROM (SELECT b.*, row_number() OVER (PARTITION BY sample_id, chrom, pos, cluster ORDER BY mapq DESC, qname) AS nth FROM b JOIN m USING (sample_id, chrom, pos, umi)) WHERE nth = 1)
        SELECT sample_id, qname, flag, chrom, st FROM a WHERE one AND EXISTS (SELECT 1 FROM k WHERE k.sample_id = a.sample_id AND k.qname = a.qname AND k.chrom = a.chrom || a.back AND k.pos = a.five)
        UNION ALL SELECT sample_id, qname, flag, chrom, st FROM a WHERE NOT one AND EXISTS (SELECT 1 FROM k WHERE k.sample_id = a.sample_id AND k.qname = a.qname)""", "v_pe").replace("WITH ", "WITH RECURSIVE ", 1)),
    "p16_proper_pair": (lambda s, d: fragments(s, d, all_pairs=False).where("blocks_r1 is not null and blocks_r2 is not null").groupBy("sample_id").agg(F.count("*").alias("pairs"), F.sum("score").alias("score")),
        fragment_sql("SELECT sample_id, count(*) AS pairs, sum(score) AS score FROM pr GROUP BY 1", PAIRS, "place = 1")),
    "p18_polya_clip": (lambda s, d: v_aln(s, d).selectExpr("sample_id", "concat(repeat('C', 20), repeat('A', cast(st % 12 as int))) as seq", "transform(sequence(1, 20 + cast(st % 12 as int)), x -> 30) as q", "concat('20M', cast(st % 12 as string), 'S') as cigar").groupBy("sample_id", A.polya_clip(F.col("seq"), F.col("q"), F.col("cigar"), F.lit(False)).alias("pas")).agg(F.count("*").alias("n")),
        sql("SELECT sample_id, st % 12 >= 8 AS pas, count(*) AS n FROM v_aln GROUP BY 1, 2", "v_aln")),
    "p19_internal_priming": (lambda s, d: L.internal_priming(v_aln(s, d).select("chrom", F.expr("st % 4000").alias("pos"), A.flag(F.col("flag"), A.REVERSE).alias("is_reverse")).distinct(), tracts(s, d)).groupBy("chrom", "is_reverse", "priming").agg(F.count("*").alias("n")),
        sql(f"""u AS (SELECT DISTINCT chrom, st % 4000 AS pos, {bit(16)} AS is_reverse FROM v_aln), w AS (SELECT *, CASE WHEN is_reverse THEN greatest(pos - 20, 0) ELSE pos END AS low, CASE WHEN is_reverse THEN pos ELSE pos + 20 END AS high FROM u),
        a AS (SELECT *, greatest(0, least(high, 1000) - low) AS adenines, greatest(0, least(high, 3000) - greatest(low, 2000)) AS thymines, least(high, 4000) - low AS bases FROM w)
        SELECT chrom, is_reverse, bases > 0 AND greatest(adenines, thymines) * 10 >= bases * 8 AS priming, count(*) AS n FROM a GROUP BY 1, 2, 3""", "v_aln")),
    "p29_alignments_to_reads": (lambda s, d: L.alignments_to_reads(v_pe(s, d).withColumn("seq", F.translate(F.substring(F.md5("qname"), 1, 12), "0123456789abcdef", "ACGTACGTACGTACGT")).withColumn("qual", F.substring(F.md5("qname"), 13, 12))),
        sql(f"""p AS (SELECT *, {bit(128)} AS two, translate(substr(md5(qname), 1, 12), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, substr(md5(qname), 13, 12) AS qual FROM v_pe WHERE {PRIMARY}), b AS (SELECT sample_id, qname FROM p GROUP BY 1, 2 HAVING count(DISTINCT two) = 2)
        SELECT sample_id, qname AS read_id, CAST(CASE WHEN two THEN 2 ELSE 1 END AS INTEGER) AS mate, CASE WHEN {bit(16)} THEN translate(reverse(seq), 'ACGT', 'TGCA') ELSE seq END AS seq, CASE WHEN {bit(16)} THEN reverse(qual) ELSE qual END AS qual FROM p SEMI JOIN b USING (sample_id, qname)""", "v_pe")),
    "e1_positional_em": (lambda s, d: E.positional_em(
            E.placed_blocks(fragments(s, d)), I.coverage(v_aln(s, d).select("sample_id", "chrom", F.inline(A.alignment_blocks(F.col("st"), F.col("cigar")))), ["sample_id", "chrom"]), width=64
        ).select("sample_id", "chrom", "qname", "score", F.round("fraction", 6).alias("fraction")), sql(PLACE_EM, "v_aln").replace("WITH ", "WITH RECURSIVE ", 1)),
    "e2_gene_em": (lambda s, d: E.gene_em(ambiguous(s, d), em_counts(s, d), 250.0)[0].select("gene_id", F.round("em_count", 3).alias("em_count")), GENE_EM),
    "e3_resolve_multi": (lambda s, d: E.resolve_multi(sets(s, d, marked(fragments(s, d)).withColumn("fraction", 1 / (1 + F.col("score"))), ["fraction", "spliced", "pas"]))[0].select("gene_id", *[F.round(c, 6).alias(c) for c in ("count", "splice", "pas")]),
        fragment_sql("SELECT gene_id, round(sum(1 / (1 + score)), 6) AS count, round(sum(CASE WHEN score % 2 = 0 THEN 1 / (1 + score) ELSE 0 END), 6) AS splice, round(sum(CASE WHEN score % 3 = 0 THEN 1 / (1 + score) ELSE 0 END), 6) AS pas FROM gs JOIN f USING (frag) WHERE genes = 1 GROUP BY 1")),
    "e4_quantify": (lambda s, d: quantified(s, d).select("gene_id", "length", "counts_uniq", *[F.round(c, 3).alias(c) for c in ("tpm_uniq", "counts_multi", "counts_total", "tpm", "counts_splice", "counts_pas")]),
        quantified_sql("SELECT gene_id, length, uniq AS counts_uniq, round(tpm_uniq, 3) AS tpm_uniq, round(multi, 3) AS counts_multi, round(total, 3) AS counts_total, round(tpm, 3) AS tpm, 0.0::DOUBLE AS counts_splice, round(pas, 3) AS counts_pas FROM q WHERE total > 0 OR pas > 0")),
    "e4_unique_tracks": (lambda s, d: E.quantification_tracks(*E.placed_fragments(tailed(s, d), exons(s, d), mode="primary", marks=False)).select("part", "bucket", "chrom", "s", "e", F.round("value", 6).alias("value")),
        fragment_sql("""SELECT 'unique' AS part, bucket, chrom, s, e, CAST(value AS DOUBLE) AS value FROM (SELECT bucket, chrom, pos AS s, lead(pos) OVER (PARTITION BY bucket, chrom ORDER BY pos) AS e, sum(d) OVER (PARTITION BY bucket, chrom ORDER BY pos) AS value FROM (
        SELECT bucket, chrom, pos, sum(d) AS d FROM (SELECT bucket, chrom, unnest([s, e]) AS pos, unnest([1.0, -1.0]) AS d FROM (
          SELECT frag, chrom, CASE WHEN rev1 THEN 'F2R1' ELSE 'F1R2' END AS bucket, unnest([s1, s1 + a1 + g1]) AS s, unnest([s1 + a1, s1 + a1 + g1 + b1]) AS e FROM f WHERE s1 IS NOT NULL AND loci = 1 AND u UNION ALL
          SELECT frag, chrom, CASE WHEN rev2 THEN 'F1R2' ELSE 'F2R1' END, unnest([s2, s2 + a2 + g2]), unnest([s2 + a2, s2 + a2 + g2 + b2]) FROM f WHERE s2 IS NOT NULL AND loci = 1 AND u)) GROUP BY 1, 2, 3)) WHERE value > 1e-9 AND e IS NOT NULL""", FRAGMENTS, "place = 1")),
    "e4_multi_tracks": (lambda s, d: E.quantification_tracks(*E.placed_fragments(tailed(s, d), exons(s, d), marks=False)).where("part = 'multi'").select("part", "bucket", "chrom", "s", "e", F.round("value", 5).alias("value")),
        quantified_sql("""SELECT 'multi' AS part, bucket, chrom, s, e, round(value, 5) AS value FROM (SELECT bucket, chrom, pos AS s, lead(pos) OVER (PARTITION BY bucket, chrom ORDER BY pos) AS e, sum(d) OVER (PARTITION BY bucket, chrom ORDER BY pos) AS value FROM (
        SELECT bucket, chrom, pos, sum(d) AS d FROM (SELECT bucket, chrom, unnest([s, e]) AS pos, unnest([p, -p]) AS d FROM (
          SELECT p, chrom, CASE WHEN rev1 THEN 'F2R1' ELSE 'F1R2' END AS bucket, unnest([s1, s1 + a1 + g1]) AS s, unnest([s1 + a1, s1 + a1 + g1 + b1]) AS e FROM fm JOIN fp USING (frag) WHERE s1 IS NOT NULL AND NOT fm.alone UNION ALL
          SELECT p, chrom, CASE WHEN rev2 THEN 'F1R2' ELSE 'F2R1' END, unnest([s2, s2 + a2 + g2]), unnest([s2 + a2, s2 + a2 + g2 + b2]) FROM fm JOIN fp USING (frag) WHERE s2 IS NOT NULL AND NOT fm.alone)) GROUP BY 1, 2, 3)) WHERE value > 1e-9 AND e IS NOT NULL""")),
    "e4_quantify_unique": (lambda s, d: quantified(s, d, mode="unique", genes="unique").select("gene_id", "counts_uniq", "counts_splice", "counts_pas", F.round("tpm", 3).alias("tpm")),
        fragment_sql("""SELECT gene_id, CAST(count(*) AS DOUBLE) AS counts_uniq, 0.0::DOUBLE AS counts_splice, CAST(count(*) FILTER (coalesce(g1 % 30 = 0, false) OR coalesce(g2 % 30 = 0, false)) AS DOUBLE) AS counts_pas, round(count(*) * 1e6 / sum(count(*)) OVER (), 3) AS tpm FROM gs JOIN f USING (frag)
        WHERE genes = 1 AND loci = 1 AND u AND NOT EXISTS (SELECT 1 FROM f g WHERE g.sample_id = f.sample_id AND g.qname = f.qname AND NOT g.u) GROUP BY 1""", every="place = 1")),
    "a37_quant_summary": (lambda s, d: summarised(*quantified(s, d, beside=True)),
        quantified_sql("SELECT (SELECT count(DISTINCT qname) FROM f) AS read_groups, (SELECT count(*) FROM gs WHERE genes > 1) AS ambiguous, count(*) FILTER (uniq > 0) AS genes_unique, count(*) FILTER (multi > 0) AS genes_multi FROM q")),
}
