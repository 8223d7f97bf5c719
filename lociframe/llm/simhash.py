"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into so few segments (radius div 2, plus one) that two fingerprints within the radius agree
in one segment up to one bit. Each segment is indexed once for every bit of it left out, so such a pair shares a
signature; signatures are joined by equality and the distance is verified. Distinct fingerprints (or texts) only take
part, so copies cost nothing. Under a signature that more than HOT of them share, all are compared with a few of them
first, and further pairs are made only between the groups that this leaves: pairs within a group would add nothing to
what is connected.

Texts are linked by their shingles in the end: the pairs that fingerprints propose are verified, and pairs beyond the
radius come from an equality join over the least shingle hashes of each text, which misses none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .components import components
from .shared import dropped, fresh, numbering, small, text_key, without, written

#: Fingerprints (texts) under one signature (mark) beyond which all are compared with a few of them first.
HOT = 32
#: With so many of them each is compared first.
CENTRES = 8
#: Shingles are counted in one text of so many to tell the common ones, of which the commonest are sent to the tasks:
#: both only set an order, and leave the result as it is.
SAMPLE, COMMON = 16, 200_000
#: What a mark tells of its text: number of shingles, fingerprint, percent of odd shingles, and two bitmaps.
TEXT = ("n", "fp", "odd", "even", "rest")
#: Rounds in which the texts under a mark are compared with one of them.
ROUNDS = 2


def shingles(text: str, size: int) -> list[bytes]:
    """Word shingles with repeats, A-Z lower-cased, joined by a space; fewer words than `size` make one shingle."""
    words = text.encode("utf-8", "replace").lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[k:] for k in range(size)))))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes; 0 for none. As a signed 64-bit integer."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(0, dtype=np.int64) * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def hashed(pieces: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(p, 42) for p in pieces), np.uint64, len(pieces))


def fingerprints(docs: DataFrame, size: int = 3, distinct: bool = False, text: str = "text", name: str = "fp") -> DataFrame:
    """Adds the fingerprint over `size`-word shingles (`distinct`: each counts once) to every row; null counts as empty."""
    source = docs.select(*[F.col(f"`{c}`") for c in without(docs, [name])])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(batch.schema.get_field_index(text)):
                own = shingles(value.as_py() or "", size)
                out.append(fingerprint(hashed(list(set(own)) if distinct else own)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, name])

    return source.mapInArrow(add, T.StructType([*source.schema.fields, T.StructField(name, T.LongType())]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _segments(parts: int, bits: list[int]) -> list[list[int]]:
    return [bits[len(bits) * k // parts : len(bits) * (k + 1) // parts] for k in range(parts)]


def hamming_links(prints: DataFrame, radius: int, hot: int = HOT) -> DataFrame:
    """(a, b), a < b: pairs of nodes whose fingerprints (prints: node, fp) differ in at most `radius` bits (up to 62).

    All such pairs of up to `hot` nodes under a signature are there; of more, enough that everything that all pairs
    connect is connected.
    """
    parts = _segments(radius // 2 + 1, list(range(64)))
    masks, refined = [], []
    for part in parts:
        rest = [b for b in range(64) if b not in part]
        cuts = _segments(min(radius + 1, len(rest)), rest)
        for bit in part:
            masks.append(_signed(sum(1 << b for b in part if b != bit)))
            refined.append([_signed(sum(1 << b for b in cut)) for cut in cuts])
    of = lambda values, k: F.element_at(F.array(*[F.lit(v) for v in values]), k)
    whole = [_signed(sum(1 << b for b in part)) for part in parts]
    own_part = [_signed(sum(1 << b for b in part)) for part in parts for _ in part]

    def close(a: str, b: str) -> Column:
        """Within the radius, and not under an earlier signature as well, so that a pair is made once."""
        x = F.col(a).bitwiseXOR(F.col(b))
        out = F.bit_count(x) <= radius
        for part, mask in list(zip(parts, whole))[:-1]:
            out &= (F.col("k") <= part[-1] + 1) | (F.bit_count(x.bitwiseAND(mask)) > 1)
        return out & (F.col("k").isin(*[part[0] + 1 for part in parts]) | (x.bitwiseAND(of(own_part, F.col("k"))) != 0))

    signed = prints.select("node", "fp").distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(64))))
    signed = signed.select("k", F.col("fp").bitwiseAND(of(masks, F.col("k"))).alias("v"), "fp", "node")
    counted = signed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k", "v")
    shared = written(signed.join(counted, ["k", "v"], "left_semi"), "signatures")
    crowded = written(shared.groupBy("k", "v").count().where(F.col("count") > hot).select("k", "v"), "signatures")
    few = shared.join(crowded, ["k", "v"], "left_anti")
    one = few.select("k", "v", F.col("node").alias("a"), F.col("fp").alias("fa"))
    two = few.select("k", "v", F.col("node").alias("b"), F.col("fp").alias("fb"))
    plain = one.join(two, ["k", "v"]).where((F.col("a") < F.col("b")) & close("fa", "fb")).select("a", "b")
    if crowded.isEmpty():
        links = written(plain.distinct(), "links")
    else:
        busy = written(shared.join(crowded, ["k", "v"], "left_semi"), "signatures")
        # the first by several hashes: mostly the same few nodes under all signatures of a large group
        firsts = [F.min_by(F.struct("node", "fp"), F.xxhash64("node", F.lit(k))) for k in range(CENTRES)]
        first = busy.groupBy("k", "v").agg(F.array_distinct(F.array(*firsts)).alias("c")).select("k", "v", F.explode("c").alias("c"))
        first = first.select("k", "v", F.col("c.node").alias("a"), F.col("c.fp").alias("fa"))
        stars = busy.join(first, ["k", "v"]).where((F.col("a") != F.col("node")) & close("fa", "fp"))
        stars = written(stars.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "links")
        groups = components(stars).withColumnRenamed("node", "member")
        tagged = busy.join(groups, busy.node == groups.member, "left").select("k", "v", "fp", "node", F.coalesce("component", "node").alias("g"))
        tagged = written(tagged, "signatures")
        largest = tagged.groupBy("k", "v", "g").count().groupBy("k", "v").agg(F.max_by("g", F.struct("count", "g")).alias("top"))
        rest = tagged.join(largest, ["k", "v"]).where(F.col("g") != F.col("top")).drop("top")
        cut_masks = F.element_at(F.array(*[F.array(*[F.lit(m) for m in cuts]) for cuts in refined]), F.col("k"))

        def cut(df: DataFrame, node: str, fp: str, group: str) -> DataFrame:
            own = df.select("k", "v", F.posexplode(cut_masks).alias("p", "mask"), "fp", "node", "g")
            return own.select("k", "v", "p", F.col("fp").bitwiseAND(F.col("mask")).alias("w"), F.col("node").alias(node), F.col("fp").alias(fp), F.col("g").alias(group))

        across = cut(tagged, "x", "fx", "gx").join(cut(rest, "y", "fy", "gy"), ["k", "v", "p", "w"]).where((F.col("gx") != F.col("gy")) & close("fx", "fy"))
        across = across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = written(plain.unionByName(stars).unionByName(across).distinct(), "links")
        for done in (busy, stars, tagged):
            dropped(done)
    dropped(shared)
    dropped(crowded)
    return links


def fingerprint_groups(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id that links reach) for every row of `docs`.

    Fingerprints over `size`-word shingles with repeats link at `radius` or fewer differing bits. Null and empty texts
    have fingerprint zero and link like any other; a text is read whole, one at a time, however long; repeated rows are alike; an
    empty table gives no rows and other columns are left out, whatever their names; a row without doc_id gets the component of its fingerprint, which
    is null only if no row of it has a doc_id.
    """
    own = written(fingerprints(docs.select("doc_id", "text"), size).select("doc_id", "fp"), "fingerprints")
    prints = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(hamming_links(prints.select(F.col("fp").alias("node"), "fp"), radius))
    rooted = prints.join(roots, prints.fp == roots.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id")
    return own.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def text_numbers(docs: DataFrame) -> Callable[[DataFrame, str], DataFrame]:
    """A function that numbers texts; null counts as empty."""
    return numbering(docs, text_key(F.coalesce("text", F.lit(""))))


def text_groups(docs: DataFrame, numbered: Callable[[DataFrame, str], DataFrame], shingle: int = 5, similarity: float = 0.8, radius: int = 3, hot: int = HOT) -> DataFrame:
    """(key, root): the group of every distinct text that is not alone; `key` is its number (`text_numbers`).

    Two texts are linked if the Jaccard similarity of their sets of `shingle`-word shingles is at least `similarity`; links
    are verified exactly. Texts whose fingerprints over their distinct words differ in at most `radius` bits are compared
    first, by deletion-variant signatures; single words serve the fingerprint because one changed word changes one of them
    but five shingles. Signatures are long (two segments for a radius of 3), so they stay selective as the corpus grows.
    A task holds the shingles of one text at a time, however long it is; null and empty texts are one text without shingles, and
    repeated texts are one. Cut and extended texts lie further apart: an equality join over the least shingles of each text has every pair that
    the first links leave apart.
    """
    keyed = numbered(docs.select("text"), "key")
    keyed = keyed.select("key", "text")
    texts = written(prepared(keyed, shingle, similarity, common_shingles(keyed, shingle)), "shingles")
    close = settled(shared(texts.select("key", F.explode(signatures(F.col("fp"), radius)).alias("b")), texts), None, keyed, shingle, similarity, radius, hot)
    near = settled(shared(texts.select("key", F.explode("least").alias("b")), texts), close, keyed, shingle, similarity, hot=hot)
    dropped(texts)
    if near is None:
        return keyed.sparkSession.createDataFrame([], "key long, root long")
    return near.select(F.col("node").alias("key"), F.col("component").alias("root"))


def signatures(fp: Column, radius: int) -> Column:
    """One value for every bit of the fingerprint: the segment that holds it, without the bit."""
    parts = _segments(radius // 2 + 1, list(range(64)))
    return F.array(*[F.xxhash64(F.lit(bit), fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in part if b != bit))))) for part in parts for bit in part])


def common_shingles(keyed: DataFrame, shingle: int) -> np.ndarray:
    """Hashes, sorted, of shingles that many texts of a sample share. Any set of them serves the order of `prepared`."""
    sample = _shingle_sets(keyed.where(F.pmod("key", F.lit(SAMPLE)) == 0), shingle).dropDuplicates(["key"])
    counts = sample.select(F.explode("shingles").alias("h")).groupBy("h").count().where(F.col("count") >= 2)
    top = counts.orderBy(F.col("count").desc(), "h").limit(COMMON).select("h").toPandas()
    return np.sort(top["h"].to_numpy(np.int64).view(np.uint64))


def prepared(keyed: DataFrame, shingle: int, similarity: float, common: np.ndarray) -> DataFrame:
    """(key, n, fp, odd, even, rest, least) of every distinct text: number of distinct shingles, fingerprint over the distinct
    words, percent of shingles that are not common, two bitmaps, and so many of the first shingles, in the order of their
    hashes with the common ones last, that two texts of the similarity share one of them at least.

    A bit of the bitmaps is set if an odd number of shingles has its number in the last 7 bits of the hash; so two texts
    differ in as many shingles as their bitmaps differ in bits, or more."""
    broadcast = keyed.sparkSession.sparkContext.broadcast(common)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = broadcast.value
        for batch in batches:
            sizes, prints, odd, maps, out = [], [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                own = np.unique(hashed(shingles(text, shingle)))
                last = np.zeros(len(own), bool)
                if len(often):
                    last = often[np.minimum(np.searchsorted(often, own), len(often) - 1)] == own
                    own = np.concatenate([own[~last], own[last]])
                sizes.append(len(own))
                odd.append(100 - 100 * int(last.sum()) // max(1, len(own)))
                maps.append(np.packbits((np.bincount((own & np.uint64(127)).astype(np.int64), minlength=128) & 1).astype(bool)).view(np.int64))
                prints.append(fingerprint(hashed(list(set(shingles(text, 1))))))
                out.append(own[: _prefix(len(own), similarity)].view(np.int64))
            arrays = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()), pa.array(odd, pa.int32()), *(pa.array([m[k] for m in maps], pa.int64()) for k in (0, 1)), pa.array(out, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", *TEXT, "least"])

    return keyed.mapInArrow(first, "key long, n int, fp long, odd int, even long, rest long, least array<long>").dropDuplicates(["key"])


def _prefix(n: int, similarity: float) -> int:
    return n - math.ceil(n * similarity - 1e-9) + 1


def shared(marks: DataFrame, texts: DataFrame) -> DataFrame:
    """The marks (b, key) whose bucket b holds another text as well, with TEXT of their texts. Counts are aggregated before
    the shuffle, and the join is one that adaptive execution splits, so a bucket of very many texts is no task of its own."""
    more = marks.groupBy("b").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("b")
    return written(marks.join(more, "b", "left_semi").join(texts.select("key", *TEXT), "key"), "marks")


def settled(marks: DataFrame, groups: DataFrame | None, keyed: DataFrame, shingle: int, similarity: float, radius: int | None = None, hot: int = HOT, rounds: int = ROUNDS) -> DataFrame | None:
    """(node, component): the groups that all verified pairs of texts under one mark make, with the given ones; None for none.

    A text is compared only with texts that are not in its group yet. Under a mark that more than `hot` texts outside its
    largest group bear, all are compared with one of them first: the one with the least share of odd shingles, as an
    original has among its edited copies, then by a hash of the round. That is mostly the same text under all marks of a
    large group, so that a group of copies is settled by about as many comparisons as it has texts. After `rounds` such rounds at most, all pairs of different groups under a mark are compared. With a `radius`, marks are
    signatures and only pairs of fingerprints within it are compared; else marks are the least shingles, and a pair is
    compared only if it shares so many of them that the other shingles can make up the rest.
    """

    def state() -> DataFrame:
        """b, x (the text: TEXT and key), g (group), c (the text to compare with, and its group), top (the largest group),
        crowded; marks of one group are out."""
        own = marks.select("b", F.struct("key", *TEXT).alias("x"), F.col("key").alias("g"))
        if groups is not None:
            own = marks.join(groups.withColumnRenamed("node", "key"), "key", "left").select("b", F.struct("key", *TEXT).alias("x"), F.coalesce("component", "key").alias("g"))
        order = F.struct((F.col("x.odd") / (4 << 2 * k)).cast("int").alias("odd"), F.xxhash64("x.key", F.lit(k)).alias("hash"))
        parts = own.groupBy("b", "g").agg(F.count(F.lit(1)).alias("of"), F.min_by(F.struct("x", "g"), order).alias("c"), F.min(order).alias("o"))
        whole = parts.groupBy("b").agg(
            F.max_by("g", F.struct("of", "g")).alias("top"), (F.sum("of") - F.max("of") > hot).alias("crowded"), F.min_by("c", "o").alias("c"), F.count(F.lit(1)).alias("groups")
        )
        whole = whole.where("groups > 1").select("b", "top", "crowded", F.when(F.col("crowded"), F.col("c")).alias("c"))
        return written(own.join(whole, "b"), "marks")

    def fits(x: str, y: str) -> Column:
        """Whether sizes, bitmaps and, with a radius, fingerprints let two texts be similar enough."""
        n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
        apart = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in ("even", "rest")), F.lit(0))
        out = (n >= m * similarity - 1e-9) & (m >= n * similarity - 1e-9) & (apart <= (n + m) * (1 - similarity) / (1 + similarity) + 1e-9)
        return out & (F.bit_count(F.col(f"{x}.fp").bitwiseXOR(F.col(f"{y}.fp"))) <= radius) if radius is not None else out

    def joined(sure: DataFrame) -> DataFrame | None:
        """The groups with further links."""
        if sure.isEmpty():
            return groups
        return components(sure if groups is None else sure.unionByName(groups.select(F.col("component").alias("a"), F.col("node").alias("b"))))

    k = 0
    now = state()
    while k < rounds:
        pairs = now.where(F.col("crowded") & (F.col("g") != F.col("c.g")) & fits("x", "c.x"))
        pairs = written(pairs.select(F.least("x.key", "c.x.key").alias("a"), F.greatest("x.key", "c.x.key").alias("b")).distinct(), "pairs")
        tried = pairs.count()
        sure = alike(keyed, pairs, shingle, similarity) if tried else None
        dropped(pairs)
        if sure is None or sure.isEmpty():
            break
        groups = joined(sure)
        dropped(now)
        k = k + 1 if sure.count() * 10 > tried else rounds  # mostly in vain: what is left is not one group
        now = state()
    one = now.where("g <> top").select("b", "x", "g")
    two = now.select("b", F.col("x").alias("y"), F.col("g").alias("h"), (F.col("g") == F.col("top")).alias("most"))
    met = one.join(two, "b").where((F.col("g") != F.col("h")) & fits("x", "y") & (F.col("most") | (F.col("x.key") < F.col("y.key"))))
    ends = [F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")]
    met = met.groupBy(*ends).agg(F.count(F.lit(1)).alias("shared"), F.max(F.greatest("x.n", "y.n")).alias("big"), F.max(F.least("x.n", "y.n")).alias("small"))
    if radius is None:  # of the texts' shingles they share at most so many of the least ones, and of the others what the larger has
        most = F.col("shared") + F.ceil(F.col("big") * similarity - 1e-9) - 1
        met = met.where(most >= similarity / (1 + similarity) * (F.col("big") + F.col("small")) - 1e-9)
    found = written(met.select("a", "b"), "pairs")
    groups = joined(alike(keyed, found, shingle, similarity))
    for done in (now, found, marks):
        dropped(done)
    return groups


def _shingle_sets(keyed: DataFrame, shingle: int) -> DataFrame:
    """(key, shingles): the distinct shingle hashes of every text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(hashed(shingles(v.as_py() or "", shingle))).view(np.int64) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int64()))], ["key", "shingles"])

    return keyed.mapInArrow(sets, "key long, shingles array<long>")


def alike(keyed: DataFrame, pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b: text keys) whose sets of shingles have at least the Jaccard similarity; keyed: key, text."""
    wanted = written(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct(), "keys")
    found = _shingle_sets(keyed.join(small(wanted), "key", "left_semi").dropDuplicates(["key"]), shingle)
    found = written(found, "shingles")
    both = pairs.join(found.select(F.col("key").alias("a"), F.col("shingles").alias("p")), "a").join(found.select(F.col("key").alias("b"), F.col("shingles").alias("q")), "b")
    common = F.size(F.array_intersect("p", "q"))
    sure = written(both.where(common >= similarity * (F.size("p") + F.size("q") - common)).select("a", "b"), "links")
    dropped(found)
    dropped(wanted)
    return sure


def deduplicated(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = 3) -> DataFrame:
    """`docs` with one row of each group of exact or near copies: that of the least doc_id (null last).

    A null text counts as empty, so of all null and empty texts one row stays; repeated rows are copies of each other.
    Spark cuts the ranks to the first row of a group in every task before the shuffle, so a group of copies that a third of
    all rows belong to arrives as one row a task.
    """
    key, group, nth = fresh(docs, "key", "group", "nth")
    numbered = text_numbers(docs)
    groups = text_groups(docs, numbered, shingle, similarity, radius)
    keyed = numbered(docs, key)
    joined = keyed.join(groups.select(F.col("key").alias(key), F.col("root").alias(group)), key, "left").withColumn(group, F.coalesce(group, key))
    first = Window.partitionBy(group).orderBy(F.col("doc_id").asc_nulls_last(), key)
    return joined.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
