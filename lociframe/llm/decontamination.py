"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

DataFrame functions only. Texts and items are lower-cased and cut into words of letters and digits; shingles are SHINGLE
words (an item of fewer words is one shingle). A document holds an item if a window of as many words has a weighted
shingle similarity (sum of least counts by sum of greatest counts) of at least the threshold; a document of fewer words
than the item is one window.

Only windows that hold enough of the shingles of some item of their size can reach it, so fingerprints are taken of
these windows. Fingerprints are cut into SEGMENTS blocks; two within the radius agree in one of them up to a few bits, so
an equality join of the windows' blocks with all values that near to an item's finds all of them, and candidates are
verified on their shingles. At the threshold two fingerprints differ in 10 bits on average and hardly ever in more than
RADIUS.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import dropped, fresh, numbering, small, text_key, written

SHINGLE, SIMILARITY, RADIUS, SEGMENTS = 5, 0.8, 19, 5
#: Counters of three bits share a 63-bit integer, 21 bits each.
LANES, LANE_BITS = 22, 21


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def shingle_hashes(words: Column, size: int) -> Column:
    """Hashes of the `size`-word shingles in order; none if there are fewer words."""
    places = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(size)]))


def fingerprint(counts: list[Column], n: Column) -> Column:
    """From the lane sums: a bit is set if it is set in over half of the shingles."""
    out = F.lit(0).cast("long")
    for b in range(64):
        count = F.shiftright(counts[b % LANES], b // LANES * LANE_BITS).bitwiseAND((1 << LANE_BITS) - 1)
        out = out.bitwiseOR(F.when(count * 2 > n, F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def with_fingerprints(windows: DataFrame, keys: list[str], hashes: str) -> DataFrame:
    """(keys, fp) of the shingle hashes in an array column."""
    h = F.col("h")
    one = lambda b: F.shiftright(h, b).bitwiseAND(1)
    lanes = []
    for k in range(LANES):
        parts = [F.shiftleft(one(b), b // LANES * LANE_BITS) for b in range(k, 64, LANES)]
        lanes.append(sum(parts[1:], parts[0]))
    sums = windows.select(*keys, F.explode(hashes).alias("h")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"c{k}") for k, x in enumerate(lanes)])
    return sums.select(*keys, fingerprint([F.col(f"c{k}") for k in range(LANES)], F.col("n")).alias("fp"))


def blocks(fp: str) -> Column:
    """(block, value): the SEGMENTS parts of a fingerprint."""
    cuts = [64 * k // SEGMENTS for k in range(SEGMENTS + 1)]
    parts = [F.shiftrightunsigned(fp, a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:])]
    return F.posexplode(F.array(*parts)).alias("block", "value")


def near_blocks(items: DataFrame, fp: str, radius: int) -> DataFrame:
    """`items` once for every block and every value of it that differs in radius div SEGMENTS bits at most. Two fingerprints within
    the radius agree that far in one block at least, so an equality join with plain blocks finds all of them."""
    wide = -(-64 // SEGMENTS)
    masks = [sum(1 << b for b in bits) for n in range(radius // SEGMENTS + 1) for bits in combinations(range(wide), n)]
    limit = F.element_at(F.array(*[F.lit(1 << (64 * (k + 1) // SEGMENTS - 64 * k // SEGMENTS)) for k in range(SEGMENTS)]), F.col("block") + 1)
    every = items.select("*", blocks(fp)).withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks]).cast("array<bigint>")))
    every = every.where(F.col("mask") < limit)
    return every.withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")


def similarity(a: str, b: str) -> Column:
    """Sum of the least by sum of the greatest counts of two arrays of hashes."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    least = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(count(a, x), count(b, x)))
    common = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(least)
    return common / (F.size(a) + F.size(b) - common)


def held_items(docs: DataFrame, items: DataFrame, numbered: Callable[[DataFrame, str], DataFrame], threshold: float = SIMILARITY, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """(key, item_id, start, similarity): the best window (then the first) of every text that holds an item.

    `key` is the number of the text (`numbering`); `start` counts words from 0. Items without words, and null texts, hold nothing; repeated items
    are found each under its id.
    """
    asked = items.where(F.col("text").isNotNull()).select("item_id", words_of(F.col("text")).alias("w")).withColumn("m", F.size("w")).where("m > 0")
    long_ = asked.where(F.col("m") >= size).select("item_id", "m", shingle_hashes(F.col("w"), size).alias("q"), F.lit(size).alias("size"))
    short = asked.where(F.col("m") < size).select("item_id", "m", F.array(F.xxhash64(F.concat_ws(" ", "w"))).alias("q"), F.lit(0).alias("size"))
    # a short item is one shingle of all its words; texts show it as a stretch of as many
    tables: list[DataFrame] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        tables.append(written(df, name))
        return tables[-1]

    asked = kept(long_.unionByName(short).withColumn("n", F.size("q")), "items")
    marks = small(kept(asked.select(F.explode("q").alias("h"), "m", "size").distinct(), "marks"))
    lengths = [r[0] for r in asked.where("size = 0").select("m").distinct().collect()]  # at most size - 1 values

    def hashes(texts: DataFrame) -> DataFrame:
        own = numbered(texts.where(F.col("text").isNotNull()), "key").select("key", words_of(F.col("text")).alias("w"))
        out = own.select("key", F.lit(size).alias("size"), shingle_hashes(F.col("w"), size).alias("hs"))
        for m in lengths:
            joined = F.transform(
                F.when(F.size("w") >= m, F.sequence(F.lit(1), F.size("w") - m + 1)).otherwise(F.array().cast("array<int>")),
                lambda i: F.xxhash64(F.concat_ws(" ", F.slice("w", i, m))),
            )
            out = out.unionByName(own.select("key", F.lit(-m).alias("size"), joined.alias("hs")))
        return out

    side = lambda: F.when(F.col("size") > 0, F.col("size")).otherwise(-F.col("m"))
    places = hashes(docs.select("text")).select("key", "size", F.size("hs").alias("all"), F.posexplode_outer("hs").alias("at", "h"))  # an inner one would have its filter pushed into the lambdas
    hits = places.join(marks.select("h", "m", side().alias("size")), ["h", "size"]).select("key", "size", "all", "m", "at").distinct()
    of_item = F.when(F.col("size") > 0, F.col("m") - F.col("size") + 1).otherwise(F.lit(1))
    need = F.greatest(F.lit(1), F.ceil((of_item + F.col("n")) * threshold / (1 + threshold) - 1e-9).cast("int"))
    gathered = hits.groupBy("key", "size", "all", "m").agg(F.sort_array(F.collect_list("at")).alias("ats"))
    gathered = gathered.withColumn("n", F.least(of_item, F.col("all"))).withColumn("need", need)  # a text of fewer shingles is one window
    gathered = gathered.where(F.size("ats") >= F.col("need"))
    starts = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size("ats") - F.col("need") + 1),
            lambda i: F.when(
                F.element_at("ats", i + F.col("need") - 1) - F.element_at("ats", i) < F.col("n"),
                F.sequence(F.greatest(F.element_at("ats", i + F.col("need") - 1) - F.col("n") + 1, F.lit(0)), F.element_at("ats", i)),
            ).otherwise(F.array().cast("array<int>")),
        )
    )
    windows = kept(gathered.select("key", "size", "m", "n", F.explode_outer(F.array_distinct(starts)).alias("start")).where("start is not null"), "windows")
    keys = small(kept(windows.select("key").distinct(), "keys"))
    texts = numbered(docs.select("text"), "key").join(keys, "key", "left_semi").select("text")
    found = hashes(texts).dropDuplicates(["key", "size"])
    slices = windows.join(found, ["key", "size"]).where(F.col("start") + F.col("n") <= F.size("hs"))
    slices = kept(slices.select("key", "size", "m", "start", F.slice("hs", F.col("start") + 1, F.col("n")).alias("p")), "windows")
    of_window = with_fingerprints(slices, ["key", "size", "m", "start"], "p").select("*", blocks("fp"))
    of_item = near_blocks(with_fingerprints(asked.withColumn("size", side()), ["item_id", "size", "m"], "q").withColumnRenamed("fp", "item_fp"), "item_fp", radius)
    near = of_window.join(of_item, ["size", "m", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    near = near.select("key", "size", "m", "start", "item_id").distinct()
    both = near.join(slices, ["key", "size", "m", "start"]).join(asked.select("item_id", "m", "q"), ["item_id", "m"])
    sure = both.select("key", "item_id", "start", similarity("p", "q").alias("similarity")).where(F.col("similarity") >= threshold)
    best = F.max_by(F.struct("start", "similarity"), F.struct("similarity", -F.col("start"))).alias("best")
    held = written(sure.groupBy("key", "item_id").agg(best).select("key", "item_id", "best.start", "best.similarity"), "held")
    for done in tables:
        dropped(done)
    return held


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, start, similarity for every document row and item that it holds.

    Repeated rows hold the same items each; texts of any length are cut into all their windows; null texts hold none; an empty
    table of either kind gives none. Other columns are left out, whatever their names."""
    numbered = numbering(docs, text_key(F.col("text")))
    held = held_items(docs, items, numbered, threshold, radius)
    own = numbered(docs.select("doc_id", "text"), "key").select("doc_id", "key")
    return own.join(held, "key").select("doc_id", "item_id", "start", F.round("similarity", 6).alias("similarity"))


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` that hold no item; null and empty texts stay."""
    (key,) = fresh(docs, "key")
    numbered = numbering(docs, text_key(F.col("text")))
    held = small(written(held_items(docs, items, numbered, threshold, radius).select(F.col("key").alias(key)).distinct(), "held"))
    return numbered(docs, key).join(held, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
