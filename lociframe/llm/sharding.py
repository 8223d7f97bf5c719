"""Sharding by proportional stratified interleaving, so that every shard has the mixture of the whole.

Rows are shuffled by a seeded hash and ranked within their source; sorted by fractional rank, the sources interleave
evenly, and the sorted rows are cut into shards whose counts differ by one at most. No rank is taken over an unbounded
group: hash ranges (within a source) and fractional-rank ranges (over all) hold ROWS rows each on average, a range's
offset comes from the counts before it, and only rows of one range are ranked together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .shared import offsets, written

#: Rows of a range on average.
ROWS = 20_000
SEED = 20240601


def sharded(docs: DataFrame, shards: int = 40, seed: int = SEED, text: str = "text", source: str = "source", rows: int = ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law (`rows`), shard, slot, grown_shard (null) for every row of `docs`.

    size is the text's UTF-8 bytes (null: none) plus 16. Rows without a source form a stratum of their own. Repeated rows
    take places of their own; as they are alike, which of them takes which is not fixed. A null doc_id is hashed like any other;
    an empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    stratum = F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(source).cast("string")))
    # 60 bits of an MD5 digest, so that SQL can say the same
    hashed = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), body)), 1, 15), 16, 10).cast("long")
    base = written(
        docs.select(
            "doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
            stratum.alias("stratum"), hashed.alias("h"),
        ),
        "shards",
    )
    total = base.count()
    ranges = max(1, total // rows)
    # where a row falls among the ranges of equal width
    base = base.withColumn("part", (F.shiftright("h", 29) * F.lit(ranges) / F.lit(float(1 << 31))).cast("long"))
    counts = base.groupBy("stratum", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("stratum").agg(F.sum("n").alias("of"))
    within = Window.partitionBy("stratum", "part").orderBy("h", "doc_id", "text_crc32", "size")
    ranked = (
        base.withColumn("nth", F.row_number().over(within))
        .join(offsets(counts, ["stratum"], "part").drop("n"), ["stratum", "part"])
        .join(sizes, "stratum")
        .withColumn("rank", F.col("before") + F.col("nth"))
        .withColumn("fraction", (F.col("rank") - 0.5) / F.col("of"))
        .withColumn("part", F.least((F.col("fraction") * ranges).cast("long"), F.lit(ranges - 1)))
        .select("doc_id", "size", "text_crc32", "stratum", "rank", "fraction", "part")
    )
    ranked = written(ranked, "shards")
    starts = offsets(ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0)), ["all"], "part").select("part", "before")
    over = Window.partitionBy("part").orderBy("fraction", F.md5(F.concat(F.lit(f"{seed}:"), "stratum")), "stratum", "rank")
    place = F.col("before") + F.row_number().over(over) - 1
    shard = F.expr(f"place * {shards} div {max(1, total)}")
    return (
        ranked.join(starts, "part")
        .withColumn("place", place)
        .withColumn("shard", shard.cast("int"))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            (F.col("place") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
