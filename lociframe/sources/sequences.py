"""FASTQ and FASTA files. Plain files are read split by split: no file is one task's work, and no line is looked at in Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: A split of a file: its lines are read in order by one task.
SPLIT = ["file", "block"]


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, block (where the split begins), id (ascending inside a split, without gaps), value."""
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.text(paths).select(*where, F.monotonically_increasing_id().alias("id"), "value")


def _before(name: str, column: str) -> Column:
    """Running total of a column over the splits of a file, without the own one: a row a split."""
    return F.coalesce(F.sum(column).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(name)


def read_fastq(spark: SparkSession, paths: str | list[str], sample_id: str, mate: int) -> DataFrame:
    """sample_id, mate, read_id (with its @), seq, qual: records of four lines, gz by suffix; an unfinished record at the end
    of a file is left out.

    Lines are counted by split first, so that every line knows its number in its file; the lines of a record then meet by
    that number. A gz file is one split by its nature. Land the result as Parquet once.
    """
    lines = _lines(spark, paths)
    splits = lines.groupBy(*SPLIT).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("lines"))
    splits = splits.select(*SPLIT, "first", _before("begin", "lines"))
    numbered = lines.join(splits, SPLIT).withColumn("n", F.col("begin") + F.col("id") - F.col("first"))
    part = lambda k: F.max(F.when(F.col("n") % 4 == k, F.col("value")))
    records = numbered.groupBy("file", F.floor(F.col("n") / 4).alias("record")).agg(part(0).alias("read_id"), part(1).alias("seq"), part(3).alias("qual"))
    return records.where("qual is not null").select(F.lit(sample_id).alias("sample_id"), F.lit(mate).alias("mate"), "read_id", "seq", "qual")


def read_fasta_tiles(spark: SparkSession, path: str | list[str], tile: int = 1000) -> DataFrame:
    """chrom, tile, seq: the sequences in tiles of `tile` bases, the last one shorter.

    Bases are counted through a file: inside each split, and then over the splits, of which only totals and last headers
    are put in order. A sequence's bases begin where its header stands in that count.
    """
    head = F.regexp_extract("value", r"^>(\S+)", 1)
    lines = _lines(spark, path).withColumn("head", F.when(F.col("value").startswith(">"), head)).withColumn("value", F.when(F.col("head").isNull(), F.trim("value")).otherwise(""))
    order = Window.partitionBy(*SPLIT).orderBy("id")
    lines = lines.withColumn("at", F.coalesce(F.sum(F.length("value")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    lines = lines.withColumn("own", F.last(F.when(F.col("head").isNotNull(), F.struct(F.col("head").alias("chrom"), F.col("at"))), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    splits = lines.groupBy(*SPLIT).agg(F.sum(F.length("value")).alias("bases"), F.max_by("own", "id").alias("last"))
    splits = splits.select(*SPLIT, _before("begin", "bases"), "last")
    above = F.last(F.when(F.col("last").isNotNull(), F.struct(F.col("last.chrom").alias("chrom"), (F.col("begin") + F.col("last.at")).alias("at"))), ignorenulls=True)
    splits = splits.withColumn("open", above.over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).drop("last")
    placed = lines.where("value <> ''").join(splits, SPLIT)
    begin = F.when(F.col("own").isNotNull(), F.col("at") - F.col("own.at")).otherwise(F.col("begin") + F.col("at") - F.col("open.at"))
    placed = placed.select(F.coalesce("own.chrom", "open.chrom").alias("chrom"), "value", begin.alias("begin")).where("chrom is not null")
    cut = placed.withColumn("tile", F.explode(F.sequence(F.floor(F.col("begin") / tile), F.floor((F.col("begin") + F.length("value") - 1) / tile))))
    a = F.greatest(F.col("tile") * tile - F.col("begin"), F.lit(0))
    b = F.least((F.col("tile") + 1) * tile - F.col("begin"), F.length("value"))
    pieces = cut.select("chrom", "tile", "begin", F.substring("value", (a + 1).cast("int"), (b - a).cast("int")).alias("piece"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("begin", "piece"))), lambda x: x.piece), "")  # a tile's bases
    return pieces.groupBy("chrom", "tile").agg(joined.alias("seq"))
