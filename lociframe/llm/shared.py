"""Tables between jobs, and text columns, for the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: A word is a longest stretch without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor sees. One is made up only in local mode, where the driver's folder is everybody's."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.__dict__["folder"] = path
    return table


def dropped(df: DataFrame) -> None:
    """Deletes the folder of a table that `written` made."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.__dict__["folder"])
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of `df` has them (upper and lower case are one to Spark)."""
    own = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        return name if name.lower() not in own else free(name + "_")

    return [free(f"__{name}") for name in names]


#: Up to so many rows of a few bytes are sent to all tasks, after they are counted; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: Bytes of rows that Spark hands to a Python worker at once, and what it does if nobody says anything.
BATCH, BATCH_UNSET = "4m", "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Sets how many bytes of rows go to Python at once in this session, unless the user has set it. Rows of whole texts else come in
    batches of tens of MB, which the JVM holds once and the worker several times, beside what it makes of them."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == BATCH_UNSET:
        spark.conf.set(name, BATCH)


def text_key(text: Column) -> Column:
    """Identity of a text, null being one of its own: 128 bits, as 32 hex digits."""
    return F.when(text.isNull(), "-").otherwise(F.md5(text.cast("binary")))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identity of a document row: rows that are equal in id and text, nulls included, share its 128 bits and are treated alike."""
    name = F.col(doc_id).cast("string")
    return F.md5(F.concat(F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), name), F.lit("-")), text_key(F.col(text))).cast("binary"))


def numbering(df: DataFrame, identity: Column, narrow: Column | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """A function that adds a 64-bit number of the 128-bit identity to tables with the columns of `df`: different rows of `df` have
    different numbers.

    The number is a hash; it is counted first whether different identities share one, as a few do among 10 ** 10. These, and
    only these, get another hash, by a join with a table of that few. `narrow` stands for the first hash in tests."""
    spark, first = df.sparkSession, narrow if narrow is not None else F.xxhash64(identity)
    seen = df.select(identity.alias("id"), first.alias("n")).groupBy("n").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = written(seen.where("low <> high").select("n"), "numbers")
    none = shared.isEmpty()
    twice = [r[0] for r in shared.limit(1_000_000).collect()] if not none else []
    if len(twice) == 1_000_000:
        raise ValueError("numbers of 64 bits do not tell so many rows apart")

    def numbered(table: DataFrame, name: str) -> DataFrame:
        if none:
            return table.withColumn(name, first)
        (mark,) = fresh(table, "mark")
        few = F.broadcast(spark.createDataFrame([(n, True) for n in twice], f"{name} long, {mark} boolean"))
        again = F.when(F.col(mark), F.xxhash64(identity, F.lit(1))).otherwise(F.col(name))
        return table.withColumn(name, first).join(few, name, "left").withColumn(name, again).select(*table.columns, name)

    return numbered


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of `df` that have none of the names (upper and lower case are one to Spark)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


#: Ranges whose counts are summed together.
TOGETHER = 1000


def offsets(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds `before`, the sum of n of the rows of `by` with a lesser `order` (whole numbers, each once): first within TOGETHER of
    them, then over these, so that no window holds a row for each range."""
    own = counts.withColumn("__block", F.expr(f"`{order}` div {TOGETHER}"))
    before = lambda *cols: F.coalesce(F.sum("n").over(Window.partitionBy(*cols[:-1]).orderBy(cols[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = own.groupBy(*by, "__block").agg(F.sum("n").alias("n")).withColumn("__before", before(*by, "__block")).drop("n")
    return own.withColumn("before", before(*by, "__block", order)).join(blocks, [*by, "__block"]).withColumn("before", F.col("before") + F.col("__before")).drop("__before", "__block")


def held_out(doc_id: str = "doc_id") -> Column:
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5) == 0


def sampled_texts(marked: DataFrame, rows: int, chars: int) -> list[tuple]:
    """(kind, text), sorted, of a bounded sample of a table kind, row (a hash), text: of each kind the first `rows` distinct
    rows in the order of the hash, as far as their whole texts have `chars` characters together, over all kinds.

    A text of more than a tenth of what its kind may have is passed over, not cut. Rows with large hashes are left aside before
    ranks are taken, by the number of rows of their kind, so that a hot kind is no burden, and only the texts of the sample
    are moved.
    """
    sized = marked.select("kind", "row", F.length("text").alias("size"))
    share = F.shiftrightunsigned(F.xxhash64("row"), 33) / float(1 << 31)
    counts = sized.groupBy("kind").agg(F.count(F.lit(1)).alias("of"))
    kinds = counts.agg(F.count(F.lit(1)).alias("kinds"))
    counts = counts.crossJoin(F.broadcast(kinds)).withColumn("chars", F.lit(chars) / F.col("kinds"))  # one row
    low = sized.join(counts, "kind").where((share < 8.0 * rows / F.col("of")) & (F.col("size") <= F.col("chars") / 10)).select("kind", "row", "size", "chars").distinct()
    order = Window.partitionBy("kind").orderBy("share", "row").rowsBetween(Window.unboundedPreceding, 0)
    ranked = low.withColumn("share", share).withColumn("nth", F.count(F.lit(1)).over(order)).withColumn("total", F.sum("size").over(order))
    chosen = ranked.where((F.col("nth") <= rows) & (F.col("total") <= F.col("chars"))).select("kind", "row")
    texts = marked.join(F.broadcast(chosen), ["kind", "row"]).groupBy("kind", "row").agg(F.min("text").alias("text"))
    return sorted({(r.kind, r.text) for r in texts.select("kind", "text").collect()})
