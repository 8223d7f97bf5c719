"""Tables between rounds of an iteration, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names. One is made up only in local mode, where the driver's
    folder is everybody's."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """`df` as Parquet in the shared folder, read again."""
    path = shared_path(df.sparkSession, "round")
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.__dict__["folder"] = path
    return table


def dealt(df: DataFrame, keys: Sequence[str], rows: int = 200_000) -> DataFrame:
    """`df` dealt by `keys` into parts of about `rows` rows, so that what one task sorts does not grow with the table. The rows
    are counted first; there are as many parts as shuffle partitions at least."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // rows + 1)
    return df.repartition(parts, *keys)


def bucketed(df: DataFrame, keys: list[str]) -> DataFrame:
    """`df` as a table in the shared folder that is bucketed by `keys`, so that joins and sums by these keys do not shuffle it.
    There are as many buckets as shuffle partitions, and a file for each."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = shared_path(spark, "buckets"), f"buckets_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path).format("parquet").saveAsTable(name)
    table = spark.table(name)
    table.__dict__["folder"], table.__dict__["table"] = path, name
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes what `written` and `bucketed` made."""
    for df in tables:
        spark = df.sparkSession
        if "table" in df.__dict__:
            spark.sql(f"DROP TABLE IF EXISTS {df.__dict__['table']}")
        path = spark._jvm.org.apache.hadoop.fs.Path(df.__dict__["folder"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
