"""What substring deduplication by words and by bytes have in common: which windows of fixed length occur twice.

Windows are gathered in segments: runs of consecutive windows that hold the same anchor, an anchor being a place in the
window that its content alone decides. Equal windows have equal anchors at equal offsets, so only segments with equal
anchor keys can share a window.

A segment table has the columns key (of the anchor), seg (digest of all the text that the segment's windows cover, and
of the anchor's offset in it), row (identity of the document row), at (first window), n (number of windows) and more (at
and n of further segments of the row with this key and seg, as texts have that repeat themselves; else null).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .shared import dropped, written

SEGMENT = "key long, seg long, row long, at int, n int, more array<struct<at:int,n:int>>"


def gathered(key: np.ndarray, seg: np.ndarray, row: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Segments of some texts as rows of a segment table, one for each key, seg and row."""
    order = np.lexsort((at, seg, key, row))
    key, seg, row, at, n = (x[order] for x in (key, seg, row, at, n))
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (seg[1:] != seg[:-1]) | (row[1:] != row[:-1])]))
    inside = np.ones(len(key), bool)
    inside[first] = False
    rest = pa.StructArray.from_arrays([pa.array(at[inside].astype(np.int32)), pa.array(n[inside].astype(np.int32))], ["at", "n"])
    counts = np.diff(np.append(first, len(key))) - 1
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), mask=np.concatenate([counts == 0, [False]]))
    arrays = [key[first].view(np.int64), seg[first].view(np.int64), row[first], at[first].astype(np.int32), n[first].astype(np.int32)]
    return pa.RecordBatch.from_arrays([*(pa.array(x) for x in arrays), pa.ListArray.from_arrays(offsets, rest)], ["key", "seg", "row", "at", "n", "more"])


def wanted(batch: pa.RecordBatch, column: int = 2) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text number and first window of each wanted segment, and the entries."""
    spans = batch.column(column)
    flat = spans.flatten()
    return np.asarray(pc.list_parent_indices(spans)).astype(np.int64), np.asarray(flat.field(0)).astype(np.int64), flat


def sorted_out(segments: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(repeated, open, tables): segments that occur as a whole more than once, those that must be looked into, and the tables
    behind them, to be dropped when both are used up.

    Repeated: row, at, n of every occurrence. Open: key, row, at, n of the segments whose anchor key other segments have
    as well, one occurrence of each (with `whole` set if the segment itself is repeated). Both stages aggregate before
    the shuffle, so a key or a segment that a third of all rows share arrives as a row a task.
    """
    segments = written(segments, "segments")
    place, here = F.struct("row", "at", "n"), F.when(F.col("more").isNull(), 1).otherwise(1 + F.size("more"))
    by_key = segments.groupBy("key").agg(F.sum(here).alias("of_key"), F.min("seg").alias("low"), F.max("seg").alias("high")).where("of_key > 1")
    by_key = written(by_key.select("key", (F.col("low") != F.col("high")).alias("mixed")), "keys")
    shared = written(segments.join(by_key.hint("merge"), "key"), "segments")  # keys grow with the corpus: they are not broadcast
    dropped(segments)
    dropped(by_key)
    counts = written(shared.where("mixed").groupBy("key", "seg").agg(F.sum(here).alias("c"), F.min(place).alias("place")), "segments")
    opened = counts.select("key", "place.*", (F.col("c") > 1).alias("whole"))
    # a table of its own, so that adaptive execution can split a segment of very many rows
    again = written(shared.where("mixed").join(counts.where("c > 1").select("key", "seg"), ["key", "seg"], "left_semi").select("row", "at", "n", "more"), "segments")
    whole = shared.where("not mixed").select("row", "at", "n", "more").unionByName(again)
    more = whole.where("more is not null").select("row", F.inline("more"))
    return whole.select("row", "at", "n").unionByName(more), opened, [shared, counts, again]


def spans_of(*found: DataFrame, done: list[DataFrame]) -> DataFrame:
    """(row, spans) from tables of row, at, n: the starts of repeated windows of each row as [at, at + n) pairs, at first. Written;
    the tables in `done`, which it is made from, are dropped."""
    table = found[0].select("row", "at", "n")
    for more in found[1:]:
        table = table.unionByName(more.select("row", "at", "n"))
    spans = written(table.distinct().groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("spans")), "spans")
    for table in done:
        dropped(table)
    return spans
