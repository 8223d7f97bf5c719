"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

Queries go in blocks of a stated size to all tasks; rows stay where they are. A task keeps its rows in chunks, each as one
list a dimension, sorted by value. A query walks the lists of a chunk in step, from the end that its sign in that
dimension favours, and looks up the whole score of each row it meets first. The scores at the current depth bound all rows
not yet met; when the bound is below the k-th score found, in this chunk or those before it, the rest of the chunk cannot
matter, ties included. The best k of the tasks' answers are the answer. All scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .shared import written

#: Rows of a chunk, and components of all the queries of a block (8 bytes each, so 16 MB are sent to the tasks at once).
CHUNK, BLOCK = 10_000, 2_000_000
#: Below this, products and sums of integers are exact in float64.
EXACT = 1 << 53


def _product(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products: in float64 where that is exact, else in 64-bit integers, else in Python's."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * rows.shape[1]
    if most < EXACT:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if most < 1 << 62:
        return rows @ query
    return np.array([int(sum(int(a) * int(b) for a, b in zip(r, query))) for r in rows], object)


class Lists:
    """The rows of a chunk (ascending ids), their identities, and the row numbers of each dimension's list, ascending by
    value."""

    def __init__(self, ids: np.ndarray, own: np.ndarray, rows: np.ndarray):
        order = np.lexsort((own, ids))
        self.ids, self.own, self.rows = ids[order], own[order], rows[order]
        self.lists = np.argsort(self.rows, axis=0, kind="stable").T.copy() if len(ids) else np.zeros((rows.shape[1], 0), np.int64)
        self.values = np.take_along_axis(self.rows.T, self.lists, axis=1)

    def best(self, query: np.ndarray, own: int, k: int, least: int | None = None, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows but `own`, by score and then id, those under `least` left out if they
        are not met before. `step`: depths between two looks at the bound."""
        n, live = len(self.ids), np.flatnonzero(query)
        down = query[live] > 0
        met = np.zeros(n, bool)
        kept_rows, kept_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth = 0
        if not len(live):  # all scores are 0
            met[:] = True
            kept_rows, kept_scores = np.arange(n), np.zeros(n, np.int64)
            depth = n
        while depth < n:
            to = min(n, depth + step)
            low = self.lists[live[~down], depth:to].ravel()
            high = self.lists[live[down], n - to : n - depth].ravel()
            seen = np.zeros(n, bool)
            seen[low] = seen[high] = True
            new = np.flatnonzero(seen & ~met)
            met[new] = True
            kept_rows = np.concatenate([kept_rows, new])
            kept_scores = np.concatenate([kept_scores, _product(self.rows[new], query)])
            own_out = self.own[kept_rows] != own
            kept_rows, kept_scores = kept_rows[own_out], kept_scores[own_out]
            if len(kept_rows) > k:
                order = np.lexsort((kept_rows, -kept_scores))[:k]
                kept_rows, kept_scores = kept_rows[order], kept_scores[order]
            depth, step = to, step * 2
            floor = [int(kept_scores.min())] if len(kept_rows) == k else []
            floor += [least] if least is not None else []
            if depth < n and floor:
                edge = np.where(down, self.values[live, n - depth - 1], self.values[live, depth])
                if sum(int(a) * int(b) for a, b in zip(edge, query[live])) < max(floor):
                    break
        keep = self.own[kept_rows] != own
        kept_rows, kept_scores = kept_rows[keep], kept_scores[keep]
        order = np.lexsort((kept_rows, -kept_scores))[:k]
        return kept_rows[order], kept_scores[order]


def integers(vectors: DataFrame, scale: int = 1024, vector: str = "embedding") -> DataFrame:
    """vec_id and v: floor(scale * x) of each component. Vectors that are null, empty, or hold null or non-finite
    components are left out, as are rows without an id."""
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.col("vec_id").isNotNull()
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vectors.where(usable & finite).select("vec_id", F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


class Answers:
    """The best k rows that a task has met so far, for each query of a block."""

    def __init__(self, queries: list[tuple[int, int, list[int]]], k: int):
        self.k = k
        self.queries = [(own, asked, np.asarray(v, np.int64)) for own, asked, v in queries]
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in queries]

    def meet(self, ids: np.ndarray, own: np.ndarray, vectors: list[np.ndarray]) -> None:
        sizes = np.array([len(v) for v in vectors])
        for size in np.unique(sizes):
            some = np.flatnonzero(sizes == size)
            lists = Lists(ids[some], own[some], np.stack([vectors[j] for j in some]))
            for (row, _, query), found in zip(self.queries, self.found):
                if len(query) == size:
                    rows, scores = lists.best(query, row, self.k, -found[-1][0] if len(found) == self.k else None)
                    found += [(-int(x), int(lists.ids[r]), int(lists.own[r])) for r, x in zip(rows, scores)]
                    found.sort()
                    del found[self.k :]

    def table(self) -> pa.RecordBatch:
        rows = [(row, asked, vec, -score) for (row, asked, _), found in zip(self.queries, self.found) for score, vec, _ in found]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(4)], ["row", "query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, k: int = 10, queries: str = "vec_id % 100 = 0", scale: int = 1024, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k rows of the highest inner product, itself left out.

    Ties go to the smaller vec_id; a query with fewer candidates gets all of them. Vectors meet only others of their own
    length. Rows are told apart by their place, not by their id: every row of a repeated id is a candidate, of the other
    rows of its id as well, and each query row is answered for itself. An empty table gives no rows; other columns are left out,
    whatever their names. A pass over the rows answers the queries of one
    block, whose vectors have `block` components together on average; no row is copied or shuffled.
    """
    whole = written(integers(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = whole.where(queries).select("row", F.col("vec_id").alias("query_id"), "v")
    blocks = max(1, -(-(asked.agg(F.sum(F.size("v"))).first()[0] or 0) // block))
    found = None
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).collect()
        sent = whole.sparkSession.sparkContext.broadcast([(r[0], r[1], list(r[2])) for r in own])
        part = whole.select("row", "vec_id", "v").mapInArrow(_answers(sent, k, chunk), "row long, query_id long, vec_id long, score long")
        part = written(part, "answers")  # so that the block's queries can go
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _answers(sent, k: int, chunk: int):
    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = Answers(sent.value, k), []
        if not known.queries:
            return

        def meet() -> None:
            known.meet(*(np.concatenate([h[c] for h in held]) for c in (0, 1)), [v for h in held for v in h[2]])
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(2)
            flat, ends = np.asarray(lists.flatten().cast(pa.int64())), np.cumsum(np.asarray(pc.list_value_length(lists)))
            held.append((np.asarray(batch.column(1).cast(pa.int64())), np.asarray(batch.column(0)), np.split(flat, ends[:-1])))
            if sum(len(h[0]) for h in held) >= chunk:
                meet()
        if held:
            meet()
        yield known.table()

    return answers
