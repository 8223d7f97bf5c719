"""Approximate nearest neighbours by inner product, over balanced posting lists.

An inner product is turned into a distance by one more component that gives every vector the length of the longest.
Centroids are fitted on a bounded sample by balanced k-means (a price on each list rises with what it holds too much) and
linked in a graph that every task keeps in memory and searches from a few entries on. Every vector goes to its nearest
list and, if it lies near a boundary, to others whose centroid is hardly further away. A query visits the lists whose
centroid is at most `ratio` times as far away as the nearest one; the ratio is the one that finds a stated share of the
sample's own nearest neighbours. Lists and their queries meet by a join in blocks of bounded size, so neither a list nor
the queries of one are ever gathered whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .shared import written

#: The bound on what the index is fitted on: components of the sampled vectors, and rows.
SAMPLE_ROWS, SAMPLE_COMPONENTS = 16_000, 4_000_000
#: Vectors of a list on average, and sampled vectors for each list at least.
LIST, SUPPORT = 512, 40
#: A vector goes to so many lists at most, those within so many times the distance of the nearest.
REPLICAS, BOUNDARY = 2, 1.01
#: The share of the sample's own neighbours that the visited lists must hold, and the queries that it is measured with.
TARGET, PROBES = 0.95, 400
#: Edges of a centroid, centroids that a walk keeps for a vector and for a query, and those opened in one step.
DEGREE, HOME_BEAM, BEAM, WIDTH = 16, 8, 24, 6
#: Vectors that walk over the graph together.
STEP = 1024
#: A query visits so many lists first; what they hold is the floor for the others.
FIRST = 8
#: Components of the vectors, and of the queries, of one block of a list.
BLOCK_VECTORS, BLOCK_QUERIES = 2_000_000, 500_000


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0))


class Index:
    """Centroids, their graph, and the ratio of distances up to which lists are visited."""

    def __init__(self, sample: np.ndarray, lists: int, unit: float, longest: float, k: int, seed: int = 11):
        self.unit, self.longest = unit, longest
        rng = np.random.default_rng(seed)
        points = np.unique(self.placed(sample), axis=0)
        lists = max(1, min(lists, len(points) // SUPPORT))
        self.centres = _balanced(points, lists, rng)
        self.graph = _graph(self.centres)
        self.entries = rng.permutation(len(self.centres))[:8]
        self.ratio = self._fitted(sample, k, rng)

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes all of one length."""
        x = vectors / self.unit
        return np.concatenate([x, np.sqrt(np.maximum(self.longest**2 - (x * x).sum(1), 0))[:, None]], axis=1)

    def asked(self, queries: np.ndarray) -> np.ndarray:
        """Queries in the same space: only their direction matters."""
        x = queries / np.abs(queries).max(1, keepdims=True)
        return np.concatenate([x * (self.longest / np.sqrt((x * x).sum(1)))[:, None], np.zeros((len(x), 1))], axis=1)

    def near(self, points: np.ndarray, ratio: float, beam: int = BEAM) -> np.ndarray:
        """Distances, points by centroids, of the centroids that a walk over the graph finds within `ratio` times the least
        distance, and of some more; infinite for the others."""
        n, k = len(points), len(self.centres)
        found = np.full((n, k), np.inf)
        opened = np.zeros((n, k), bool)
        found[:, self.entries] = _distances(points, self.centres[self.entries])
        opened[:, self.entries] = True
        beam, width = min(beam, k) - 1, min(WIDTH, k)
        live = np.arange(n)
        while len(live):
            own = found[live]
            limit = np.maximum(own.min(1) * ratio, np.partition(own, beam, axis=1)[:, beam])
            waiting = np.where(opened[live], own, np.inf)
            best = np.argpartition(waiting, width - 1, axis=1)[:, :width]
            value = np.take_along_axis(waiting, best, axis=1)
            row, column = np.nonzero((value <= limit[:, None]) & np.isfinite(value))
            if not len(row):
                break
            opened[live[row], best[row, column]] = False
            to = self.graph[best[row, column]]
            who = np.repeat(live[row], to.shape[1])
            to = to.ravel()
            pair = np.unique(who[to >= 0] * k + to[to >= 0])
            who, to = pair // k, pair % k
            new = np.isinf(found[who, to])
            who, to = who[new], to[new]
            gap = points[who] - self.centres[to]
            found[who, to] = np.sqrt((gap * gap).sum(1))
            opened[who, to] = True
            live = live[np.unique(row)]
        return found

    def homes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): the nearest list of each vector, and further ones near the boundary."""
        found = self.near(self.placed(vectors), BOUNDARY, HOME_BEAM)
        most = min(REPLICAS, found.shape[1])
        best = np.argpartition(found, most - 1, axis=1)[:, :most]
        value = np.take_along_axis(found, best, axis=1)
        row, column = np.nonzero(value <= found.min(1)[:, None] * BOUNDARY)
        return row, best[row, column]

    def visits(self, queries: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, nth from 0): the lists within the ratio, nearest first, and if these hold fewer than `least` vectors the
        next ones as well."""
        points = self.asked(queries)
        found = self.near(points, self.ratio)
        chosen = found <= found.min(1)[:, None] * self.ratio
        few = np.flatnonzero((chosen * sizes).sum(1) < least)
        if len(few):
            order = np.argsort(_distances(points[few], self.centres), axis=1, kind="stable")
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            more = np.zeros((len(few), len(sizes)), bool)
            np.put_along_axis(more, order, before < least, axis=1)
            chosen[few] |= more
        row, home = np.nonzero(chosen)
        order = np.lexsort((found[row, home], row))
        row, home = row[order], home[order]
        return row, home, np.arange(len(row)) - np.searchsorted(row, row)

    def _fitted(self, sample: np.ndarray, k: int, rng: np.random.Generator) -> float:
        """The ratio that finds the share TARGET of the k nearest of some sampled vectors among the others."""
        if len(self.centres) == 1 or len(sample) < 2:
            return 1.0
        asked = rng.permutation(len(sample))[:PROBES]
        score = (sample[asked] / self.unit) @ (sample / self.unit).T
        score[np.arange(len(asked)), asked] = -np.inf
        k = min(k, len(sample) - 1)
        nearest = np.argpartition(-score, k - 1, axis=1)[:, :k]
        gaps = _distances(self.asked(sample[asked]), self.centres)
        wanted, place = np.unique(nearest, return_inverse=True)
        needed = np.full(nearest.size, np.inf)
        for a in range(0, len(wanted), STEP):
            row, home = self.homes(sample[wanted[a : a + STEP]])
            order = np.argsort(row, kind="stable")
            row, home = row[order] + a, home[order]
            first = np.searchsorted(row, np.arange(a, min(a + STEP, len(wanted)) + 1))
            for pair in np.flatnonzero((place.ravel() >= a) & (place.ravel() < a + STEP)):
                at = place.ravel()[pair] - a
                needed[pair] = gaps[pair // k, home[first[at] : first[at + 1]]].min()
        return float(np.quantile(needed.reshape(nearest.shape) / gaps.min(1)[:, None], TARGET))


def _balanced(points: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Centroids of lists of about equal size."""
    centres = points[rng.permutation(len(points))[:lists]].copy()
    if lists == 1:
        return points.mean(0, keepdims=True)
    price = np.zeros(lists)
    for k in range(rounds):
        home = np.empty(len(points), np.int64)
        scale = 0.0
        for a in range(0, len(points), 4096):
            gap = _distances(points[a : a + 4096], centres) ** 2
            scale += gap.min(1).sum()
            home[a : a + 4096] = (gap + price).argmin(1)
        sizes = np.bincount(home, minlength=lists)
        price += 0.1 * scale / len(points) * (sizes * lists / len(points) - 1)
        full = sizes > 0
        order = np.argsort(home, kind="stable")
        begin = np.cumsum(sizes) - sizes
        centres[full] = np.add.reduceat(points[order], begin[full], axis=0) / sizes[full][:, None]
        centres[~full] = points[rng.permutation(len(points))[: (~full).sum()]]
    return centres


def _graph(centres: np.ndarray) -> np.ndarray:
    """Neighbours of each centroid (-1 beyond the last): near ones, of which none is nearer to another one, both ways, and
    edges that let everything be reached from everywhere."""
    k = len(centres)
    gap = _distances(centres, centres)
    links: list[set[int]] = [set() for _ in range(k)]
    for c in range(k):
        kept: list[int] = []
        for other in np.argsort(gap[c], kind="stable"):
            if other != c and all(gap[c, other] <= gap[other, x] for x in kept):
                kept.append(int(other))
                if len(kept) == DEGREE:
                    break
        links[c].update(kept, (int(x) for x in np.argsort(gap[c], kind="stable")[1 : 1 + DEGREE // 2]))
        links[c].discard(c)
    for c in range(k):
        for other in list(links[c]):
            links[other].add(c)
    reached, todo = {0}, [0]
    while len(reached) < k:
        while todo:
            for x in links[todo.pop()]:
                if x not in reached:
                    reached.add(x)
                    todo.append(x)
        out = [x for x in range(k) if x not in reached]
        if out:
            inside = sorted(reached)
            a, b = np.unravel_index(gap[np.ix_(out, inside)].argmin(), (len(out), len(inside)))
            links[out[a]].add(inside[b])
            links[inside[b]].add(out[a])
            reached.add(out[a])
            todo = [out[a]]
    table = np.full((k, max(1, max(map(len, links)))), -1, np.int64)
    for c, own in enumerate(links):
        table[c, : len(own)] = sorted(own)
    return table


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """row, vec_id, v (double) and dim of the rows that take part: not null, not zero, all components finite. Written."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    good = F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))) & F.exists(vector, lambda c: c != 0)
    return written(vectors.where(good).select(F.monotonically_increasing_id().alias("row"), "vec_id", x.alias("v"), F.size(vector).alias("dim")), "vectors")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as rows."""
    flat = np.asarray(pc.list_flatten(column).cast(pa.float64()))
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def fitted(whole: DataFrame, dim: int, k: int) -> tuple[Index, int]:
    """The index for vectors of one length, from SAMPLE_ROWS rows (in the order of a hash) with SAMPLE_COMPONENTS components at
    most; and how many vectors there are."""
    size = F.aggregate("v", F.lit(0.0), lambda s, c: F.greatest(s, F.abs(c)))
    count, unit = whole.agg(F.count(F.lit(1)), F.max(size)).first()
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + (c / unit) * (c / unit)))
    longest = whole.agg(F.max(length)).first()[0]
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_COMPONENTS // dim))
    place = F.shiftrightunsigned(F.xxhash64("row"), 33) / float(1 << 31)
    some = whole.where(place < 1.2 * rows / count) if count > rows else whole
    sample = matrix(some.select("v", "row").toArrow().sort_by("row").column(0).combine_chunks())
    return Index(sample[:rows], -(-count // LIST), unit, longest, k), count


def neighbours(vectors: DataFrame, k: int = 20, queries: str = "vec_id % 20 = 0", vector: str = "embedding", block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that `queries` picks, the k rows of the largest inner product among
    those that its lists hold, itself left out; nearest first, ties to the smaller vec_id.

    The score is the sum of the products in order, in double precision. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows without an id; vectors meet only those of their own length, and each
    length has an index of its own. Rows are told apart by their place: every row of a repeated id or vector is a candidate
    and a query of its own. A query with fewer candidates gets all of them. An empty table has no rows; other columns are
    left out, whatever their names.
    """
    whole = usable(vectors, vector)
    found = None
    for (dim,) in whole.select("dim").distinct().orderBy("dim").collect():
        part = _of_one_length(whole.where(F.col("dim") == dim), dim, k, queries, block_vectors, block_queries)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return whole.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = lambda: F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "own"))
    found = found.withColumn("rank", best()).where(F.col("rank") <= REPLICAS * k).dropDuplicates(["row", "own"])
    return found.withColumn("rank", best()).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_one_length(whole: DataFrame, dim: int, k: int, queries: str, block_vectors: int, block_queries: int) -> DataFrame:
    spark = whole.sparkSession
    index, _ = fitted(whole, dim, k)
    sent = spark.sparkContext.broadcast(index)

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            row, home = sent.value.homes(matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32)), *(c.take(pa.array(row)) for c in batch.columns)], ["list", "row", "vec_id", "v"])

    postings = written(whole.select("row", "vec_id", "v").mapInArrow(posted, "list int, row long, vec_id long, v array<double>"), "postings")
    held = dict(map(tuple, postings.groupBy("list").count().collect()))  # a row for each list, of which the sample allows so many
    sizes = np.array([held.get(c, 0) for c in range(len(index.centres))])

    def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            row, home, nth = sent.value.visits(matrix(batch.column(2)), sizes, REPLICAS * (k + 1))
            yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32)), pa.array(nth.astype(np.int32)), *(c.take(pa.array(row)) for c in batch.columns)], ["list", "nth", "row", "query_id", "v"])

    visits = written(whole.where(queries).select("row", F.col("vec_id").alias("query_id"), "v").mapInArrow(visiting, "list int, nth int, row long, query_id long, v array<double>"), "visits")
    asked = dict(map(tuple, visits.groupBy("list").count().collect()))
    parts = lambda counts, most: F.element_at(F.array(*[F.lit(-(-counts.get(c, 0) * dim // most) or 1) for c in range(len(sizes))]), F.col("list") + 1)
    part, block = parts(held, block_vectors), parts(asked, block_queries)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    keys = ["list", "part", "block"]
    lists = postings.withColumn("part", F.pmod(F.xxhash64("row"), part).cast("int")).withColumn("block", every(block))
    dealt = visits.withColumn("block", F.pmod(F.xxhash64("row"), block).cast("int")).withColumn("part", every(part))

    def answers(asking: DataFrame) -> DataFrame:
        return lists.groupBy(*keys).cogroup(asking.select(*keys, "row", "query_id", "v", "floor").groupBy(*keys)).applyInArrow(_best(k), "row long, query_id long, own long, vec_id long, score double")

    first = written(answers(dealt.where(F.col("nth") < FIRST).withColumn("floor", F.lit(None).cast("double"))), "answers")
    nth = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score")))
    floors = first.select("row", "own", "score").distinct().withColumn("place", nth).where(F.col("place") == k).select("row", F.col("score").alias("floor"))
    return first.unionByName(answers(dealt.where(F.col("nth") >= FIRST).join(floors, "row", "left")))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = STEP) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _best(k: int):
    """For each query of a block the k best vectors of the block, as far as they reach its floor, if it has one."""

    def best(members: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)] + [[np.zeros(0)]]
        if members.num_rows and queries.num_rows:
            own, ids, vectors = (members.column(c).combine_chunks() for c in ("row", "vec_id", "v"))
            own, ids, vectors = np.asarray(own), np.asarray(ids), matrix(vectors)
            rows, names, asked, least = (queries.column(c).combine_chunks() for c in ("row", "query_id", "v", "floor"))
            rows, names, asked, least = np.asarray(rows), np.asarray(names), matrix(asked), np.asarray(least.fill_null(-np.inf))
            step = max(1, 2_000_000 // len(own))
            for a in range(0, len(rows), step):
                score = asked[a : a + step] @ vectors.T
                score[rows[a : a + step][:, None] == own[None]] = -np.inf
                n = min(k, len(own))
                floor = np.partition(score, len(own) - n, axis=1)[:, len(own) - n]
                # products come in another order than the exact score: all that rounding can lift over the floor stay in
                slack = 1e-12 * (np.abs(asked[a : a + step]) @ np.abs(vectors).max(0))
                floor = np.maximum(floor, least[a : a + step])
                query, vector = np.nonzero((score >= (floor - slack)[:, None]) & (score > -np.inf))
                exact = np.zeros(len(query))
                for d in range(vectors.shape[1]):
                    exact += asked[a + query, d] * vectors[vector, d]
                order = np.lexsort((own[vector], ids[vector], -exact, query))
                query, vector, exact = query[order], vector[order], exact[order]
                first = np.searchsorted(query, query)
                kept = (np.arange(len(query)) - first < k) & (exact >= least[a + query])
                query, vector, exact = query[kept], vector[kept], exact[kept]
                for column, values in zip(out, (rows[a + query], names[a + query], own[vector], ids[vector], exact)):
                    column.append(values)
        return pa.table([pa.array(np.concatenate(c)) for c in out], ["row", "query_id", "own", "vec_id", "score"])

    return best
