"""Byte-level substring deduplication with suffix arrays, bucketed by anchors.

A window of `size` bytes has for its anchor the place of its least 16-gram digest, the first of equals. Only windows of
equal anchors can be equal, so the suffixes at the anchors are sorted, bucket by bucket, by deep-shallow sorting: those
to the right of the anchor and, reversed, those to its left. Two orders with their common prefixes tell for every
window, by merging groups along the left order, whether one that agrees on both sides stands in the bucket.

Segments that recur as they are never reach a bucket more than once. A bucket with more than BUCKET distinct segments is
parted before it is sorted: each of its windows reaches far to the right of the anchor or far to its left, so windows are
dealt over smaller buckets by that longer stretch of text around the anchor, again and again while a bucket is too large.
"""

from __future__ import annotations

import hashlib
from bisect import bisect
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .bytes_np import Spans, mixed, overlapping
from .deep_shallow import Sorted
from .repeats import SEGMENT, gathered, sorted_out, spans_of, wanted
from .shared import dropped, fresh, numbering, row_key, small, without, written

GRAM = 16
BUCKET = 20_000
PIECE = 700_000


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class Segments:
    """Of all windows of some texts: first and last start, anchor, and the text's number."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int):
        self.data, self.spans, self.size = data, Spans(data.astype(np.uint64)), size
        grams = np.arange(max(0, len(data) - GRAM + 1))
        digest = self.spans.hash(grams, grams + GRAM)
        least = sliding_least((digest >> np.uint64(31) << np.uint64(31)) | grams.astype(np.uint64), size - GRAM + 1)
        counts = np.maximum(np.diff(offsets) - size + 1, 0)
        owner = np.repeat(np.arange(len(counts)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = offsets[owner] + nth
        anchor = (least[start] & np.uint64((1 << 31) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])) if len(start) else start
        self.n = np.diff(np.append(cut, len(start)))
        self.owner, self.at, self.start, self.anchor = owner[cut], nth[cut], start[cut], anchor[cut]
        self.key = digest[self.anchor]
        self.end = self.start + self.n - 1 + size
        self.seg = Spans(data.astype(np.uint64), check=True).hash(self.start, self.end) + mixed((self.anchor - self.start).astype(np.uint64))


def _segments(size: int, most: int):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets, shift in overlapping(batches, "text", size - 1, most=most):
            s = Segments(data, offsets, size)
            if len(s.at):
                rows = np.asarray(batch.column(0).cast(pa.int64()))
                yield gathered(s.key, s.seg, rows[s.owner], s.at + shift[s.owner], s.n)

    return segments


class Wanted:
    """The wanted segments of a part of some texts: owner (text number), at (first window in the text), n, start and anchor
    (in the part's bytes) and entry (of the list they came from). Others are in other parts of a long text."""

    def __init__(self, s: Segments, batch: pa.RecordBatch, shift: np.ndarray):
        owner, at, flat = wanted(batch)
        near = at - shift[owner]
        place = s.owner * (1 << 40) + s.at
        of = np.searchsorted(place, owner * (1 << 40) + near, side="right") - 1
        here = np.flatnonzero((near >= 0) & (of >= 0))
        here = here[(s.owner[of[here]] == owner[here]) & (near[here] < s.at[of[here]] + s.n[of[here]])]
        of = of[here]
        self.owner, self.at, self.entry = owner[here], at[here], flat.take(pa.array(here))
        self.start, self.anchor = s.start[of] + near[here] - s.at[of], s.anchor[of]
        self.n = np.asarray(self.entry.field(1)).astype(np.int64)
        self.row = np.asarray(batch.column(0).cast(pa.int64()))[self.owner]


def _bodies(size: int, most: int):
    """The bytes that the windows of the wanted segments cover, and where the anchor is in them."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets, shift in overlapping(batches, "text", size - 1, most=most):
            w, raw = Wanted(Segments(data, offsets, size), batch, shift), data.tobytes()
            body = pa.array([raw[a:b] for a, b in zip(w.start.tolist(), (w.start + w.n - 1 + size).tolist())], pa.binary())
            arrays = [w.entry.field(3), pa.array(w.row), pa.array(w.at.astype(np.int32)), w.entry.field(2), pa.array((w.anchor - w.start).astype(np.int32)), body]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "row", "at", "whole", "anchor", "body"])

    return bodies


def _parted(size: int, most: int):
    """The wanted segments, whose windows all hold `left` bytes before the anchor and `right` bytes from it on, in two: the
    windows that reach at least half of what is open further to the right, and those that reach as far to the left."""

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets, shift in overlapping(batches, "text", size - 1, most=most):
            w = Wanted(Segments(data, offsets, size), batch, shift)
            names, checks = Spans(data.astype(np.uint64)), Spans(data.astype(np.uint64), check=True)
            left, right = (np.asarray(w.entry.field(k)).astype(np.int64) for k in (4, 5))
            middle = (left + size - right) // 2
            lefts = np.clip(w.anchor - w.start - middle, 0, w.n)  # windows begin ever nearer to the anchor
            for at, n, low, high in ((0, lefts, middle + 1, right), (lefts, w.n - lefts, left, size - middle)):
                some = np.flatnonzero(n > 0)
                start, count = (w.start + at)[some], n[some]
                key = names.hash((w.anchor - low)[some], (w.anchor + high)[some]) + mixed(low[some].astype(np.uint64))
                seg = checks.hash(start, start + count - 1 + size) + mixed((w.anchor[some] - start).astype(np.uint64))
                arrays = [pa.array(x) for x in (key.view(np.int64), seg.view(np.int64), w.row[some], (w.at + at)[some].astype(np.int32), count.astype(np.int32))]
                arrays += [w.entry.field(2).take(pa.array(some)), pa.array(low[some].astype(np.int32)), pa.array(high[some].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "seg", "row", "at", "n", "whole", "left", "right"])

    return parted


def _short_passages(words: int, size: int):
    """Windows of `words` whole words that are shorter than `size` bytes."""
    gap = np.zeros(256, bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = value.as_py().encode("utf-8", "replace")
                inside = np.concatenate([[False], ~gap[np.frombuffer(body, np.uint8)], [False]])
                edges = np.flatnonzero(inside[1:] != inside[:-1])
                first, last = edges[::2][: max(len(edges) // 2 - words + 1, 0)], edges[1::2][words - 1 :]
                for k in np.flatnonzero(last - first < size):
                    a, b = int(first[k]), int(last[k])
                    digest = xxhash.xxh3_128_digest(body[a:b])
                    # n as of windows of `size` bytes, so that the last of them ends where the passage ends
                    out.append((int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True), row, a, b - a - size + 1))
            if out:
                name, check, rows, at, n = np.array(out, np.int64).T
                yield gathered(name.view(np.uint64), check.view(np.uint64), rows, at, n)

    return passages


def bucket_spans(anchors: list[int], bodies: list[bytes], size: int) -> list[list[tuple[int, int]]]:
    """For each text of a bucket, ranges (low, high) of distances before the anchor at which a window starts that another
    text of the bucket has as well."""
    found: list[list[tuple[int, int]]] = [[] for _ in bodies]
    right = Sorted([b[a:] for a, b in zip(anchors, bodies)])
    lefts = [b[:a][::-1] for a, b in zip(anchors, bodies)]
    left = Sorted(lefts)
    if len(bodies) < 2:
        return found

    def pair(i: int, j: int, agree: int) -> None:
        """Ranks i < j of the right order, whose left sides agree in `agree` bytes."""
        least = size - right.common(i, j)
        if least <= agree:
            for r in (i, j):
                found[right.order[r]].append((max(least, 0), agree))

    # groups of the left order, merged from the longest agreement down; a group keeps its ranks in the right order sorted
    group = list(range(len(bodies)))
    members = [[right.rank[k]] for k in left.order]

    def top(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    agreement = left.levels[0]
    for r in sorted(range(1, len(bodies)), key=lambda r: -agreement[r]):
        a, b = top(r - 1), top(r)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        ranks, agree = members[a], agreement[r]
        for x in members[b]:
            place = bisect(ranks, x)
            if place:
                pair(ranks[place - 1], x, agree)
            if place < len(ranks):
                pair(x, ranks[place], agree)
            ranks.insert(place, x)
        group[b], members[b] = a, []
    return found


def _sorted_buckets(size: int):
    """Rows come sorted by key."""

    def one(rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        if len(rows) > 1:
            for (row, at, whole, anchor, _), ranges in zip(rows, bucket_spans([r[3] for r in rows], [r[4] for r in rows], size)):
                if not whole:
                    yield from ((row, at + anchor - high, high - low + 1) for low, high in set(ranges))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for k, *rest in zip(*columns):
                if k != key:
                    out.extend(one(rows))
                    key, rows = k, []
                rows.append(tuple(rest))
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], ["row", "at", "n"])
                out = []
        out.extend(one(rows))
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], ["row", "at", "n"])

    return buckets


def repeated_windows(docs: DataFrame, size: int, numbered: Callable[[DataFrame, str], DataFrame], text: str = "text", bucket: int = BUCKET, words: int | None = None, most: int = PIECE) -> DataFrame:
    """(row, spans): for every document row that has some, the starts of `size`-byte windows that also start elsewhere.

    With `words`, windows of so many words count as well, where they are shorter than `size` bytes: n is 0 or less then.
    """
    own = numbered(docs.select("doc_id", F.col(text)), "__row").select(F.col("__row").alias("row"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    repeated, opened, done = sorted_out(own.mapInArrow(_segments(size, most), SEGMENT))
    opened = opened.select("*", F.lit(0).alias("left"), F.lit(GRAM).alias("right"))

    def texts_with(some: DataFrame, texts: DataFrame = own) -> DataFrame:
        entry = ("at", "n", "whole", "key", "left", "right")
        spans = some.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(*entry))).alias("spans"))
        return texts.join(spans, "row").dropDuplicates(["row"]).select("row", "text", "spans")

    found, ready = [repeated], []
    while True:
        crowded = written(opened.groupBy("key").count().where(F.col("count") > bucket).select("key"), "keys")
        done.append(crowded)
        if crowded.isEmpty():
            ready.append(opened)
            break
        ready.append(opened.join(crowded, "key", "left_anti"))
        large = written(opened.join(crowded, "key", "left_semi"), "segments")
        rows_table = written(large.select("row").distinct(), "keys")
        rows = small(rows_table)  # so that only these texts move
        parts = texts_with(large, own.join(rows, "row", "left_semi")).mapInArrow(_parted(size, most), "key long, seg long, row long, at int, n int, whole boolean, left int, right int")
        parts = written(parts, "segments")
        dropped(rows_table)
        dropped(large)
        again, opened, counts = sorted_again(parts)
        done += [parts, opened, counts]
        found.append(again)
    ready = reduce(DataFrame.unionByName, ready)
    bodies = texts_with(ready).mapInArrow(_bodies(size, most), "key long, row long, at int, whole boolean, anchor int, body binary")
    found.append(bodies.repartition("key").sortWithinPartitions("key").mapInArrow(_sorted_buckets(size), "row long, at int, n int"))
    if words is not None:
        short = written(own.mapInArrow(_short_passages(words, size), SEGMENT), "windows")
        here = F.when(F.col("more").isNull(), 1).otherwise(1 + F.size("more"))
        again = short.groupBy("key", "seg").agg(F.sum(here).alias("c")).where("c > 1").select("key", "seg")
        again = written(short.join(again, ["key", "seg"], "left_semi").select("row", "at", "n", "more"), "windows")
        dropped(short)
        done.append(again)
        found += [again.select("row", "at", "n"), again.where("more is not null").select("row", F.inline("more"))]
    return spans_of(*found, done=done)


def sorted_again(parts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(repeated, open, the table of counts behind them) of the segments of parted buckets: of those not repeated as a whole before, the ones that are now;
    and one occurrence of each segment whose new key others have as well."""
    place = F.struct("row", "at", "n", "left", "right")
    counts = written(parts.groupBy("key", "seg").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("place"), F.max("whole").alias("whole")), "segments")
    keys = counts.groupBy("key").agg(F.count(F.lit(1)).alias("segments")).where("segments > 1").select("key")
    opened = counts.join(keys, "key", "left_semi").select("key", "place.row", "place.at", "place.n", (F.col("whole") | (F.col("c") > 1)).alias("whole"), "place.left", "place.right")
    repeated = parts.where("not whole").join(counts.where("c > 1").select("key", "seg"), ["key", "seg"], "left_semi")
    return repeated.select("row", "at", "n"), written(opened, "segments"), counts


def without_repeats(docs: DataFrame, size: int = 400, text: str = "text", kept_text: str | None = None, words: int | None = None, most: int = PIECE) -> DataFrame:
    """Adds n_bytes, n_removed, n_spans and kept_sha256 to every row (and the kept text, if `kept_text` names a column).

    A byte of the UTF-8 text goes if a string of `size` bytes (or of `words` whole words, if given) over it occurs
    elsewhere in any document, its own included, as the documents were given; n_spans counts the maximal removed stretches.
    Null counts as empty; a text shorter than `size` stays whole; repeated rows repeat each other and lose what their
    windows cover. A text of more than 2 * `most` bytes is worked on in parts of `most` bytes that share what a window can
    cover. In `kept_text`, characters that a cut split are left out. Columns of these names that `docs` already has are replaced (kept_text may be `text`).
    """
    new = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept_sha256": T.StringType()} | ({kept_text: T.StringType()} if kept_text else {})
    row, found = fresh(docs, "row", "spans")
    numbered = numbering(docs, row_key(text=text))
    source = numbered(docs, row).select(*[F.col(f"`{c}`") for c in without(docs, [c for c in new if c.lower() != text.lower()])], row)
    joined = source.join(repeated_windows(docs, size, numbered, text, words=words, most=most).select(F.col("row").alias(row), F.col("spans").alias(found)), row, "left").drop(row)
    output = without(docs, new)
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in output]).schema.fields, *(T.StructField(k, v) for k, v in new.items())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            out: dict[str, list] = {c: [] for c in new}
            for value, spans in zip(batch.column(names.index(text)), batch.column(names.index(found))):
                body = kept = (value.as_py() or "").encode("utf-8", "replace")
                count = 0
                if spans.is_valid:
                    covered: list[list[int]] = []
                    for s in spans.as_py():
                        a, b = s["at"], s["at"] + s["n"] - 1 + size
                        if covered and a <= covered[-1][1]:
                            covered[-1][1] = max(covered[-1][1], b)
                        else:
                            covered.append([a, b])
                    count, parts, done = len(covered), [], 0
                    for a, b in covered:
                        parts.append(body[done:a])
                        done = b
                    kept = b"".join([*parts, body[done:]])
                out["n_bytes"].append(len(body))
                out["n_removed"].append(len(body) - len(kept))
                out["n_spans"].append(count)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if kept_text:
                    out[kept_text].append(kept.decode("utf-8", "ignore") if value.is_valid else None)
            arrays = [pa.array(out[c], pa.int64() if c.startswith("n_") else pa.string()) for c in new]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in output), *arrays], [*output, *new])

    return joined.mapInArrow(remove, schema)
