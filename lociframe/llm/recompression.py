"""Word-level substring deduplication by recompression.

Rounds of recompression shorten the sequence of words: a round names each maximal run of one symbol and then each pair of
a left symbol before a right one, sides being drawn from the symbols' names, and names being digests of what they stand
for, so that every task gives equal things equal names without asking the others. What happens to a symbol depends on its
neighbours only; hence equal stretches are parsed alike but for the symbols that a round may tie to what stands outside.
Popping these at both ends of a window, round by round, leaves a sequence that is the window's own: two windows are
equal iff their popped sequences are. A window's anchor is the symbol of most words that survives inside it after
ANCHOR_ROUND (of as long ones the one of the greatest name, then the first); if none does, the first symbol of the last
round that leaves one.

Only windows whose anchor occurs elsewhere with other surroundings are compared one by one; whole segments of windows
that recur as they are, as copies do, are found by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .bytes_np import PIECE_BYTES, Spans, mixed, overlapping, split_words
from .repeats import SEGMENT, gathered, sorted_out, spans_of, wanted
from .shared import fresh, numbering, row_key, without, written

IS_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
ROUNDS, ANCHOR_ROUND = 40, 2


class Words:
    """The words of some texts: place in the bytes, digest, and the first word of each text (one entry more)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        spread = np.full(len(data) + n + 1, 32, np.uint8)
        shift = np.repeat(np.arange(n), np.diff(offsets))
        spread[np.arange(len(data)) + shift] = data
        self.data = spread
        self.starts, self.ends = split_words(spread, IS_WORD)
        self.symbols = Spans(spread.astype(np.uint64)).hash(self.starts, self.ends)
        self.first = np.searchsorted(self.starts, offsets + np.arange(n + 1))

    def spans(self) -> Spans:
        """Of the words by another digest than `symbols`: what is equal by both is equal."""
        return Spans(Spans(self.data.astype(np.uint64), check=True).hash(self.starts, self.ends), check=True)


def first_greatest(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each range [left, right), which is not empty, the first place of its greatest value."""
    out, sizes = np.empty(len(left), np.int64), right - left
    table, width = np.arange(len(values)), 1
    while True:
        now = np.flatnonzero((sizes >= width) & (sizes < 2 * width))
        a, b = table[left[now]], table[right[now] - width]
        out[now] = np.where(values[a] >= values[b], a, b)
        if not len(left) or sizes.max() < 2 * width:
            return out
        a, b = table[:-width], table[width:]
        table, width = np.where(values[a] >= values[b], a, b), 2 * width


class Windows:
    """Of all windows of `size` words: anchor key `key`, first word of the anchor `place` and, if `names` are asked for, the
    digest `name` of the popped sequence."""

    def __init__(self, words: Words, size: int, names: bool = True):
        counts = np.maximum(np.diff(words.first) - size + 1, 0)
        self.owner = np.repeat(np.arange(len(counts)), counts)
        self.nth = np.arange(len(self.owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.start = words.first[self.owner] + self.nth
        n = len(self.start)
        self.name, self.key, self.place = np.zeros(n, np.uint64), np.zeros(n, np.uint64), self.start.copy()
        level = words.symbols
        text = np.repeat(np.arange(len(counts)), np.diff(words.first))
        at = np.arange(len(level))  # the first word of each symbol
        width = np.ones(len(level), np.uint64)
        alive, left, right = np.arange(n), self.start.copy(), self.start + size
        head, tail = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        for k in range(ROUNDS):
            if not len(alive) or k > ANCHOR_ROUND and not names:
                break
            # runs
            first = np.flatnonzero(np.concatenate([[True], (level[1:] != level[:-1]) | (text[1:] != text[:-1])]))
            run = np.zeros(len(level), np.int64)
            run[first[1:]] = 1
            np.cumsum(run, out=run)
            end = np.append(first[1:], len(level))
            low, high = run[left], run[right - 1]
            one = low == high
            lead = np.where(one, right - left, end[low] - left).astype(np.uint64)
            head = mixed(head * np.uint64(3) + level[left] + lead * np.uint64(0x9FB21C651E98DF25))
            trail = np.where(one, 0, right - first[high]).astype(np.uint64)
            tail = np.where(one, tail, mixed(tail * np.uint64(3) + level[right - 1] + trail * np.uint64(0x9FB21C651E98DF25)))
            if k == 0 and one.any():  # a window of one repeated word has that word for an anchor
                self.key[alive[one]], self.place[alive[one]] = level[left[one]], at[left[one]]
            length = (end - first).astype(np.uint64)
            level = np.where(length == 1, level[first], mixed(level[first] + length * np.uint64(0xC2B2AE3D27D4EB4F)))
            text, at, width = text[first], at[first], np.add.reduceat(width, first)
            left, right = low + 1, high
            # pairs
            side = (mixed(level + np.uint64(k + 1)) >> np.uint64(17)) & np.uint64(1) == 1
            pair = np.zeros(len(level), bool)
            pair[:-1] = ~side[:-1] & side[1:] & (text[:-1] == text[1:])
            open_ = left < right
            inside = np.flatnonzero(open_)
            drop = inside[side[left[inside]]]
            head[drop] = mixed(head[drop] * np.uint64(5) + level[left[drop]])
            left[drop] += 1
            inside = np.flatnonzero(left < right)
            drop = inside[~side[right[inside] - 1]]
            tail[drop] = mixed(tail[drop] * np.uint64(5) + level[right[drop] - 1])
            right[drop] -= 1
            second = np.zeros(len(level), bool)
            second[1:] = pair[:-1]
            kept = np.flatnonzero(~second)
            new = np.cumsum(~second) - 1
            joined = level[kept].copy()
            two = pair[kept]
            joined[two] = mixed(mixed(joined[two] + np.uint64(0x165667B19E3779F9)) * np.uint64(7) + level[kept[two] + 1])
            level, text, at, width = joined, text[kept], at[kept], np.add.reduceat(width, kept)
            more = left < right
            self.name[alive[~more]] = mixed(head[~more] * np.uint64(11) + tail[~more] + np.uint64(k))
            alive, head, tail = alive[more], head[more], tail[more]
            left, right = new[left[more]], new[right[more] - 1] + 1
            if k <= ANCHOR_ROUND:
                chosen = left if k < ANCHOR_ROUND else first_greatest((width << np.uint64(48)) | (level >> np.uint64(16)), left, right)
                self.key[alive], self.place[alive] = level[chosen] + np.uint64(k), at[chosen]


def _segments(size: int, most: int):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets, shift in overlapping(batches, "text", size - 1, IS_WORD, most):
            words = Words(data, offsets)
            w = Windows(words, size, names=False)
            if not len(w.start):
                continue
            rows = np.asarray(batch.column(0).cast(pa.int64()))
            cut = np.flatnonzero(np.concatenate([[True], (w.place[1:] != w.place[:-1]) | (w.key[1:] != w.key[:-1]) | (w.owner[1:] != w.owner[:-1])]))
            last = np.append(cut[1:], len(w.start)) - 1
            seg = words.spans().hash(w.start[cut], w.start[last] + size) + mixed((w.place[cut] - w.start[cut]).astype(np.uint64))
            yield gathered(w.key[cut], seg, rows[w.owner[cut]], w.nth[cut] + shift[w.owner[cut]], last - cut + 1)

    return segments


def _opened(size: int, most: int):
    """Windows of the open segments: their names, and where they are."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets, shift in overlapping(batches, "text", size - 1, IS_WORD, most):
            words = Words(data, offsets)
            w = Windows(words, size)
            check = words.spans().hash(w.start, w.start + size)
            counts = np.maximum(np.diff(words.first) - size + 1, 0)
            begin = np.cumsum(counts) - counts
            owner, at, flat = wanted(batch)
            near = at - shift[owner]
            here = np.flatnonzero((near >= 0) & (near < counts[owner]))  # the others are in other parts of a long text
            owner, near, n = owner[here], near[here], np.asarray(flat.field(1)).astype(np.int64)[here]
            pick = np.repeat(begin[owner] + near, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rows = np.asarray(batch.column(0).cast(pa.int64()))
            arrays = [w.name[pick].view(np.int64), check[pick].view(np.int64), rows[w.owner[pick]], (w.nth[pick] + shift[w.owner[pick]]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["name", "check", "row", "at"])

    return opened


def repeated_windows(docs: DataFrame, size: int, numbered: Callable[[DataFrame, str], DataFrame], text: str = "text", most: int = PIECE_BYTES) -> DataFrame:
    """(row, spans): for every document row that has some, the starts of windows whose words also start elsewhere."""
    own = numbered(docs.select("doc_id", F.col(text)), "__row").select(F.col("__row").alias("row"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    repeated, opened, done = sorted_out(own.mapInArrow(_segments(size, most), SEGMENT))
    wanted = opened.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("spans"))
    names = own.join(wanted, "row").select("row", "text", "spans").mapInArrow(_opened(size, most), "name long, check long, row long, at int")
    names = written(names, "windows")  # rows that repeat come twice, and so do their windows, which are repeated
    twice = names.groupBy("name", "check").count().where("count > 1").select("name", "check")
    single = names.join(twice, ["name", "check"], "left_semi").select("row", "at", F.lit(1).alias("n"))
    return spans_of(repeated, single, done=[*done, names])


def without_repeats(docs: DataFrame, size: int = 35, text: str = "text", kept_text: str | None = None, most: int = PIECE_BYTES) -> DataFrame:
    """Adds n_words, n_removed and kept_sha256 to every row (and the kept words, if `kept_text` names a column).

    A word goes if a window of `size` consecutive words over it occurs elsewhere in any document, its own included, as
    the documents were given. Kept words are joined by one space. A null text has no words; a text of fewer words than
    `size` keeps them all. Repeated rows lose all that their windows cover, as they repeat each other. A text of more than
    2 * `most` bytes is worked on in parts of `most` bytes that share what a window can cover. Columns of these names that
    `docs` already has are replaced.
    """
    new = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_sha256": T.StringType()} | ({kept_text: T.StringType()} if kept_text else {})
    carried = without(docs, [c for c in new if c.lower() != text.lower()])
    row, found = fresh(docs, "row", "spans")
    numbered = numbering(docs, row_key(text=text))
    source = numbered(docs, row).select(*[F.col(f"`{c}`") for c in carried], row)
    joined = source.join(repeated_windows(docs, size, numbered, text, most).select(F.col("row").alias(row), F.col("spans").alias(found)), row, "left").drop(row)
    output = [c for c in carried if c.lower() not in {n.lower() for n in new}]
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in output]).schema.fields, *(T.StructField(k, v) for k, v in new.items())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            out: dict[str, list] = {c: [] for c in new}
            for value, spans in zip(batch.column(names.index(text)), batch.column(names.index(found))):
                words = (value.as_py() or "").encode("utf-8", "replace").split()
                kept = words
                if spans.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for s in spans.as_py():
                        edge[s["at"]] += 1
                        edge[s["at"] + s["n"] - 1 + size] -= 1
                    kept = [w for w, c in zip(words, np.cumsum(edge)[:-1].tolist()) if not c]
                body = b" ".join(kept)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(body).hexdigest())
                if kept_text:
                    out[kept_text].append(body.decode())
            arrays = [pa.array(out[c], pa.int64() if c.startswith("n_") else pa.string()) for c in new]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in output), *arrays], [*output, *new])

    return joined.mapInArrow(remove, schema)
