"""Toxicity of documents: a bidirectional gated recurrent network with attention pooling.

Each word enters as a hashed word vector, the mean of its hashed character trigrams, and a hashed vector of its first six
bytes, next to each other. The network reads a text both ways in blocks of BLOCK words, after CONTEXT words before (and,
backwards, behind) each block, so every word has one state that knows CONTEXT words or more on either side. Attention
weights pool the states of every window of WINDOW words, one beginning at each word, and a logistic unit scores it; as
windows share states, all of them cost two running sums. A document's score is that of its worst window. Everything is
trained here, in numpy, from a bounded sample of labelled rows; scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .bytes_np import Spans, pieces, split_words, text_buffer
from .shared import held_out, row_key, sampled_texts, without

WINDOW, BLOCK, CONTEXT = 32, 48, 16
WORD_ROWS, CHAR_ROWS, BEGIN_ROWS, WIDE, HIDDEN = 1 << 15, 1 << 12, 1 << 14, 8, 8
BEGIN, INPUTS = 6, 3 * WIDE
#: Bytes of text that a task scores at once: some 60 MB of memory.
PIECE = 400_000
#: The bound on what is learned from: labelled rows of each class, and characters of the texts of both together.
SAMPLE_ROWS, SAMPLE_CHARS = 1200, 4_000_000
#: Weight of the clean class against the toxic one.
CLEAN_WEIGHT = 2
DECAY = 0.9
#: ASCII letters and digits, and every byte of a longer character, make up words; A-Z counts as a-z.
IS_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def inputs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word row and row of the beginning of each word, character row of each trigram, where each word's trigrams begin, first
    word of each text."""
    data = LOWER[data]
    gap = np.zeros(len(offsets) - 1, np.int64) + 1
    spread = np.full(len(data) + len(gap), 32, np.uint8)  # a space between texts
    spread[np.arange(len(data)) + np.repeat(np.arange(len(gap)), np.diff(offsets))] = data
    starts, ends = split_words(spread, IS_WORD)
    first = np.searchsorted(starts, offsets + np.arange(len(offsets)))
    spans = Spans(spread.astype(np.uint64))
    words = (spans.hash(starts, ends) % np.uint64(WORD_ROWS)).astype(np.int32)
    begins = (spans.hash(starts, np.minimum(ends, starts + BEGIN)) % np.uint64(BEGIN_ROWS)).astype(np.int32)
    three = np.zeros(len(spread) + 2, np.uint32)
    three[1:-1] = spread
    grams = (three[:-2] * np.uint32(0x9E3779B1) + three[1:-1] * np.uint32(0x85EBCA77) + three[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(20)
    inside = IS_WORD[spread]
    place = np.zeros(len(spread) + 1, np.int64)
    np.cumsum(inside, out=place[1:])
    return words, begins, grams[inside].astype(np.int32), place[starts], first


class Network:
    """Parameters as float32 arrays; both directions are stacked along the first axis where they differ."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        small = lambda *s: rng.normal(0, 0.25, s).astype(np.float32)
        self.p = {
            "word": small(WORD_ROWS, WIDE), "char": small(CHAR_ROWS, WIDE), "begin": small(BEGIN_ROWS, WIDE), "wx": small(2, INPUTS, 3 * HIDDEN), "wh": small(2, HIDDEN, 3 * HIDDEN),
            "b": np.zeros((2, 1, 3 * HIDDEN), np.float32), "att": small(2 * HIDDEN, HIDDEN), "v": small(HIDDEN), "out": small(2 * HIDDEN), "bias": np.zeros(1, np.float32),
        }

    def vectors(self, words: np.ndarray, begins: np.ndarray, grams: np.ndarray, gram_start: np.ndarray) -> np.ndarray:
        if not len(words):
            return np.zeros((0, INPUTS), np.float32)
        sizes = np.diff(np.append(gram_start, len(grams)))
        chars = np.add.reduceat(self.p["char"][grams], gram_start, axis=0) / sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][words], chars, self.p["begin"][begins]], axis=1)

    def step(self, d: int, a: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """New states from projected inputs and states, and what the gradients need."""
        u = h @ self.p["wh"][d]
        zr = 1 / (1 + np.exp(-(a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])))
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(a[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
        return c + z * (h - c), z, r, c, u

    def forward(self, x: np.ndarray, index: np.ndarray):
        """For training: logits of windows, each read with CONTEXT words on either side, and what the gradients need. x: vectors
        of words (the last row is padding); index: rows of x, windows by places, -1 beyond the text."""
        p, (n, t) = self.p, index.shape
        mask = (index >= 0).T[:, :, None].astype(np.float32)
        states = np.zeros((t, n, 2 * HIDDEN), np.float32)
        tape = []
        for d in (0, 1):
            projected = x @ p["wx"][d] + p["b"][d]
            h = np.zeros((n, HIDDEN), np.float32)
            for k in range(t - CONTEXT) if d == 0 else range(t - 1, CONTEXT - 1, -1):
                new, z, r, c, u = self.step(d, projected[index[:, k]], h)
                tape.append((d, k, h, z, r, c, u))
                h = h + mask[k] * (new - h)
                states[k, :, d * HIDDEN : (d + 1) * HIDDEN] = h
        inner = states[CONTEXT : CONTEXT + WINDOW]
        hid = np.tanh(inner.reshape(-1, 2 * HIDDEN) @ p["att"]).reshape(WINDOW, n, -1)
        e = np.where(mask[CONTEXT : CONTEXT + WINDOW, :, 0] > 0, hid @ p["v"], -1e9)
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tn,tnh->nh", w, inner)
        return pooled @ p["out"] + p["bias"][0], tape, inner, hid, w, pooled, mask

    def gradients(self, x: np.ndarray, index: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """By parameter but those of the input vectors, and of x."""
        p = self.p
        logits, tape, states, hid, w, pooled, mask = self.forward(x, index)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char", "begin")}
        d_logit = ((1 / (1 + np.exp(-logits)) - target) * weight).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out"]
        d_w = np.einsum("nh,tnh->tn", d_pooled, states)
        d_e = w * (d_w - (w * d_w).sum(0))
        d_inner = w[:, :, None] * d_pooled[None]
        g["v"] = np.einsum("tn,tnh->h", d_e, hid)
        d_hid = d_e[:, :, None] * p["v"] * (1 - hid * hid)
        g["att"] = states.reshape(-1, 2 * HIDDEN).T @ d_hid.reshape(-1, HIDDEN)
        d_states = np.zeros((index.shape[1], len(index), 2 * HIDDEN), np.float32)
        d_states[CONTEXT : CONTEXT + WINDOW] = d_inner + d_hid @ p["att"].T
        d_x = np.zeros_like(x)
        d_h = {0: 0.0, 1: 0.0}
        for d, k, h, z, r, c, u in reversed(tape):
            d_new = d_states[k, :, d * HIDDEN : (d + 1) * HIDDEN] + d_h[d]
            d_old, d_new = d_new * (1 - mask[k]), d_new * mask[k]
            d_z = d_new * (h - c) * z * (1 - z)
            d_c = d_new * (1 - z) * (1 - c * c)
            d_r = d_c * u[:, 2 * HIDDEN :] * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_c], axis=1)
            d_u = np.concatenate([d_z, d_r, d_c * r], axis=1)
            g["wh"][d] += h.T @ d_u
            g["wx"][d] += x[index[:, k]].T @ d_a
            g["b"][d] += d_a.sum(0)
            np.add.at(d_x, index[:, k], d_a @ p["wx"][d].T)
            d_h[d] = d_old + d_new * z + d_u @ p["wh"][d].T
        return g, d_x

    def states(self, x: np.ndarray, first: np.ndarray, at_once: int = 4096) -> np.ndarray:
        """The state of every word of some texts, both ways. x: vectors of words; first: first word of each text."""
        sizes = np.diff(first)
        counts = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), counts)
        start = first[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * BLOCK
        low, high = first[owner], first[owner + 1]
        inner = (start - CONTEXT >= low) & (start + BLOCK + CONTEXT <= high)
        out = np.zeros((len(x), 2 * HIDDEN), np.float32)
        for d in (0, 1):
            projected = x @ self.p["wx"][d] + self.p["b"][d]
            own = out[:, d * HIDDEN : (d + 1) * HIDDEN]
            for whole, part in ((True, np.flatnonzero(inner)), (False, np.flatnonzero(~inner))):
                for a in range(0, len(part), at_once):
                    rows = part[a : a + at_once]
                    h = np.zeros((len(rows), HIDDEN), np.float32)
                    for k in range(CONTEXT + BLOCK):
                        at = start[rows] + (k - CONTEXT if d == 0 else BLOCK - 1 + CONTEXT - k)
                        if whole:
                            h = self.step(d, projected[at], h)[0]
                            if k >= CONTEXT:
                                own[at] = h
                            continue
                        here = np.flatnonzero((at >= low[rows]) & (at < high[rows]))  # the others keep their states
                        h[here] = self.step(d, projected[at[here]], h[here])[0]
                        if k >= CONTEXT:
                            own[at[here]] = h[here]
        return out

    def window_logits(self, states: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(logit, first word, text) of every window of WINDOW words; a shorter text is one window, one without words has none."""
        p, sizes = self.p, np.diff(first)
        e = np.tanh(states @ p["att"]) @ p["v"]
        weight = np.exp((e - np.abs(p["v"]).sum()).astype(np.float64))
        score = weight * (states @ p["out"])
        counts = np.where(sizes > 0, np.maximum(sizes - WINDOW + 1, 1), 0)
        owner = np.repeat(np.arange(len(sizes)), counts)
        start = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        short = sizes[owner] < WINDOW
        top, below = (self._sums(v, start, short, first, owner) for v in (score, weight))
        return top / below + p["bias"][0], start, owner

    @staticmethod
    def _sums(values: np.ndarray, start: np.ndarray, short: np.ndarray, first: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The sums of WINDOW values from each start on (of a short text, of all it has): the end of one stretch of WINDOW values
        and the beginning of the next, so that nothing is ever subtracted."""
        padded = np.zeros(-(-len(values) // WINDOW) * WINDOW + WINDOW)
        padded[: len(values)] = values
        blocks = padded.reshape(-1, WINDOW)
        ahead, behind = np.cumsum(blocks, axis=1).ravel(), np.cumsum(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        out = behind[start] + np.where(start % WINDOW > 0, ahead[start + WINDOW - 1], 0)
        for k in np.flatnonzero(short):
            out[k] = values[first[owner[k]] : first[owner[k] + 1]].sum()
        return out


def text_scores(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    words, begins, grams, gram_start, first = inputs(data, offsets)
    worst = np.full(len(offsets) - 1, -np.inf, np.float64)
    if len(words):
        logits, _, owner = net.window_logits(net.states(net.vectors(words, begins, grams, gram_start), first), first)
        np.maximum.at(worst, owner, logits)
    return 1 / (1 + np.exp(-worst))


def trained(texts: list[str], toxic: list[int], steps: int = 600, rate: float = 0.01, seed: int = 7) -> Network | None:
    """Multiple-instance training: the worst of all windows of each text stands for it, looked for anew every round. None if
    there are not two classes. At least `steps` batches of 64 texts, and three rounds over the sample; the rate falls to a
    tenth on the way."""
    y = np.asarray(toxic, np.float32)
    if not len(y) or y.min() == y.max():
        return None
    net, rng = Network(seed), np.random.default_rng(seed)
    parts = [inputs(*text_buffer(batch.column(0))) for batch in pieces(pa.table({"text": pa.array(texts, pa.string())}).to_batches(), "text", 1_000_000)]
    before = lambda sizes: np.cumsum([0, *sizes])[:-1]
    words, begins, grams = (np.concatenate([part[k] for part in parts]) for k in range(3))
    gram_start = np.concatenate([part[3] + n for part, n in zip(parts, before([len(part[2]) for part in parts]))])
    sizes = np.diff(np.append(gram_start, len(grams)))
    word_base, text_base = before([len(part[0]) for part in parts]), before([len(part[4]) - 1 for part in parts])
    first = np.append(np.concatenate([part[4][:-1] + n for part, n in zip(parts, word_base)]), len(words))
    balance = np.where(y > 0, 1 / max(1, (y > 0).sum()), CLEAN_WEIGHT / max(1, (y == 0).sum())) * len(y) / (1 + CLEAN_WEIGHT)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, around = 0, np.arange(-CONTEXT, WINDOW + CONTEXT)
    rounds = max(3, -(-steps // -(-len(texts) // 64)))
    for round_ in range(rounds):
        found = []
        for part, w, t in zip(parts, word_base, text_base):
            if len(part[0]):
                logits, start, owner = net.window_logits(net.states(net.vectors(*part[:4]), part[4]), part[4])
                order = np.lexsort((-logits - rng.normal(0, 1e-3, len(logits)), owner))
                worst = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]
                found.append(np.stack([start[worst] + w, owner[worst] + t]))
        if not found:
            return None
        start, owner = np.concatenate(found, axis=1)
        pace = rate * (1 - DECAY * round_ / rounds)
        chosen = rng.permutation(len(start))
        for a in range(0, len(chosen), 64):
            batch = chosen[a : a + 64]
            own = start[batch][:, None] + around
            own = np.where((own >= first[owner[batch]][:, None]) & (own < first[owner[batch] + 1][:, None]), own, -1)
            used = np.unique(own[own >= 0])
            row = np.searchsorted(used, own)
            at = np.concatenate([np.arange(gram_start[k], gram_start[k] + sizes[k]) for k in used])
            begin = np.cumsum(sizes[used]) - sizes[used]
            x = np.concatenate([net.vectors(words[used], begins[used], grams[at], begin), np.zeros((1, INPUTS), np.float32)])
            g, d_x = net.gradients(x, np.where(own >= 0, row, -1), y[owner[batch]], balance[owner[batch]] / len(batch))
            g |= {k: np.zeros_like(net.p[k]) for k in ("word", "char", "begin")}
            np.add.at(g["word"], words[used], d_x[:-1, :WIDE])
            np.add.at(g["char"], grams[at], np.repeat(d_x[:-1, WIDE : 2 * WIDE] / sizes[used][:, None], sizes[used], axis=0))
            np.add.at(g["begin"], begins[used], d_x[:-1, 2 * WIDE :])
            step += 1
            for k, v in g.items():
                m, s = moment[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                net.p[k] -= pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return net


def learned(docs: DataFrame, labels: DataFrame) -> Network | None:
    """From rows of `docs` that `labels` marks and that are not held out: the 3 * SAMPLE_ROWS first labels of each class, in
    the order of a hash of doc_id, are looked up in `docs` (a broadcast of as many ids), and of the rows found the first
    SAMPLE_ROWS of each class are learned from, whole texts, as far as they have half of SAMPLE_CHARS characters together. No
    text is shuffled."""
    marks = labels.where(~held_out()).select("doc_id", F.col("toxic").alias("kind"))
    ids = [marks.where(F.col("kind") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(3 * SAMPLE_ROWS) for kind in (0, 1)]
    chosen = F.broadcast(ids[0].unionByName(ids[1]).distinct())
    found = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(chosen, "doc_id")
    rows = sampled_texts(found.select("kind", row_key().alias("row"), "text"), SAMPLE_ROWS, SAMPLE_CHARS)
    return trained([r[1] for r in rows], [r[0] for r in rows])


def scored(docs: DataFrame, net: Network | None, text: str = "text", score: str = "score") -> DataFrame:
    """Adds the score (0 to 1) to every row; an own column of that name is replaced.

    A null text, and one without words, scores 0; so does every text if there was nothing to learn from. Texts of any length
    are scored whole, by all their windows; repeated rows score alike; an empty table stays empty.
    """
    source = docs.select(*[F.col(f"`{c}`") for c in without(docs, [score])])
    broadcast = docs.sparkSession.sparkContext.broadcast(net)

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, PIECE):
            model = broadcast.value
            data, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
            values = text_scores(model, data, offsets) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, score])

    return source.mapInArrow(score_batches, T.StructType([*source.schema.fields, T.StructField(score, T.DoubleType())]))
