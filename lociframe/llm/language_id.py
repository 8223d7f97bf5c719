"""Language of documents: averaged hashed subword vectors with a linear softmax.

The subwords of a text are the byte n-grams of its words (3 and 4 bytes, with the word's edges, lower-cased). Their
vectors are averaged over the text, and a linear layer with a softmax gives a probability to every
language; a temperature fitted on rows kept apart calibrates it, and answers under a threshold, fitted there too, are
marked as rejected. Vectors and weights are trained here by stochastic gradient descent in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .bytes_np import pieces, text_buffer
from .shared import held_out, row_key, sampled_texts, without

ROWS, WIDE, GRAMS = 1 << 15, 16, (3, 4)
#: The bound on what is learned from: rows of each language, and characters of the texts of all languages together.
SAMPLE_ROWS, SAMPLE_CHARS = 400, 8_000_000
#: Share of the rows kept apart for the temperature and the threshold, and the accuracy wanted of accepted answers.
APART, ACCURACY = 0.25, 0.99
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Letters are what is read: ASCII letters and all bytes of longer characters; A-Z counts as a-z.
IS_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


@dataclass
class Model:
    languages: list[str]
    #: A row of scores a subword: its vector times the linear layer, so that a text needs sums only.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def subwords(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size, the vector rows of the n-grams in order, and where those of each text begin (one entry more)."""
    n = len(offsets) - 1
    begins = 1 + offsets + np.arange(n + 1)  # a blank stands before each text and at the end
    spread = np.full(len(data) + n + 1, 32, np.uint8)
    spread[1 + np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = LOWER[data]
    letters = IS_LETTER[spread]
    spread[~letters] = 32
    wide, found = spread.astype(np.uint32), []
    code, inner = wide, np.ones(len(spread), bool)
    for size in range(2, max(GRAMS) + 1):
        code = code[:-1] * np.uint32(0x01000193) + wide[size - 1 :]
        inner = inner[:-1] & letters[size - 2 : -1] if size > 2 else inner[:-1]
        if size in GRAMS:
            at = np.flatnonzero(inner)
            rows = ((code[at] ^ np.uint32(size)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - ROWS.bit_length() + 1)
            found.append((rows.astype(np.int32), np.searchsorted(at, begins - 1)))
    return found


def text_probabilities(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    sums, counts = np.zeros((n, len(model.languages))), np.zeros(n)
    for rows, begins in subwords(data, offsets):
        sizes = np.diff(begins)
        some = np.flatnonzero(sizes)
        counts += sizes
        if len(some):
            sums[some] += np.add.reduceat(model.table[rows[: begins[-1]]], begins[:-1][some], axis=0)
    logits = (sums / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def trained(texts: list[str], langs: list[str], steps: int = 7000, rate: float = 4.0, seed: int = 5) -> Model | None:
    """None if there is no row to learn from. At least `steps` steps, one text each, and three rounds over the sample."""
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted(set(langs))
    y = np.searchsorted(languages, langs)
    data, offsets = text_buffer(pa.array(texts, pa.string()))
    found = subwords(data, offsets)
    bags = [np.concatenate([rows[begins[k] : begins[k + 1]] for rows, begins in found]) for k in range(len(texts))]
    vectors = rng.uniform(-1 / WIDE, 1 / WIDE, (ROWS, WIDE)).astype(np.float32)
    weights = np.zeros((WIDE, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    apart = rng.random(len(texts)) < APART
    apart &= len(texts) >= 20
    own = [k for k in np.flatnonzero(~apart) if len(bags[k])]
    epochs = max(3, -(-steps // max(1, len(own))))
    for epoch in range(epochs):
        step = np.float32(rate * (1 - epoch / epochs))
        for k in rng.permutation(own):
            bag = bags[k]
            mean = vectors[bag].mean(0)
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[k]] -= 1
            back = weights @ p
            weights -= step / 10 * np.outer(mean, p)
            bias -= step / 100 * p
            np.subtract.at(vectors, bag, (step / len(bag)) * back)
    model = Model(languages, vectors @ weights, bias, 1.0, 0.0)
    if apart.any():
        kept = np.flatnonzero(apart)
        d, o = text_buffer(pa.array([texts[k] for k in kept], pa.string()))
        best = np.inf
        for temperature in np.geomspace(0.05, 20, 41):
            model_t = Model(languages, model.table, bias, float(temperature), 0.0)
            p = text_probabilities(model_t, d, o)
            loss = -np.log(np.maximum(p[np.arange(len(kept)), y[kept]], 1e-12)).mean()
            if loss < best:
                best, model = loss, model_t
        p = text_probabilities(model, d, o)
        sure, right = p.max(1), p.argmax(1) == y[kept]
        for threshold in np.sort(sure):
            if right[sure >= threshold].mean() >= ACCURACY:
                model.threshold = float(threshold)
                break
    return model


def learned(docs: DataFrame) -> Model | None:
    """From text and lang of rows that are not held out: of each language the SAMPLE_ROWS first in the order of a hash of id
    and text, whole texts, as far as they have an equal part of SAMPLE_CHARS characters together."""
    usable = ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    found = sampled_texts(docs.where(usable).select(F.col("lang").alias("kind"), row_key().alias("row"), "text"), SAMPLE_ROWS, SAMPLE_CHARS)
    return trained([r[1] for r in found], [r[0] for r in found])


def identified(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Adds lang_pred, score and accepted to every row; own columns of these names are replaced.

    A text that is null or has no letter is `und` with score 0, and so is every text if there was nothing to learn from.
    `accepted` says whether the score reaches the fitted threshold. Texts of any length are read whole; repeated rows are judged
    alike; an empty table stays empty.
    """
    new = {"lang_pred": T.StringType(), "score": T.DoubleType(), "accepted": T.BooleanType()}
    source = docs.select(*[F.col(f"`{c}`") for c in without(docs, new)])
    schema = T.StructType([*source.schema.fields, *(T.StructField(k, v) for k, v in new.items())])
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            fitted = broadcast.value
            column = batch.column(batch.schema.get_field_index(text))
            letters = np.array([fitted is not None and LETTER.search(v.as_py() or "") is not None for v in column])
            names, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            if fitted is not None and letters.any():
                p = text_probabilities(fitted, *text_buffer(column))
                names[letters] = np.array(fitted.languages, object)[p.argmax(1)[letters]]
                score[letters] = p.max(1)[letters]
            accepted = letters & (score >= (fitted.threshold if fitted else 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(accepted)], [*batch.schema.names, *new])

    return source.mapInArrow(identify, schema)
