"""op1 and op7 against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from lociframe.llm import recompression, suffix_dedup
from lociframe.llm.deep_shallow import deep_shallow

SF = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, spans string, n_words int"


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "aé", "the", "of", "c" * rng.randrange(1, 5)])
    passage = [word() for _ in range(60)]
    texts = []
    for k in range(30):
        words = [word() for _ in range(rng.randrange(0, 50))]
        if k % 3 == 0:
            at = rng.randrange(0, 30)
            words += passage[at : at + rng.randrange(5, 31)] + [word() for _ in range(9)]
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    texts += ["x y " * 40, "x " * 90, "a" * 300, "", "   ", None, texts[0], texts[3], texts[3]]
    rows = [(k, t, "s", 1) for k, t in enumerate(texts)]
    return rows + [rows[3], (None, texts[6], None, None), (None, None, None, None)]


def by_words(rows, size):
    words = [WORD.findall(r[1] or "") for r in rows]
    seen = Counter(tuple(w[k : k + size]) for w in words for k in range(len(w) - size + 1))
    for r, w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        yield r[0], len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()


def by_bytes(rows, size):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[k : k + size] for t in texts for k in range(len(t) - size + 1))
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - size + 1):
            if seen[t[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        yield r[0], len(t), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest()


@pytest.mark.parametrize("seed, size, most", [(1, 6, 1_500_000), (2, 12, 1_500_000), (3, 6, 40)])
def test_words(spark, seed, size, most):
    rows = corpus(seed)
    out = recompression.without_repeats(spark.createDataFrame(rows, SCHEMA), size, most=most)
    assert out.columns == ["doc_id", "text", "spans", "n_words", "n_removed", "kept_sha256"]
    got = [tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert sorted(got, key=str) == sorted(by_words(rows, size), key=str)


@pytest.mark.parametrize("seed, size, bucket, most", [(1, 25, 20_000, 1_500_000), (2, 40, 3, 1_500_000), (3, 25, 1, 1_500_000), (4, 25, 2, 70)])
def test_bytes(spark, monkeypatch, seed, size, bucket, most):
    rows = corpus(seed)
    plain = suffix_dedup.repeated_windows
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda docs, n, numbered, text="text", **kw: plain(docs, n, numbered, text, bucket, **kw))
    out = suffix_dedup.without_repeats(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_words", "__row"), size, most=most)
    got = [tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=str) == sorted(by_bytes(rows, size), key=str)


def test_words_that_collide_under_powers_of_two(spark):
    """A Thue-Morse word and its complement are equal to any polynomial hash modulo 2^64."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    one, two = ("".join("ab"[b ^ x] for b in bits) for x in (0, 1))
    rest = " ".join(f"w{k}" for k in range(34))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{two} {rest}")], "doc_id bigint, text string")
    assert [r.n_removed for r in recompression.without_repeats(docs, 35).collect()] == [0, 0]
    assert [r.n_removed for r in recompression.without_repeats(docs, 34).collect()] == [34, 34]


def test_a_text_that_repeats_itself_is_one_row_a_segment(spark):
    docs = spark.createDataFrame([(1, "lorem ipsum dolor sit amet " * 3000), (2, "x"), (3, "lorem ipsum dolor sit amet " * 9)], "doc_id bigint, text string")
    table = docs.selectExpr("doc_id as row", "text").mapInArrow(suffix_dedup._segments(100, 1_500_000), suffix_dedup.SEGMENT)
    assert table.count() < 300
    assert {r.doc_id: r.n_removed for r in suffix_dedup.without_repeats(docs, 100).collect()} == {1: 27 * 3000, 2: 0, 3: 27 * 9}


def test_kept_text_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert recompression.without_repeats(empty, 5).count() == suffix_dedup.without_repeats(empty, 30).count() == 0
    docs = spark.createDataFrame([(1, "é" * 20 + "xyz"), (2, "uvw" + "é" * 20), (3, None)], "doc_id bigint, text string")
    kept = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs, 31, kept_text="text").collect()}
    assert kept == {1: "xyz", 2: "uvw", 3: None}


def test_passages_of_short_words(spark):
    rng = random.Random(3)
    short = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    own, fifty, more = short(400), short(50), short(60)
    texts = [f"long first {fifty} lasts", f"{fifty} other end", f"nothing {more} ends", f"{more}", f"another\n{more}x", own[:300], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs, 250, kept_text="text", words=51).collect()}
    assert kept == {0: texts[0], 1: texts[1], 2: "nothing  ends", 3: "", 4: "another\n" + more[-2:] + "x", 5: texts[5], 6: None}
    cut = corpus_pipeline.cut_repeats(spark, docs.withColumn("n_chars", F.lit(0)), SF)
    assert {r.doc_id: r.text for r in cut.collect()} == kept


@pytest.mark.parametrize("seed", range(4))
def test_deep_shallow_sorts(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 90))) for _ in range(200)]
    texts += [b"a" * k for k in range(0, 80, 3)] + [texts[0], b"", b"a" * 64 + b"b"]
    assert [texts[k] for k in deep_shallow(texts)] == sorted(texts)
