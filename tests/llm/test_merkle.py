"""op13 against a plain recursion."""

import hashlib
import random
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from lociframe.llm import merkle, queries

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, Path string"
H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaf(row, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def tree(nodes, fan):
    """The root and the path (left, right) of every node."""
    paths, above = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        made, joined = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a : a + fan]
            for k in range(len(run)):
                for own in above[a + k]:
                    paths[own].append(("".join(run[:k]), "".join(run[k + 1 :])))
            made.append(H(*run))
            joined.append([x for k in range(a, min(a + fan, len(nodes))) for x in above[k]])
        nodes, above = made, joined
    return nodes[0], paths


def brute(rows, fan=8):
    key = lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf(r, r[4]))
    groups = [list(g) for _, g in groupby(sorted(rows, key=key), key=lambda r: r[2])]
    trees = [tree([leaf(r, r[4]) for r in g], fan) for g in groups]
    root, upper = tree([t[0] for t in trees], fan) if trees else (None, [])
    out = []
    for group, (subroot, paths), up in zip(groups, trees, upper):
        for row, path in zip(group, paths):
            path = path + up
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = text.translate(LOWER)
            fold = leaf(row, text)
            for left, right in path:
                fold = H(left, fold, right)
            out.append((row[0], leaf(row, row[4]), subroot, root, H(*[x for s in path for x in s]), fold, fold == root))
    return sorted(out, key=str)


def corpus(seed, n=700):
    rng = random.Random(seed)
    langs = [None, "", "de", "Zz", "é", *[f"l{k}" for k in range(12)]]
    rows = []
    for k in range(n):
        lang = "en" if rng.random() < 0.4 else rng.choice(langs)
        rows.append((rng.choice([k, k, k, 7, None]), rng.choice(["s", None]), lang, rng.choice([k, None]), rng.choice([None, "", "Text É", "plain", "A" * 5000])))
    rows += [(10_000, "s", "lone", 1, "One")]
    return rows + rows[:40] + [(7, "s", "en", 3, "Same")] * 30


@pytest.mark.parametrize("seed, size, fan", [(1, 20_000, 8), (2, 25, 8), (3, 25, 3)])
def test_manifest(spark, tmp_path, seed, size, fan):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA)
    of = lambda text: merkle.leaf_hash(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, of(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    out = merkle.manifest(docs, of(F.col("text")), carry={"doc_id": F.col("doc_id"), "changed": changed}, fan=fan, rows=size)
    fold = merkle.folded(F.coalesce("changed", "leaf"), F.col("path"))
    got = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("path")), fold, fold == F.col("root")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, fan)


def test_query_and_edge_tables(spark, tmp_path):
    for name, rows in (("few", corpus(4, 60)), ("one", [(1, None, None, None, None)]), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).write.parquet(folder + "/documents.parquet")
        got = queries.op13_merkle_manifest(spark, folder)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_ranges_leave_ranks_gapless(spark):
    rows = spark.range(5000).selectExpr("case when id % 3 = 0 then 'hot' else concat('t', id % 40) end as tree", "hash(id) % 100 as o", "id as own")
    got, _ = merkle.ranked(rows, "tree", ["o", "own"], 50)
    got = got.collect()
    by = {}
    for r in got:
        by.setdefault(r.tree, []).append((r.o, r.own, r["rank"], r.n))
    for own in by.values():
        assert [x[2] for x in sorted(own)] == list(range(len(own))) and all(x[3] == len(own) for x in own)
