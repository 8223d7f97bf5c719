"""The other operators against brute force, with nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lociframe.llm import bpe_automaton, decontamination, language_id, recompression, sharding, simhash, suffix_dedup, threshold_topk, toxicity, url_filter
from lociframe.llm.components import components
from lociframe.llm.queries import URL_RULES
from lociframe.llm.shared import numbering, row_key

SF = "/root/testdata/sf0.001"


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(40)] + [(5, 5), (None, 3)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    want = {x: top(x) for x in parent}
    assert {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_bpe(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rng = random.Random(3)
    texts = [None, "", "a" * 4000, " \n\t x　y", "<|endoftext|>hi<|endoftext|>", "héé 你好 🙂🙂", "ab" * 500 + "!!!" * 90, "  lead  spaces   ", "don't we'll I'M"]
    texts += ["".join(rng.choice("theans \n'1é!") for _ in range(60)) for _ in range(60)]
    df = spark.createDataFrame([(k, x, "old") for k, x in enumerate(texts)], "doc_id bigint, text string, n_tokens string")
    out = bpe_automaton.tokenized(df, path, ids="ids", decoded="back").collect()
    assert len(out) == len(texts)
    for r in out:
        ids = t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.back) == (ids, len(ids), t.decode(ids, skip_special_tokens=False))
    assert bpe_automaton.tokenized(df.limit(0), path).count() == 0


def test_bpe_words_are_walked_side_by_side(monkeypatch):
    """Short words are not walked one at a time, and have the ids of those that are; the memory keeps no long word."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        automaton = bpe_automaton.compiled(f.read())
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choice("theans1é!🙂\n") for _ in range(rng.randrange(1, 16))) for _ in range(40)) for _ in range(60)] + ["", "x" * 300, "<|endoftext|>the"]
    alone, path = [], automaton.path
    monkeypatch.setattr(automaton, "path", lambda data: alone.append(data) or path(data))
    together = automaton.encode(texts)
    assert alone == [b"x" * 300] and max(map(len, automaton.words)) < 300
    monkeypatch.setattr(bpe_automaton, "SIDE_BY_SIDE", 1 << 30)
    automaton.words.clear()
    assert automaton.encode(texts) == together and len(alone) > 1000


def test_fingerprint_groups(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") for _ in range(n)) for n in (0, 1, 2, 3, 9, 40, 300)]
    texts = [None, *base, base[5], base[6], base[6] + " z", base[6].upper(), "\n".join(base[6].split()), base[4] + " q"]
    rows = [(k if k != 4 else None, t) for k, t in enumerate(texts)] + [(9, texts[9])]

    def fp(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sh = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    prints = [(d, fp(t)) for d, t in rows]
    group = {p: {p} for _, p in prints}
    for a in list(group):
        for b in list(group):
            if (a ^ b).bit_count() <= 2 and group[a] is not group[b]:
                both = group[a] | group[b]
                for x in both:
                    group[x] = both
    want = sorted(((d, "%016x" % p, min((e for e, q in prints if q in group[p] and e is not None), default=None)) for d, p in prints), key=str)
    got = simhash.fingerprint_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == want


@pytest.mark.parametrize("radius, hot", [(2, 500), (7, 500), (7, 2), (2, 2)])
def test_hamming_links(spark, radius, hot):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(0, 6))) & (1 << 64) - 1 for c in centres for _ in range(25)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {tuple(r) for r in simhash.hamming_links(spark.createDataFrame([(p, p) for p in signed], "node bigint, fp bigint"), radius, hot=hot).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius}
    if hot == 500:
        assert got == want
    assert got <= want
    # what all pairs connect is connected
    root = {r.node: r.component for r in components(spark.createDataFrame(sorted(got), "a bigint, b bigint")).collect()}
    assert all(root.get(a, a) == root.get(b, b) for a, b in want)


def test_deduplicated(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(900)]
    base = [" ".join(rng.sample(words, 200)) for _ in range(6)]
    near = base[0].replace(base[0].split()[100], "changed")
    rows = [(10, base[0], "x"), (11, near, "x"), (12, base[0], "x"), (12, base[0], "x"), (5, base[1], None), (6, base[2], "y"), (None, base[1], "z"), (20, None, "n"), (21, "", "n")]
    for clash in ("lang", "__key", "key"):
        got = simhash.deduplicated(spark.createDataFrame(rows, f"doc_id bigint, text string, {clash} string"))
        assert sorted(r.doc_id for r in got.collect()) == [5, 6, 10, 20] and got.columns == ["doc_id", "text", clash]
    assert simhash.deduplicated(got.limit(0)).count() == 0


def edited(rng, n=12):
    """Texts of 40 to 300 words with cut, extended and changed copies, beside a stretch that many texts share."""
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)]
    notice, texts = rng.sample(words, 30), []
    for _ in range(n):
        base = rng.sample(words, rng.randrange(40, 300))
        m = len(base)
        texts += [base, base[: m * 83 // 100], base[m // 10 :], base + rng.sample(words, m // 5), rng.sample(words, m // 10) + base]
        texts.append([w if rng.random() > 0.02 else rng.choice(words) for w in base])
    texts += [rng.sample(words, 8) + notice + rng.sample(words, k % 9) for k in range(40)] + [notice, notice[:28], ["one"], []]
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("hot, sample", [(32, 16), (2, 1)])
def test_text_groups_misses_no_pair(spark, monkeypatch, hot, sample):
    texts = edited(random.Random(5))
    sets = [set(simhash.shingles(t, 5)) for t in texts]
    want = {k: k for k in range(len(texts))}
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and want[i] != want[j]:
                a, b = want[i], want[j]
                want = {k: b if v == a else v for k, v in want.items()}
    monkeypatch.setattr(simhash, "SAMPLE", sample)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    numbered = simhash.text_numbers(df)
    keys = {r.doc_id: r.key for r in numbered(df, "key").collect()}
    roots = {r.key: r.root for r in simhash.text_groups(df, numbered, hot=hot).collect()}
    got = [roots.get(keys[k], keys[k]) for k in range(len(texts))]
    assert len(set(zip(got, want.values()))) == len(set(got)) == len(set(want.values())) < len(texts) - 30


def test_top_k(spark):
    rng = np.random.default_rng(1)
    data = [(k, [float(x) for x in rng.integers(-3, 4, 5) / 7]) for k in range(60)] + [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5), (300, [0.0] * 5), (301, []), (None, [1.0] * 5)]
    data += [(20, data[20][1]), (20, [1.0] * 5), (7, data[7][1])]  # repeated ids, alike and not
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    good = [(k, [int(np.floor(1024 * x)) for x in v]) for k, v in data if k is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, (q, w) in enumerate(good):
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(w, v)), k) for j, (k, v) in enumerate(good) if j != i)[:7]
            want += [(q, n + 1, k, -s) for n, (s, k) in enumerate(best)]
    for chunk, block, parts in ((1000, 500, 1), (9, 1, 1), (4, 20, 5)):
        got = threshold_topk.top_k(df.repartition(parts), k=7, queries="vec_id % 20 = 0", chunk=chunk, block=block)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert threshold_topk.top_k(df.limit(0)).count() == 0


def test_shards(spark):
    rows = [(k, "t" * (k % 50), ["a", "b", None, "c"][min(k % 7, 3)]) for k in range(1003)] + [(1, "t", "b")] * 3 + [(None, None, "a")]
    for per in (20_000, 25):
        out = sharding.sharded(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), rows=per).collect()
        sizes = Counter(r["shard"] for r in out)
        assert len(out) == len(rows) and set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
        for s in range(40):
            assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
        source = {k: s for k, _, s in rows}
        share = Counter(r["shard"] for r in out if source.get(r.doc_id) == "c")
        assert max(share.values()) - min(share.values()) <= 2
        one = next(r for r in out if r.doc_id == 49)
        assert (one["size"], one.text_crc32, one.law, one.grown_shard) == (16 + 49, zlib.crc32(b"t" * 49), "rows", None)
    assert sharding.sharded(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0


@pytest.mark.parametrize("per", [20_000, 40])
def test_shards_equal_one_sort_of_all_rows(spark, per):
    rows = [(k, "t" * (k * 7 % 31), ["a", "b", None, "c"][min(k % 9, 3)]) for k in range(911)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    md5 = lambda *parts: hashlib.md5(":".join(map(str, (sharding.SEED, *parts))).encode()).hexdigest()
    order = []
    for s in {r[2] for r in rows}:
        name = "-" if s is None else "+" + s
        own = sorted((int(md5(k, t)[:15], 16), k) for k, t, source in rows if source == s)
        order += [((k + 0.5) / len(own), md5(name), name, k, doc_id) for k, (_, doc_id) in enumerate(own)]
    want, n, first = {}, len(rows), {}
    for place, (*_, doc_id) in enumerate(sorted(order)):
        shard = place * 40 // n
        want[doc_id] = (shard, place - first.setdefault(shard, place))
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.sharded(df, rows=per).collect()} == want


def test_url_filter(spark):
    link = '<html><link href="http://a.example.net/zz" rel="canonical"></html>'
    jump = "<meta content='0; url=/next' http-equiv='refresh'>"
    rows = [
        (1, "http://X.Example.NET/en/1?q#f", None), (2, "http://example.net/fr/", None), (3, "http://site.org/fr/x", link), (4, "http://site.org/de/x", link), (5, "https://q.org/start", jump), (6, "https://q.org/next", link),
        (7, None, link), (8, "no scheme", None), (9, "http://www.example.com/de/#x", ""), (10, "http://example.net", None), (11, "https://q.org/other", "<p>"), (4, "http://site.org/de/x", link),
    ]
    out = url_filter.judged(spark.createDataFrame(rows, "page_id bigint, url string, html string"), URL_RULES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert out.count() == len(rows)
    assert got == {
        1: ("x.example.net", "/en/1", "example.net/en/", "allow"), 2: ("example.net", "/fr/", "net/", "block"), 3: ("site.org", "/fr/x", "org/fr/", "allow"), 4: ("site.org", "/de/x", None, "block"),
        5: ("q.org", "/start", None, "block"), 6: ("q.org", "/next", None, "block"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("www.example.com", "/de/", "example.com/de/", "block"),
        10: ("example.net", "", None, "allow"), 11: ("q.org", "/other", None, "allow"),
    }


def test_url_sql_says_the_same(spark):
    import duckdb
    import pandas as pd

    link, jump = '<html><LINK href="http://a.Example.net/zz" rel="canonical"></html>', "<meta content='0; url=/next' http-equiv='refresh'>"
    more = lambda target: f"<link rel=canonical href={target}>"
    relative = [(20, "http://a.org/x/y/z.html", more("../w.html")), (21, "http://a.org/x/w.html", more("//a.example.com/de/")), (22, "http://b.org/x/y", more("?q=1")), (23, "http://b.org/x/y?q=1", more("./z")),
        (24, "http://b.org/x/z", more("http://c.net/")), (25, "http://c.org", more("page.html")), (26, "http://c.org/page.html", more("../../d")), (27, "http://c.org/d", more("http://c.net/1")), (28, "http://e.org/", more("mailto:x@c.net"))]
    rows = [(3, "http://site.org/fr/x", link), (4, "http://site.org/de/x", link), (5, "https://Q.org/start", jump), (6, "https://q.org/next", link), (7, None, link), (8, "no scheme", link), (9, "http://example.net", None)] + relative
    pages = pd.DataFrame(rows, columns=["page_id", "url", "html"])
    con = duckdb.connect()
    con.register("pages", pages)
    want = con.execute(entry.oracle_sql()["op4_url_filter"]).fetchall()
    own = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"__node": F.lit(1), "component": F.lit(2)})
    out = url_filter.judged(own, URL_RULES).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert {r.page_id for r in out.where("verdict = 'block'").collect()} >= {20, 21, 22, 23, 24, 25, 26, 27} and not out.where("page_id = 28 and verdict = 'block'").count()


def test_decontamination(spark):
    rng = random.Random(11)
    words = ["w%d" % k for k in range(400)]
    items = [(1, " ".join(rng.sample(words, 40))), (2, " ".join(rng.sample(words, 30))), (3, "Only Three words"), (4, None), (5, "")]
    one = items[0][1].split()
    filler = lambda: " ".join(rng.choice(words) for _ in range(80))
    edited = [*one[:20], "changed", *one[21:]]
    rows = [(1, filler()), (2, filler() + " " + items[0][1].upper() + ". " + filler()), (3, " ".join(edited)), (4, " ".join(one[:20])), (5, items[1][1]), (6, "see only, three words!"), (7, None), (8, ""), (2, "dup"), (9, items[1][1] + "\n" + items[1][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit("clash")).withColumn("key", F.lit("clash"))
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.start, round(r.similarity, 3)) for r in decontamination.contaminated(docs, asked).collect()}
    # a changed word changes 5 of 36 shingles: 31 / 41 is under 0.8
    assert got == {(2, 1): (80, 1.0), (5, 2): (0, 1.0), (6, 3): (1, 1.0), (9, 2): (0, 1.0)}
    assert sorted(r.doc_id for r in decontamination.decontaminated(docs, asked).collect()) == [1, 2, 3, 4, 7, 8]
    assert decontamination.contaminated(docs.limit(0), asked).count() == decontamination.contaminated(docs, asked.limit(0)).count() == 0


def test_documents_shorter_than_an_item(spark):
    asked = spark.read.parquet(SF + "/benchmark.parquet").select("item_id", "text")
    cut_of = lambda w: {"first": w[1:], "end": w[: len(w) - max(1, len(w) // 20)], "half": w[: len(w) // 2], "middle": w[: len(w) // 2] + w[len(w) // 2 + 1 :]}
    items = {r.item_id: r.w for r in asked.select("item_id", decontamination.words_of(F.col("text")).alias("w")).collect()}
    rows, held = [], {}
    for item, words in items.items():
        for kind, cut in cut_of(words).items():
            rows.append((f"{kind} {item}", " ".join(cut)))
            p, q = (Counter(zip(*(w[k:] for k in range(5)))) for w in (words, cut))
            held[rows[-1][0]] = (p & q).total() / max((p | q).total(), 1)
    want = {(name, int(name.split()[1])): s for name, s in held.items() if s >= 0.8}
    assert {name.split()[0] for name, _ in want} == {"first", "end", "middle"}
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = decontamination.contaminated(docs, asked).collect()
    got = {(r.doc_id, r.item_id): (r.start, r.similarity) for r in found if int(r.doc_id.split()[1]) == r.item_id}
    assert got == {k: (0, round(s, 6)) for k, s in want.items()}
    assert decontamination.decontaminated(docs, asked).count() == len(rows) - len({r.doc_id for r in found})


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(21)
    words = ["w%d" % k for k in range(60)]
    items = [[rng.choice(words) for _ in range(n)] for n in (5, 6, 9, 14, 20, 33, 47)] + [["solo"], ["two", "words"]]

    def edited(item):
        out = list(item)
        for _ in range(rng.randrange(0, 3)):
            k = rng.randrange(max(1, len(out)))
            out[k : k + 1] = rng.choice([[], [rng.choice(words)], [*out[k : k + 1], rng.choice(words)]])
        return out

    texts = [[rng.choice(words) for _ in range(rng.randrange(0, 60))] for _ in range(20)]
    for _ in range(60):
        texts.append([rng.choice(words) for _ in range(rng.randrange(0, 30))] + edited(rng.choice(items)) + [rng.choice(words) for _ in range(rng.randrange(0, 30))])
    shingles = lambda w, m: [tuple(w[k : k + min(5, m)]) for k in range(len(w) - min(5, m) + 1)]
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            own, asked = shingles(text, len(item)), Counter(shingles(item, len(item)))
            n = asked.total()
            for start in range(max(1, len(own) - n + 1)):
                there = Counter(own[start : start + n])
                similarity = (there & asked).total() / max(1, (there | asked).total())
                if similarity >= 0.8 and similarity > want.get((d, i), (0, 0))[1]:
                    want[d, i] = (start, similarity)
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id bigint, text string")
    got = decontamination.contaminated(docs, spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id): (r.start, r.similarity) for r in got.collect()} == {k: (s, round(x, 6)) for k, (s, x) in want.items()} and len(want) > 20


def test_recall_at_the_threshold(spark):
    """Items of every length with edits that leave a similarity of just over 0.8: nearly all are within the radius."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(5))
    items, docs, wanted = [], [], set()
    for k in range(240):
        words = [word() for _ in range(rng.randrange(30, 90))]
        most = (len(words) - 4) // 9  # so many shingles may be foreign
        cut = words[most:] + [word() for _ in range(most)]
        sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words, cut)]
        if len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1]):
            wanted.add((k, k))
        items.append((k, " ".join(words)))
        docs.append((k, " ".join([word() for _ in range(9)] + cut + [word() for _ in range(9)])))
    held = decontamination.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.doc_id, r.item_id) for r in held.collect()}
    assert len(wanted) > 150 and len(got & wanted) >= 0.99 * len(wanted)


def test_weighted_similarity(spark):
    row = spark.createDataFrame([([1, 1, 2, 3], [1, 2, 2, 3])], "a array<bigint>, b array<bigint>")
    assert row.select(decontamination.similarity("a", "b").alias("s")).first().s == 3 / 5


def test_toxicity(spark):
    docs, labels = spark.read.parquet(SF + "/documents.parquet"), spark.read.parquet(SF + "/labels.parquet")
    rng = random.Random(1)
    mild = lambda n: [rng.choice(["fine", "day", "the", "good", "rain", "in", "town", "they", "walk"]) for _ in range(n)]

    def harsh(n):
        words = mild(n)
        words[rng.randrange(n)] = "moron"
        return " ".join(words)

    net = toxicity.trained([" ".join(mild(50)) for _ in range(150)] + [harsh(50) for _ in range(150)], [0] * 150 + [1] * 150, steps=200)
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "!!!", "x"), (4, " ".join(mild(4000)) + " Moron!", "x"), (5, " ".join(mild(90)), "x")], "doc_id bigint, text string, score string")
    got = {r.doc_id: r.score for r in toxicity.scored(odd, net).collect()}
    assert got[1] == got[2] == got[3] == 0 and got[4] > 0.5 > got[5]
    assert toxicity.learned(docs, labels.limit(0)) is None
    assert {r.score for r in toxicity.scored(odd, None).collect()} == {0.0}
    assert toxicity.scored(odd.limit(0), net).count() == 0


def test_gradients():
    net, rng = toxicity.Network(1), np.random.default_rng(2)
    x = rng.normal(size=(9, toxicity.INPUTS)).astype(np.float32)
    index = np.full((3, toxicity.WINDOW + 2 * toxicity.CONTEXT), -1)
    at = toxicity.CONTEXT
    index[0, at : at + 4], index[1, at - 2 : at + 1], index[2, at : at + 2] = [0, 1, 2, 3], [4, 5, 6], [7, 8]
    index[0, at + toxicity.WINDOW :][:2], index[2, :2] = [5, 6], [1, 3]
    y, w = np.array([1.0, 0.0, 1.0]), np.ones(3)
    loss = lambda: float(np.sum(np.logaddexp(0, z := net.forward(x, index)[0].astype(float)) - y * z))  # noqa: E731, F821
    g, d_x = net.gradients(x, index, y, w)
    for name in ("wx", "wh", "b", "att", "v", "out", "bias"):
        p, k = net.p[name], tuple(rng.integers(s) for s in net.p[name].shape)
        old = p[k]
        p[k] = old + 1e-2
        up = loss()
        p[k] = old - 1e-2
        down = loss()
        p[k] = old
        assert abs((up - down) / 2e-2 - g[name][k]) < 2e-3, name


def test_toxicity_of_a_text_word_by_word():
    """All windows of a text, each state read on its own from its block's context on."""
    net, rng = toxicity.Network(3), np.random.default_rng(1)
    net.p["out"] *= 4
    for size in (1, 31, 32, 33, 150):
        text = " ".join(rng.choice(["one", "Two", "threes", "four's", "é"], size)).encode()
        words, begins, grams, gram_start, first = toxicity.inputs(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        x, p, h = net.vectors(words, begins, grams, gram_start).astype(float), net.p, toxicity.HIDDEN
        n = len(x)
        one = lambda v: 1 / (1 + np.exp(-v))
        states = np.zeros((n, 2 * h))
        for word in range(n):
            block = word // toxicity.BLOCK * toxicity.BLOCK
            ahead = range(max(0, block - toxicity.CONTEXT), word + 1)
            back = range(min(n, block + toxicity.BLOCK + toxicity.CONTEXT) - 1, word - 1, -1)
            for d, way in ((0, ahead), (1, back)):
                state = np.zeros(h)
                for k in way:
                    a, u = x[k] @ p["wx"][d] + p["b"][d][0], state @ p["wh"][d]
                    z, r = one(a[:h] + u[:h]), one(a[h : 2 * h] + u[h : 2 * h])
                    state = z * state + (1 - z) * np.tanh(a[2 * h :] + r * u[2 * h :])
                states[word, d * h : (d + 1) * h] = state
        logits = []
        for start in range(max(1, n - toxicity.WINDOW + 1)):
            own = states[start : start + toxicity.WINDOW]
            weight = np.exp(np.tanh(own @ p["att"]) @ p["v"])
            logits.append(weight / weight.sum() @ own @ p["out"] + p["bias"][0])
        assert abs(toxicity.text_scores(net, np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0] - one(max(logits))) < 1e-5
        assert len(net.window_logits(net.states(x.astype(np.float32), first), first)[0]) == len(logits)


def test_language_of_a_text_by_its_subwords():
    """The average of the scores of all n-grams, blanks around words included."""
    model = language_id.trained(["the house and the garden"] * 30 + ["das haus und der garten"] * 30, ["en"] * 30 + ["de"] * 30, steps=500)
    for text in ("The garden, 9 das", "é", "ab", "x" * 300):
        data = text.encode()
        rows, chars = [], [" ", *(chr(b).lower() if b < 128 else chr(b) for b in data), " "]
        letter = [len(c) == 1 and (c.isalpha() if ord(c) < 128 else True) for c in chars]
        plain = [ord(c) if ok else 32 for c, ok in zip(chars, letter)]
        for size in language_id.GRAMS:
            for k in range(len(plain) - size + 1):
                if all(letter[k + 1 : k + size - 1]):
                    code = plain[k]
                    for c in plain[k + 1 : k + size]:
                        code = (code * 0x01000193 + c) % (1 << 32)
                    rows.append(((code ^ size) * 0x9E3779B1) % (1 << 32) >> (32 - language_id.ROWS.bit_length() + 1))
        logits = (sum(model.table[r].astype(float) for r in rows) / max(1, len(rows)) + model.bias) / model.temperature
        want = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        got = language_id.text_probabilities(model, np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
        assert np.allclose(got, want, atol=1e-4), text


def test_columns_that_differ_in_case_only(spark):
    docs = spark.createDataFrame([(1, "a b c", 7)], "doc_id bigint, text string, x int")
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    cases = {
        "Score": lambda df: toxicity.scored(df, None).select("score"), "LANG_pred": lambda df: language_id.identified(df, None).select("lang_pred"), "N_Tokens": lambda df: bpe_automaton.tokenized(df, path).select("n_tokens"),
        "N_words": lambda df: recompression.without_repeats(df).select("n_words"), "N_Bytes": lambda df: suffix_dedup.without_repeats(df).select("n_bytes"), "FP": lambda df: simhash.fingerprints(df).select("fp"),
        "Verdict": lambda df: url_filter.judged(df.withColumnRenamed("text", "url").withColumn("html", F.lit("")), URL_RULES).select("verdict"), "__KEY": lambda df: simhash.deduplicated(df).select("__KEY"),
    }
    for name, made in cases.items():
        assert len(made(docs.withColumnRenamed("x", name)).collect()) == 1, name


def test_rows_are_told_apart_by_nulls_and_when_hashes_meet(spark):
    text = "one two three four five six"
    for rows in ([("x", None), (None, "x")], [(None, text), ("b", text), (text, None)]):
        docs = spark.createDataFrame(rows, "doc_id string, text string")
        assert docs.select(row_key()).distinct().count() == len(rows)
        assert sorted(r.n_words for r in recompression.without_repeats(docs, 3).collect()) == sorted(len((t or "").split()) for _, t in rows)
        assert sorted(r.n_bytes for r in suffix_dedup.without_repeats(docs, 20).collect()) == sorted(len(t or "") for _, t in rows)
    docs = spark.range(40).selectExpr("cast(id as string) as doc_id", "concat('t', id % 7) as text", "1 as __mark")
    numbered = numbering(docs, row_key(), narrow=F.col("doc_id").cast("long") % 5)
    got = numbered(docs, "row")
    assert got.columns == [*docs.columns, "row"] and got.select("row").distinct().count() == 40 == got.count()


def test_language(spark):
    out = entry.queries()["op8_language_id"](spark, SF).join(spark.read.parquet(SF + "/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.9
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "the house " * 5000)], "doc_id bigint, text string")
    model = language_id.trained(["the house and the garden"] * 30 + ["das haus und der garten"] * 30, ["en"] * 30 + ["de"] * 30)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identified(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en"
    assert {r.lang_pred for r in language_id.identified(odd, None).collect()} == {"und"}


def test_pipeline(spark, monkeypatch):
    """Every stage against what brute force leaves of its predecessor's rows."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(SF + "/documents.parquet")
    marked = docs.where("text is not null").join(spark.read.parquet(SF + "/labels.parquet"), "doc_id").collect()
    net = toxicity.trained([r.text for r in marked], [r.toxic for r in marked], steps=60)
    monkeypatch.setattr(toxicity, "learned", lambda *a: net)
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: {r.doc_id: r.text or "" for r in df.collect()}
    harmless = stages["toxicity"](spark, docs, SF).cache()
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, net).collect()}
    assert harmless.columns == docs.columns and rows(harmless) == {k: t for k, t in rows(docs).items() if scores[k] < 0.5}
    alone = stages["simhash_near_dedup"](spark, harmless, SF).cache()
    before = sorted(rows(harmless).items())
    sets, root = [set(simhash.shingles(t, 5)) for _, t in before], list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if root[i] != root[j] and (before[i][1] == before[j][1] or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert rows(alone) == {before[k][0]: before[k][1] for k in set(root)}
    cut = stages["suffix_array_dedup"](spark, alone, SF).cache()
    assert cut.columns == docs.columns and set(rows(cut)) == set(rows(alone))
    windows = Counter(t[k : k + 250] for t in (x.encode() for x in rows(alone).values()) for k in range(len(t) - 249))
    spans = lambda t: [(k, k + 250) for k in range(len(t) - 249) if windows[t[k : k + 250]] > 1]

    def words(t):
        found = list(re.finditer(rb"[^\x20\x09-\x0D]+", t))
        return [(a.start(), b.end()) for a, b in zip(found, found[50:]) if b.end() - a.start() < 250]

    short = Counter(t[a:b] for t in (x.encode() for x in rows(alone).values()) for a, b in words(t))
    left = rows(cut)
    for key, text in rows(alone).items():
        body = text.encode()
        gone = bytearray(len(body))
        for a, b in spans(body) + [(a, b) for a, b in words(body) if short[body[a:b]] > 1]:
            gone[a:b] = b"\1" * (b - a)
        assert left[key] == bytes(x for x, g in zip(body, gone) if not g).decode("utf-8", "ignore")
    kept = stages["benchmark_decontamination"](spark, cut, SF)
    held = {r.doc_id for r in decontamination.contaminated(cut, spark.read.parquet(SF + "/benchmark.parquet")).collect()}
    assert rows(kept) == {k: t for k, t in rows(cut).items() if k not in held}
    tokens = stages["bpe_tokens"](spark, kept, SF)
    assert set(docs.columns) < set(tokens.columns)
    tokens = tokens.collect()
    assert {r.doc_id for r in tokens} == set(rows(kept)) and all(r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in tokens)


def test_toxicity_of_rows_held_out(spark):
    """Most toxic rows that were not learned from are caught, and hardly a clean one is."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(folder + "/documents.parquet"), spark.read.parquet(folder + "/labels.parquet")
    net = toxicity.learned(docs, labels)
    out = toxicity.scored(docs.join(labels.where(toxicity.held_out()).select("doc_id", "toxic"), "doc_id"), net).select("toxic", (F.col("score") >= 0.5).alias("caught")).collect()
    share = lambda kind: np.mean([r.caught for r in out if r.toxic == kind])
    assert len(out) > 500 and share(1) > 0.85 and share(0) < 0.04


def test_stages_hand_texts_to_python_in_small_batches(spark):
    """A stage asks for small batches of rows, wherever the user has not set their size; its result is the same in small pieces."""
    import pyarrow as pa

    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    line = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(k, f"{line} {k} " + f"own{k} " * 60_000 + line, "en", "s", 1) for k in range(30)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "2m")
        corpus_pipeline.keep_one_of_copies(spark, docs.limit(0), "")
        assert spark.conf.get(name) == "2m"
        spark.conf.unset(name)
        cut = corpus_pipeline.cut_repeats(spark, docs, "")
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
        assert sizes.agg(F.max("n")).first()[0] < 6_000_000 < sizes.agg(F.sum("n")).first()[0]
        assert all(line not in r.text for r in cut.select("text").collect())
    finally:
        spark.conf.set(name, before)
