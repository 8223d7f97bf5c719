"""The queries op1 to op13, each over its whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe_automaton, decontamination, language_id, merkle, posting_lists, recompression, repair, sharding, simhash, suffix_dedup, threshold_topk, toxicity, url_filter
from .shared import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe_automaton.tokenized(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op1_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return recompression.without_repeats(docs, size=35).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    out = toxicity.scored(docs, net).withColumn("held_out", held_out())
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op6_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return threshold_topk.top_k(vectors, k=10, queries="vec_id % 100 = 0", scale=1024)


def op7_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.without_repeats(docs, size=400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.learned(docs)
    out = language_id.identified(docs.select("doc_id", "text"), model).withColumn("held_out", held_out())
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")


#: The rules of op4 (fixed values).
URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op9_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), size=3, radius=2)


def op11_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=20, queries="vec_id % 20 = 0")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(repair.damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda text: merkle.leaf_hash(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf(lower))
    out = merkle.manifest(docs, leaf(F.col("text")), carry={"doc_id": F.col("doc_id"), "changed": changed})
    out = out.withColumn("folded_root", merkle.folded(F.coalesce("changed", "leaf"), F.col("path"))).withColumn("proof_sha256", merkle.proof_hash(F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_recompression": op1_recompression, "op2_decontamination": op2_decontamination, "op3_toxicity": op3_toxicity, "op4_url_filter": op4_url_filter, "op5_stratified_shards": op5_stratified_shards, "op6_threshold_topk": op6_threshold_topk, "op7_deep_shallow": op7_deep_shallow, "op8_language_id": op8_language_id, "op9_simhash_variants": op9_simhash_variants, "op10_bpe_automaton": op10_bpe_automaton, "op11_posting_lists": op11_posting_lists, "op12_conversation_repair": op12_conversation_repair, "op13_merkle_manifest": op13_merkle_manifest}


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a string expression's UTF-8 bytes."""
    table = "list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    byte = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])"
    return f"(SELECT xor(list_reduce(list_prepend(4294967295, {byte}), {step}), 4294967295) FROM (SELECT {table} AS t))"


def _field(column: str) -> str:
    return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || CAST({column} AS VARCHAR), '-')"


def _tree(name: str, leaves: str) -> str:
    """Nodes of the trees of `leaves` (tree, nth, h, n), and what stands beside each: l before and r behind it in its run."""
    return f"""{name} AS (SELECT tree, 0 AS level, nth, h, n FROM {leaves} UNION ALL SELECT tree, level + 1, nth // 8, sha256(string_agg(h, '' ORDER BY nth)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY tree, level, nth // 8, n),
{name}_beside AS (SELECT a.tree, a.level, a.nth, coalesce(string_agg(b.h, '' ORDER BY b.nth) FILTER (b.nth < a.nth), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.nth) FILTER (b.nth > a.nth), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.nth // 8 = b.nth // 8 WHERE a.n > 1 GROUP BY 1, 2, 3),
{name}_path AS (SELECT f.tree, f.nth, list({{'l': l, 'r': r, 'h': ''}} ORDER BY level) FILTER (l IS NOT NULL) AS path FROM {leaves} f LEFT JOIN {name}_beside s ON s.tree = f.tree AND s.nth = f.nth // CAST(pow(8, s.level) AS BIGINT) GROUP BY 1, 2)"""


MERKLE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('+' || lang, '') AS tree, sha256({"||".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
  CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({"||".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS changed FROM documents),
f AS MATERIALIZED (SELECT *, leaf AS h, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth, count(*) OVER (PARTITION BY tree) AS n FROM d),
{_tree("t", "f")},
g AS MATERIALIZED (SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS nth, count(*) OVER () AS n FROM t WHERE n = 1),
{_tree("u", "g")},
p AS (SELECT f.doc_id, f.leaf, f.changed, g.h AS subroot, (SELECT h FROM u WHERE n = 1) AS root, list_concat(coalesce(t_path.path, []), coalesce(u_path.path, [])) AS path
  FROM f JOIN t_path ON f.tree = t_path.tree AND f.nth = t_path.nth JOIN g ON g.name = f.tree JOIN u_path ON u_path.nth = g.nth),
o AS (SELECT *, list_reduce(list_prepend({{'l': '', 'r': '', 'h': coalesce(changed, leaf)}}, path), lambda x, y: {{'l': '', 'r': '', 'h': sha256(y.l || x.h || y.r)}}).h AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda x: x.l || x.r)), 'string_agg', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM o
"""

SHARDS_SQL = f"""
WITH b AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 16 AS BIGINT) AS size, CAST({crc32_sql("coalesce(text, '')")} AS BIGINT) AS text_crc32, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS stratum,
  CAST('0x' || substr(md5('{sharding.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id, text_crc32, size) AS rank, count(*) OVER (PARTITION BY stratum) AS n FROM b),
p AS (SELECT *, row_number() OVER (ORDER BY (CAST(rank AS DOUBLE) - 0.5) / n, md5('{sharding.SEED}:' || stratum), stratum, rank) - 1 AS place, count(*) OVER () AS total FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 40 // total AS INTEGER) AS shard, place - (place * 40 // total * total + 39) // 40 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p
"""

_AFTER, _ROLE = "CASE {q} WHEN 2 THEN 3 ELSE 2 END", "CASE {q} WHEN 2 THEN 'assistant:' ELSE 'user:' END"
_NEXT, _NAME = _AFTER.format(q="q"), _ROLE.format(q="q")
#: A row at a time: of all edits that lead to a state, the cheapest, of equals the ASCII-least; then up to two insertions.
REPAIR_SQL = f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
m AS (SELECT *, {crc32_sql("k")} % 20 AS m FROM c),
d AS (SELECT conv_id, turn, CASE m WHEN 4 THEN 'user' ELSE role END AS role, CASE m WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE m WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM m WHERE m <> 0),
g AS MATERIALIZED (SELECT conv_id, row_number() OVER () AS gid FROM (SELECT DISTINCT conv_id FROM conversations)),
e AS (SELECT gid, turn, role, text, row_number() OVER (PARTITION BY gid ORDER BY turn NULLS FIRST, role, md5(octet_length(encode(role)) || ':' || role || text), copy) - 1 AS i,
  row_number() OVER (PARTITION BY gid, role, text ORDER BY turn NULLS FIRST, copy) AS nth, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM d JOIN g ON d.conv_id IS NOT DISTINCT FROM g.conv_id),
f AS MATERIALIZED (SELECT gid, i, turn, role, text, left(role, 1) AS ini, CASE WHEN last = '' THEN 1 WHEN nth > 1 THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM e),
s AS (SELECT gid, 0 AS i, q, cost, audit, turns FROM g, (VALUES (0, 0, '', []::VARCHAR[]), (2, 3, 'I', ['user:']), (3, 6, 'II', ['user:', 'assistant:'])) v(q, cost, audit, turns)
UNION ALL
SELECT gid, i, q, min(cost), first(audit ORDER BY cost, audit), first(turns ORDER BY cost, audit) FROM (
  SELECT gid, i, z.q AS q, cost + z.c AS cost, audit || z.a AS audit, list_concat(turns, z.o) AS turns FROM (
    SELECT gid, i, cost, audit, turns, unnest([{{'q': q, 'c': 0, 'a': '', 'o': []::VARCHAR[]}}, {{'q': {_NEXT}, 'c': 3, 'a': 'I', 'o': [{_NAME}]}}, {{'q': {_AFTER.format(q="(" + _NEXT + ")")}, 'c': 6, 'a': 'II', 'o': [{_NAME}, {_ROLE.format(q="(" + _NEXT + ")")}]}}]) AS z FROM (
      SELECT gid, i, y.q AS q, cost + y.c AS cost, audit || y.a AS audit, list_concat(turns, y.o) AS turns FROM (
        SELECT s.gid, s.i + 1 AS i, cost, audit, turns, unnest([
          {{'q': q, 'c': 4, 'a': 'D', 'o': []::VARCHAR[]}},
          {{'q': CASE WHEN fault IN (1, 2) THEN -1 WHEN ini = 's' AND q = 0 THEN 1 WHEN ini = 'u' AND q <> 2 THEN 2 WHEN ini = 'a' AND q = 2 THEN 3 ELSE -1 END, 'c': CASE fault WHEN 3 THEN 3 ELSE 0 END, 'a': 'K', 'o': [role || ':' || text]}},
          {{'q': CASE WHEN fault IN (1, 2) THEN -1 ELSE {_NEXT} END, 'c': CASE fault WHEN 3 THEN 6 ELSE 3 END, 'a': 'R', 'o': [{_NAME} || text]}}]) AS y
        FROM s JOIN f ON s.gid = f.gid AND s.i = f.i) WHERE y.q >= 0))) GROUP BY gid, i, q),
n AS (SELECT gid, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated FROM f GROUP BY 1),
b AS (SELECT a.gid, count(*) AS illegal FROM f a JOIN f b ON a.gid = b.gid AND a.i + 1 = b.i WHERE a.ini || b.ini NOT IN ('su', 'ua', 'au') GROUP BY 1),
r AS (SELECT s.gid, min(cost) AS cost, first(audit ORDER BY cost, audit) AS audit, first(turns ORDER BY cost, audit) AS turns FROM s LEFT JOIN n USING (gid) WHERE s.i = coalesce(n, 0) AND q IN (0, 3) GROUP BY 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit,
  sha256(array_to_string(turns, chr(10))) AS repaired_sha256 FROM g JOIN r USING (gid) LEFT JOIN n USING (gid) LEFT JOIN b USING (gid)
"""

TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), e AS MATERIALIZED (SELECT own, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
s AS (
  SELECT a.own AS query, b.own, any_value(a.vec_id) AS query_id, any_value(b.vec_id) AS vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.i = b.i AND a.own <> b.own WHERE a.vec_id % 100 = 0 GROUP BY 1, 2
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


URL_SQL = r"""
WITH RECURSIVE p AS (SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
t AS (SELECT url, host, path, regexp_replace(unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>', 0)), '\s+', ' ', 'g') AS tag FROM q WHERE url IS NOT NULL AND strpos(url, '://') > 0),
f AS (SELECT url, host, path, substr(url, 1, strpos(url, '://') - 1) AS scheme, coalesce(
    nullif(CASE WHEN regexp_matches(tag, '(?i)\brel ?= ?["'']?canonical\b') THEN regexp_extract(tag, '(?i)\bhref ?= ?["'']?([^"'' >]+)', 1) END, ''),
    nullif(CASE WHEN regexp_matches(tag, '(?i)http-equiv ?= ?["'']?refresh\b') THEN regexp_extract(tag, '(?i)\burl ?= ?["'']?([^"'' >]+)', 1) END, '')) AS target FROM t),
h AS (SELECT *, regexp_extract(target, '^(?:\.\.?/)*', 0) AS ups FROM f),
i AS (SELECT *, scheme || '://' || host AS site, regexp_replace(regexp_replace(path, '[^/]*$', ''), '(?:[^/]+/){0,' || least((length(ups) - length(replace(ups, '../', ''))) // 3, 999) || '}$', '') AS above FROM h),
g AS (SELECT url AS a, CASE WHEN starts_with(target, '//') THEN scheme || ':' || target WHEN starts_with(target, '/') THEN site || target WHEN starts_with(target, '?') THEN site || path || target
    WHEN regexp_matches(target, '^[^/?#]*://') THEN target WHEN regexp_matches(target, '^([A-Za-z][A-Za-z0-9+.-]*:|#)') THEN NULL
    ELSE site || CASE WHEN above = '' THEN '/' ELSE above END || substr(target, length(ups) + 1) END AS b FROM i),
e AS (SELECT DISTINCT translate(regexp_extract(a, '(?s)^(.*?://[^/?#]*)([^#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(a, '(?s)^(.*?://[^/?#]*)([^#]*)', 2) AS a,
    translate(regexp_extract(b, '(?s)^(.*?://[^/?#]*)([^#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(b, '(?s)^(.*?://[^/?#]*)([^#]*)', 2) AS b FROM g WHERE b IS NOT NULL),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
n AS (SELECT a, regexp_extract(a, '://([^/?#]*)', 1) AS host, regexp_extract(a, '://[^/?#]*([^?#]*)', 1) AS path FROM (SELECT DISTINCT a FROM u)),
r AS (SELECT a FROM n WHERE RULE IN ('net/', 'example.com/de/') UNION SELECT u.b FROM r JOIN u ON u.a = r.a),
w AS (SELECT page_id, host, path, RULE AS rule, translate(regexp_extract(url, '(?s)^(.*?://[^/?#]*)([^#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(url, '(?s)^(.*?://[^/?#]*)([^#]*)', 2) AS node FROM q)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN node IN (SELECT a FROM r) THEN 'block' ELSE 'allow' END AS verdict FROM w
""".replace("RULE", """CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END""")


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": URL_SQL, "op5_stratified_shards": SHARDS_SQL, "op6_threshold_topk": TOP_K_SQL, "op12_conversation_repair": REPAIR_SQL, "op13_merkle_manifest": MERKLE_SQL}
