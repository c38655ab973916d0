"""Registered queries of this subpackage and, where SQL can express the whole
result, their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import (decontaminate, language_id, line_dedup, merkle, mixing, near_dedup, packing, quality, spelling,
                           substring_dedup, topk, toxicity, url_filter)
from claimflow.llm.common import crc_mod, held_out, read
from claimflow.llm.labelled import labelled_sample

#: The URL rules, as (action, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _judged(scores: DataFrame, n: int, rest: int) -> DataFrame:
    more = [c for c in scores.columns if c not in ("doc_id", "score")]
    return scores.select("doc_id", held_out("doc_id", n, rest).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), *more)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    sample = labelled_sample(docs, read(spark, sf_dir, "labels"), "toxic", ~held_out("doc_id", 5, 0))
    return _judged(toxicity.score(docs, toxicity.learn(*sample)), 5, 0)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    net = language_id.fit(docs, ~held_out("doc_id", 5, 0))
    return language_id.predict(docs, net).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    sample = labelled_sample(docs, read(spark, sf_dir, "labels"), "quality", ~held_out("doc_id", 3, 1))
    return _judged(quality.score(docs, quality.train(*sample)), 3, 1)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate_substrings(read(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    cut = F.coalesce(crc_mod("doc_id", 2) == 0, F.lit(False)) & F.contains("text", F.lit("\n"))
    seen = {"text": F.when(cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    return merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], seen=seen)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.occurrences(read(spark, sf_dir, "documents"), slip=31)
    return spelling.variants(words, least_count=2, ratio=10).select("word", "form", "root", "n", "n_near", "form_n")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    index = line_dedup.insert(line_dedup.new_index(spark, least=10, least_chars=1), docs)
    kept = line_dedup.drop_repeated_lines(docs, index)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_decontaminate, op3_mixing, op4_topk, op5_near_dedup, op6_language_id,
                                   op7_packing, op8_url_filter, op9_quality, op10_substring_dedup, op11_merkle, op12_spelling,
                                   op13_line_dedup)}


def _sql(pattern: str) -> str:
    return "'" + pattern.replace('\\"', '"').replace("'", "''") + "'"


def _crc32(byte_list: str) -> str:
    """CRC-32 of a list of byte values; ``crc`` holds the 256 table entries."""
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {byte_list}), "
            "lambda c, b: xor(c >> 8, crc.t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295)")


_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                                   for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tags_sql(tag: str, kind: str, value: str) -> str:
    tags = f"regexp_extract_all(coalesce(html, ''), {_sql(tag.replace('*+', '*'))})"
    return f"list_transform(list_filter({tags}, lambda t: regexp_matches(t, {_sql(kind)})), lambda t: regexp_extract(t, {_sql(value)}, 1))"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op2_decontaminate": rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT item_id, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM bw),
size AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, size WHERE len(w) >= k),
dwin AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM dw),
hit AS (SELECT DISTINCT doc_id, item_id, dwin.k, i FROM dwin JOIN win USING (k, s)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hit)) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1),
pos AS (SELECT DISTINCT doc_id, item_id, k, p AS i, q AS j FROM (
    SELECT h.doc_id, h.item_id, h.k, h.i AS p, bw.i AS q FROM hit h JOIN dwin x USING (doc_id, k, i)
    JOIN bw ON bw.item_id = h.item_id AND bw.k = h.k AND array_to_string(bw.w[bw.i:bw.i + bw.k - 1], ' ') = x.s)),
runs AS (SELECT doc_id, k, item_id, i - j AS diagonal, i - row_number() OVER (PARTITION BY doc_id, item_id, k, i - j ORDER BY i) AS g FROM pos),
lengths AS (SELECT doc_id, max(n) AS longest FROM (SELECT doc_id, k + count(*) - 1 AS n FROM runs GROUP BY doc_id, k, item_id, diagonal, g) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest, 0) AS INTEGER) AS longest
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN ids USING (doc_id) LEFT JOIN lengths USING (doc_id)""",
    "op5_near_dedup": rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
low AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM low LEFT JOIN n USING (doc_id)""",
    "op4_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op8_url_filter": rf"""
WITH RECURSIVE rules(action, host, path) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
links AS (SELECT url, unnest(list_concat({_tags_sql(url_filter.LINK_TAG, url_filter.CANONICAL, url_filter.HREF)},
    {_tags_sql(url_filter.META_TAG, url_filter.REFRESH, url_filter.TARGET)})) AS href FROM pages),
targets AS (SELECT url, CASE WHEN contains(h, '://') THEN h WHEN starts_with(h, '//') THEN split_part(url, '://', 1) || ':' || h
    WHEN starts_with(h, '/') THEN regexp_extract(url, '^.*?://[^/?#]*') || h
    ELSE regexp_extract(url, '^.*?://[^/?#]*') || CASE WHEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*/)', 1) = '' THEN '/'
        ELSE regexp_extract(url, '^.*?://[^/?#]*([^?#]*/)', 1) END || h END AS target
    FROM (SELECT url, replace(href, '&amp;', '&') AS h FROM links WHERE href <> '') WHERE contains(url, '://')),
urls AS (SELECT url, {_LOWER.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(nullif(regexp_extract(url, '^.*?://[^?#]*(\?[^#]*)', 1), '?'), '') AS query
    FROM (SELECT url FROM pages UNION SELECT target FROM targets)),
nodes AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/$', '') || query END AS node FROM urls),
best AS (SELECT url, first(r.host || r.path ORDER BY len(r.host || r.path) DESC) AS rule, first(action ORDER BY len(r.host || r.path) DESC) AS action
    FROM nodes u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY url),
edges AS (SELECT a.node AS a, b.node AS b FROM targets t JOIN nodes a ON a.url = t.url JOIN nodes b ON b.url = t.target),
ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT DISTINCT node, node FROM nodes WHERE node IS NOT NULL UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b),
says AS (SELECT a AS node, max(CASE action WHEN 'allow' THEN 2 WHEN 'block' THEN 1 END) AS say
    FROM reach JOIN nodes n ON n.node = b JOIN best USING (url) GROUP BY a)
SELECT page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, best.rule AS rule,
    coalesce(action, CASE WHEN say = 1 THEN 'block' END, 'allow') AS verdict
FROM pages p LEFT JOIN nodes n ON n.url IS NOT DISTINCT FROM p.url LEFT JOIN best ON best.url = p.url LEFT JOIN says ON says.node = n.node""",
    "op11_merkle": f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {_leaf('text')} AS leaf,
    {_leaf(f"CASE WHEN {_crc32(_DIGITS)} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS seen FROM documents, crc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes(tree, lev, pos, h, n) AS (SELECT tree, 0, pos, leaf, n FROM ranked UNION ALL
    SELECT tree, any_value(lev) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3) FROM nodes WHERE n > 1 GROUP BY tree, pos // 3),
runs AS (SELECT tree, lev, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
walk(doc_id, tree, leaf, lev, pos, n, h, sib) AS (SELECT doc_id, tree, leaf, 0, pos, n, seen, '' FROM ranked UNION ALL
    SELECT doc_id, w.tree, leaf, w.lev + 1, pos // 3, (n + 2) // 3,
        sha256(array_to_string(hs[:pos % 3] || [h] || hs[pos % 3 + 2:], '')), sib || array_to_string(hs[:pos % 3] || hs[pos % 3 + 2:], '')
    FROM walk w JOIN runs r ON r.tree = w.tree AND r.lev = w.lev AND r.parent = w.pos // 3 WHERE n > 1),
subroots AS (SELECT tree AS pos, h, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper_nodes(lev, pos, h, n) AS (SELECT 0, pos, h, n FROM subroots UNION ALL
    SELECT any_value(lev) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3) FROM upper_nodes WHERE n > 1 GROUP BY pos // 3),
upper_runs AS (SELECT lev, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM upper_nodes WHERE n > 1 GROUP BY ALL),
upper_walk(doc_id, tree, leaf, lev, pos, n, h, sib) AS (SELECT doc_id, tree, leaf, 0, w.tree, s.n, w.h, sib FROM walk w JOIN subroots s ON s.pos = w.tree WHERE w.n = 1 UNION ALL
    SELECT doc_id, tree, leaf, w.lev + 1, pos // 3, (n + 2) // 3,
        sha256(array_to_string(hs[:pos % 3] || [h] || hs[pos % 3 + 2:], '')), sib || array_to_string(hs[:pos % 3] || hs[pos % 3 + 2:], '')
    FROM upper_walk w JOIN upper_runs r ON r.lev = w.lev AND r.parent = w.pos // 3 WHERE n > 1)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(sib) AS proof_sha256, w.h AS folded_root, w.h = t.h AS verified
FROM upper_walk w JOIN subroots s ON s.pos = w.tree JOIN upper_nodes t ON t.n = 1 WHERE w.n = 1""",
    "op12_spelling": rf"""
WITH RECURSIVE {_CRC_TABLE},
low AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, {_LOWER.format('r')} AS w
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= 7),
hashed AS (SELECT w, {_crc32("flatten(list_transform(string_split(k || ':' || w, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) - 64 AS BIGINT)] END))")} AS h FROM low, crc),
slipped AS (SELECT CASE WHEN h % 31 = 0 THEN substring(w, 1, CAST(h % length(w) AS BIGINT)) || substring(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
dels AS (SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS d FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word AS x, b.word AS y FROM dels a JOIN dels b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word FROM dels a JOIN words b ON a.d = b.word UNION SELECT b.word, a.word FROM dels a JOIN words b ON a.d = b.word),
near AS (SELECT x AS word, count(*) AS n_near, first(y ORDER BY n DESC, y) AS y, max(n) AS m FROM pairs JOIN words ON word = y GROUP BY x),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN y END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
    FROM words w LEFT JOIN near USING (word)),
steps(word, last) AS (SELECT word, word FROM words UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.last AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN steps s USING (word) JOIN forms e ON e.word = s.last WHERE e.form IS NULL""",
    "op13_line_dedup": f"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
often AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE o.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN often o USING (key) GROUP BY doc_id""",
}
