"""The registered queries ``opN_<name>`` and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm import decontaminate, exact_dedup, jaccard, language, licenses, packing, personal_data, quality, spelling, substring, suffix_tree, treap, wrappers
from gleanspark.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(_table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _is_kind(kind))).cast("long").alias(f"n_{kind}") for kind in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.license_spans(_table(spark, sf_dir, "documents")))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_sets(_table(spark, sf_dir, "documents"), count_links=True)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.drop("items", "spans")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents")).drop("no_letters")


def op7_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.language_model_scores(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_texts(_table(spark, sf_dir, "pages"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(_table(spark, sf_dir, "documents")).drop("spans")


def op11_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": op1_personal_data,
    "op2_license_scan": op2_license_scan,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_language_id": op6_language_id,
    "op7_suffix_tree_scores": op7_suffix_tree_scores,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_html_main_text": op9_html_main_text,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_compression_quality": op11_compression_quality,
    "op12_treap_search": op12_treap_search,
    "op13_spelling_variants": op13_spelling_variants,
}

_OP5 = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 85 * (p.n + q.n - k)
),
class AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS class_id
  FROM (SELECT doc_id, sha256(string_agg(s, chr(10) ORDER BY s)) AS k FROM sets GROUP BY doc_id)
),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id, coalesce(any_value(class_id), d.doc_id) AS class_id,
  coalesce(any_value(n_links), 0) AS n_links
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN class USING (doc_id) JOIN reach ON reach.x = d.doc_id
LEFT JOIN (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x) USING (doc_id) GROUP BY d.doc_id
"""

_OP4 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)
),
hit AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN bw USING (win)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
seen AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) < doc_id AS again FROM wins),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM seen WHERE again),
lost AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
  ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP12 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
),
size AS (
  SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(coalesce(sum(len(w)), 0) AS BIGINT) AS n_terms FROM d
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, size GROUP BY term
),
measure AS (SELECT doc_id, 100 - 90 + ((90 * len(w) * n_docs) // n_terms) AS m FROM d, size WHERE len(w) > 0),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN measure USING (doc_id) GROUP BY ALL
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

# DuckDB has no crc32: a table of its 256 steps, folded over the bytes of every text hashed.
_OP13 = r"""
WITH RECURSIVE step(b, c, k) AS (
  SELECT b, b, 0 FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
),
crc AS (SELECT list(c ORDER BY b) AS steps FROM step WHERE k = 8),
run AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
  FROM documents
),
counted AS (SELECT doc_id, r, count(*) AS n, hex(encode(doc_id || ':' || r)) AS x FROM run WHERE length(r) >= 5 GROUP BY ALL),
hashed AS (
  SELECT r, n, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT))),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc
),
word AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN r[1 : h % length(r)] || r[h % length(r) + 2 :] ELSE r END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
cut AS (
  SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word
),
formed AS (
  SELECT word.word, CASE WHEN m >= 2 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM word LEFT JOIN best USING (word)
),
path(word, stop) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT path.word, form FROM path JOIN formed ON formed.word = path.stop WHERE form IS NOT NULL
),
last AS (SELECT path.word, stop AS root FROM path JOIN formed ON formed.word = path.stop WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)
"""

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard": _OP3,
    "op4_benchmark_decontamination": _OP4,
    "op5_exact_dedup": _OP5,
    "op10_substring_dedup": _OP10,
    "op12_treap_search": _OP12,
    "op13_spelling_variants": _OP13,
}
