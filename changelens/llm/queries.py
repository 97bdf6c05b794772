"""The operators' queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontamination, html, lexical, licenses, minhash, mixing, packing, search, sharding, tokens, toxicity, vectors
from .shared import documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), 24)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.9)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), k=4, percent=80)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html.extract_text(pages).select("page_id", "url", "text")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("spans")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0", 20)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10)


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_shards": op2_shards,
    "op3_token_counts": op3_token_counts,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_packing": op5_packing,
    "op6_minhash": op6_minhash,
    "op7_mixing": op7_mixing,
    "op8_html": op8_html,
    "op9_licenses": op9_licenses,
    "op10_nearest": op10_nearest,
    "op11_conversations": op11_conversations,
    "op12_decontamination": op12_decontamination,
    "op13_lexical": op13_lexical,
}


def _license_sql() -> str:
    """The scan over words in SQL: the same templates, joined by the grams' words."""
    values = ", ".join(f"({t}, '{label}', {base}, {at}, '{' '.join(gram)}', {n})" for t, label, base, at, gram, n in licenses.template_rows())
    return rf"""
WITH templates(template, label, base, place, gram, grams) AS (VALUES {values}),
docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(len(w))) AS pos FROM docs),
grams AS (
  SELECT doc_id, pos, TRUE AS base, w[pos + 1] || ' ' || w[pos + 2] AS gram FROM places WHERE pos + 2 <= len(w)
  UNION ALL SELECT doc_id, pos, FALSE, array_to_string(w[pos + 1:pos + 4], ' ') FROM places WHERE pos + 4 <= len(w)),
diagonals AS (
  SELECT doc_id, template, label, t.base, grams, pos - place AS diagonal, count(*) AS votes, min(pos) AS lo, max(pos) AS hi
  FROM grams g JOIN templates t ON g.gram = t.gram AND g.base = t.base GROUP BY ALL),
steps AS (
  SELECT *, CASE WHEN base OR diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {licenses.NEIGHBOURS} THEN 1 ELSE 0 END AS step
  FROM diagonals),
runs AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM steps),
spans AS (
  SELECT doc_id, label, base, grams, sum(votes) AS votes, min(diagonal) AS start, least(sum(votes) / grams, 1.0) AS part
  FROM runs GROUP BY doc_id, template, label, base, grams, run
  HAVING CASE WHEN base THEN sum(votes) = grams ELSE sum(votes) / grams >= {licenses.COVERED} AND max(hi) - min(lo) <= 2 * grams END)
SELECT d.doc_id, CAST(len(any_value(d.w)) AS BIGINT) AS n_words, count(*) FILTER (base) AS n_base,
       CAST(min(start) FILTER (base) AS BIGINT) AS first_word, CAST(max(start) FILTER (base) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (label IS NOT NULL), '') AS labels,
       CAST(coalesce(max(CASE WHEN base THEN 1.0 ELSE part END), 0) AS DOUBLE) AS score
FROM docs d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""


_VALID = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"

ORACLE_SQL = {
    "op4_embedding_dedup": f"""
WITH RECURSIVE valid AS MATERIALIZED ({_VALID}),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1), counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id""",
    "op10_nearest": f"""
WITH valid AS MATERIALIZED ({_VALID}),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score FROM valid q JOIN valid c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 20""",
    "op9_licenses": _license_sql(),
    "op12_decontamination": r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM words, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)),
met AS MATERIALIZED (SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x ON x.n = g.n AND x.gram = g.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM met, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
held AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)""",
    "op13_lexical": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tfs AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
lengths AS MATERIALIZED (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY 1),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
ms AS MATERIALIZED (SELECT doc_id, 100 - 75 + ((75 * n * docs) // words) AS m FROM lengths, whole),
weights AS MATERIALIZED (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY 1), whole),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
scores AS (
  SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN ms USING (doc_id) GROUP BY 1, 2)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10""",
    "op6_minhash": r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
shingles AS MATERIALIZED (SELECT doc_id, hash(unnest(s)) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n""",
    "op7_mixing": r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))) AS key
  FROM documents),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS w
  FROM sums),
stops AS (
  SELECT *, CAST(source_size AS DOUBLE) * 3 AS cap, CAST(source_size AS DOUBLE) * 3 / w AS stop FROM weighed),
levels AS (
  SELECT *, ((SELECT sum(CAST(source_size AS DOUBLE)) FROM stops)
     - coalesce(sum(cap) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / sum(w) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM stops),
targets AS (
  SELECT source, source_size, least((SELECT coalesce(arg_min(level, stop), 0) FROM levels WHERE level <= stop) * w, cap) AS target
  FROM levels),
line AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - start)) + greatest(0, least(size, floor(target) - start - source_size))
          + greatest(0, least(size, floor(target) - start - 2 * source_size)) AS BIGINT) AS taken
FROM line""",
}
