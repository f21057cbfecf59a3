"""One query for each corpus operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
import public_tokenizers
from posofold.llm import divergence, embed_join, exact_dedup, hard_negatives, langid, line_dedup, ngram_join, packing, secrets, sp_dropout, substring, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Files of the public tokenizers.
WORD_TOKENIZER = os.environ.get("WORD_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")
PIECE_TOKENIZER = os.environ.get("PIECE_TOKENIZER") or public_tokenizers.path("piece_bpe_32k.model")
_documents, _embeddings, _pages, _labels = map(_table, ("documents", "embeddings", "pages", "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": lambda s, d: line_dedup.without_repeated_lines(_documents(s, d), with_text=False),
        "op2_sentencepiece_dropout": lambda s, d: sp_dropout.summary(_documents(s, d), PIECE_TOKENIZER),
        "op3_secret_scan": lambda s, d: secrets.summary(_documents(s, d)),
        "op4_language_id": lambda s, d: langid.identify(_documents(s, d)),
        "op5_substring_dedup": lambda s, d: substring.without_repeats(_documents(s, d), with_text=False),
        "op6_ngram_jaccard_join": lambda s, d: ngram_join.near_documents(_documents(s, d)),
        "op7_packing": lambda s, d: packing.pack(_documents(s, d), WORD_TOKENIZER),
        "op8_warc": lambda s, d: warc.records(_pages(s, d)),
        "op9_exact_dedup": lambda s, d: exact_dedup.exact_dedup(_documents(s, d)),
        "pipeline": corpus_pipeline.run,
        "op10_embedding_near_dedup": lambda s, d: embed_join.near_vectors(_embeddings(s, d)),
        "op11_hard_negatives": lambda s, d: hard_negatives.mine(_embeddings(s, d)),
        "op12_toxicity": lambda s, d: toxicity.toxicity(_documents(s, d), _labels(s, d)),
        "op13_source_divergence": lambda s, d: divergence.divergence(_documents(s, d)),
    }


_WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"
_SPACE = r"[\x20\x09-\x0D]"


def _components(nodes: str, links: str) -> str:
    """CTEs for (id, component) from nodes (id) and links (a, b) in both directions."""
    return (
        f"reach(id, other) AS (SELECT id, id FROM {nodes} UNION SELECT r.id, l.b FROM reach r JOIN {links} l ON r.other = l.a), "
        "component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"
    )


_EXACT = rf"""
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept, text_sha256
FROM t"""

_SUBSTRING = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
k AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS n FROM k),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS p FROM r WHERE n > 1),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM x ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 75 * (x.n + y.n - i)),
nodes AS (SELECT doc_id AS id FROM documents), {_components("nodes", "links")}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents JOIN component ON id = doc_id LEFT JOIN n USING (doc_id)"""

_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= {warc.MIN_REVISIT} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {warc.MIN_REVISIT} AND page_id < last THEN last END AS refers_to
FROM q"""

_VECTORS = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
nodes AS (SELECT vec_id AS id FROM embeddings), {_components("nodes", "links")},
n AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON id = vec_id LEFT JOIN n ON a = vec_id"""

_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s JOIN p USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""

_DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS doc FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT lang, source, doc, unnest(w) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS lang_n FROM x GROUP BY 1, 2 HAVING count(DISTINCT doc) >= 3),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM x SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS kept, sum(lang_n) AS lang_total FROM k GROUP BY 1),
t AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM c GROUP BY 1, 2),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 1) // (coalesce(total, 0) + kept) AS p,
         1 + 1000000000 * (lang_n + 1) // (lang_total + kept) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN f y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY 1, 2, 3),
part AS (
  SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pair
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM f WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM part)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200"""


def oracle_sql() -> dict[str, str]:
    """The others use models, tokenizers or hashes that SQL has not; brute force in the tests."""
    return {
        "op5_substring_dedup": _SUBSTRING,
        "op6_ngram_jaccard_join": _JACCARD,
        "op8_warc": _WARC,
        "op9_exact_dedup": _EXACT,
        "op10_embedding_near_dedup": _VECTORS,
        "op11_hard_negatives": _NEGATIVES,
        "op13_source_divergence": _DIVERGENCE,
    }
