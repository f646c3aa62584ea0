"""The registered corpus queries: each applies one operator to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    collocations,
    decontamination,
    embedding_dedup,
    lm_scoring,
    mixing,
    ngram_join,
    packing,
    quality,
    sharding,
    substring_dedup,
    toxicity,
    url_rules,
    whitening,
)
from tidemark.llm.spread import importable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_pca_tiled_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.classes(_table(spark, sf_dir, "embeddings"))


def op4_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"), sharding.topology())


def op8_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(_table(spark, sf_dir, "documents"))


def op9_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op11_prefix_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op12_automaton_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


_QUERIES = (
    op1_recompression_dedup,
    op2_crf_toxicity,
    op3_pca_tiled_dedup,
    op4_cross_entropy_difference,
    op5_bm25_decontamination,
    op6_pattern_packing,
    op7_hash_tree_sharding,
    op8_minhash_join,
    op9_zstd_quality,
    op10_url_rules,
    op11_prefix_mix,
    op12_automaton_collocations,
    op13_block_whitening,
)


def _ready(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir.rstrip("/"))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _ready(query) for query in _QUERIES} | {"pipeline": _ready(corpus_pipeline.run)}


_OP1_SQL = r"""
WITH listed AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), places AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM listed
), starts AS (
  SELECT doc_id, p, array_to_string(w[p:p + 49], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM listed) every_window
), firsts AS (
  SELECT run, min(doc_id) AS doc_id FROM starts GROUP BY run
), later AS (
  SELECT s.doc_id, s.p FROM starts s JOIN firsts f ON f.run = s.run WHERE f.doc_id < s.doc_id
), judged AS (
  SELECT a.doc_id, a.word, a.p,
         count(l.p) OVER (PARTITION BY a.doc_id ORDER BY a.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM places a LEFT JOIN later l ON l.doc_id = a.doc_id AND l.p = a.p
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept_text
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM listed d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_OP3_SQL = r"""
WITH RECURSIVE doubles AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS given FROM embeddings
), judged AS (
  SELECT vec_id, given, list_filter(given, lambda x: isfinite(x)) AS v FROM doubles
), units AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM judged
  WHERE len(v) = len(given) AND list_dot_product(v, v) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM units a JOIN units b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM doubles
  UNION
  SELECT r.vec_id, p.b FROM reach r JOIN pairs p ON p.a = r.other
), counted AS (
  SELECT a AS vec_id, count(*) AS n_links FROM pairs GROUP BY a
), least AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
)
SELECT l.vec_id, coalesce(c.n_links, 0) AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least l LEFT JOIN counted c ON c.vec_id = l.vec_id
"""

_OP8_SQL = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(
           CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM listed
), nodes AS (
  SELECT min(doc_id) AS node, s, len(s) AS size, count(*) AS copies FROM sets WHERE len(s) > 0 GROUP BY s
), grams AS (
  SELECT node, size, unnest(s) AS gram FROM nodes
), pairs AS (
  SELECT a.node AS a, b.node AS b
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.node <> b.node
  GROUP BY a.node, b.node, a.size, b.size
  HAVING 10 * count(*) >= 8 * (a.size + b.size - count(*))
), reach(node, other) AS (
  SELECT node, node FROM nodes
  UNION
  SELECT r.node, p.b FROM reach r JOIN pairs p ON p.a = r.other
), least AS (
  SELECT node, min(other) AS class_id FROM reach GROUP BY node
), linked AS (
  SELECT p.a AS node, sum(n.copies) AS links FROM pairs p JOIN nodes n ON n.node = p.b GROUP BY p.a
)
SELECT d.doc_id, coalesce(l.class_id, d.doc_id) AS class_id,
       CAST(coalesce(k.links, 0) + coalesce(n.copies - 1, 0) AS BIGINT) AS n_links
FROM sets d LEFT JOIN nodes n ON n.s = d.s AND len(d.s) > 0
            LEFT JOIN least l ON l.node = n.node LEFT JOIN linked k ON k.node = n.node
"""

_OP11_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS weight
  FROM sized GROUP BY source
), fill(round, rest, open_weight) AS (
  SELECT 0, sum(3 * source_size)::HUGEINT, sum(weight)::HUGEINT FROM sources
  UNION ALL
  SELECT round + 1, new_rest, new_weight
  FROM (
    SELECT f.round, f.open_weight,
           (SELECT sum(3 * source_size - CASE WHEN weight * f.rest > 4 * source_size * f.open_weight
                                              THEN 4 * source_size ELSE 0 END)::HUGEINT FROM sources) AS new_rest,
           (SELECT sum(CASE WHEN weight * f.rest > 4 * source_size * f.open_weight THEN 0 ELSE weight END)::HUGEINT
            FROM sources) AS new_weight
    FROM fill f
  ) next_round
  WHERE new_weight <> open_weight
), last_round AS (
  SELECT rest, open_weight FROM fill ORDER BY round DESC LIMIT 1
), plan AS (
  SELECT source, source_size,
         CASE WHEN above THEN CAST(2 * source_size AS DOUBLE)
              ELSE CAST(weight * rest AS DOUBLE) / CAST(2 * open_weight AS DOUBLE) END AS target,
         CASE WHEN above THEN 2 * source_size ELSE (2 * weight * rest + 2 * open_weight) // (4 * open_weight) END AS budget
  FROM (SELECT *, weight * rest > 4 * source_size * open_weight AS above FROM sources, last_round) judged
), placed AS (
  SELECT doc_id, size, p.source_size, p.target, p.budget,
         coalesce(sum(size) OVER (PARTITION BY s.source
           ORDER BY md5(':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)), doc_id IS NULL
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(greatest(0, least(size, budget - before)) + greatest(0, least(size, budget - source_size - before)) AS BIGINT) AS taken
FROM placed
"""

_OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM listed
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM listed
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM listed
), counted AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY lang, k, phrase
), split AS (
  SELECT lang, k, phrase, f, split_part(phrase, ' ', 1) AS w1, split_part(phrase, ' ', 2) AS w2, split_part(phrase, ' ', 3) AS w3
  FROM counted WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT lang, k, phrase, f, 1 AS cut, w1 AS head, CASE k WHEN 2 THEN w2 ELSE w2 || ' ' || w3 END AS tail FROM split
  UNION ALL
  SELECT lang, k, phrase, f, 2, w1 || ' ' || w2, w3 FROM split WHERE k = 3
), scored AS (
  SELECT c.lang, c.k, c.phrase, c.f, x.f AS l, y.f AS r, (1000000 * c.f * c.f) // (x.f * y.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.k, c.phrase ORDER BY (1000000 * c.f * c.f) // (x.f * y.f), c.cut) AS place
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head AND x.k = c.cut
              JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail AND y.k = c.k - c.cut
), longer AS (
  SELECT lang, part, max(f) AS f
  FROM (SELECT lang, w1 || ' ' || w2 AS part, f FROM split WHERE k = 3
        UNION ALL SELECT lang, w2 || ' ' || w3, f FROM split WHERE k = 3) parts
  GROUP BY lang, part
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer g ON s.k = 2 AND g.lang = s.lang AND g.part = s.phrase
  WHERE s.place = 1 AND (g.f IS NULL OR 100 * g.f < 50 * s.f)
), totals AS (
  SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang
), ranked AS (
  SELECT k.*, t.n, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, f DESC, phrase) AS rank
  FROM kept k JOIN totals t ON t.lang = k.lang
)
SELECT lang, rank, phrase, CAST(f AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """For the queries that are SQL; fits and tokenizers are not, and the tests hold those queries against brute force."""
    return {
        "op1_recompression_dedup": _OP1_SQL,
        "op3_pca_tiled_dedup": _OP3_SQL,
        "op8_minhash_join": _OP8_SQL,
        "op11_prefix_mix": _OP11_SQL,
        "op12_automaton_collocations": _OP12_SQL,
    }
