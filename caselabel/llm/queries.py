"""The queries of this subpackage: each operator on its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caselabel.llm import (
    decontaminate,
    embedding_dedup,
    jaccard_join,
    language_id,
    line_dedup,
    merkle,
    mixing,
    nearest,
    prefix_trie,
    quality,
    secret_scan,
    token_count,
    toxicity,
)
from caselabel.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(owner) FILTER (WHERE owner <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k)
GROUP BY doc_id
"""

OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, (2 * source_size)::DOUBLE AS lim, (2 * source_size)::DOUBLE / weight AS ratio FROM per
), levelled AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(lim) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ranked
  WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), found AS (
  SELECT arg_min(level, ratio) AS level FROM levelled WHERE level <= ratio
), goal AS (
  SELECT source, source_size, least(lim, coalesce(found.level * weight, lim)) AS target FROM ranked CROSS JOIN found
), placed AS (
  SELECT sized.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('mix:' || doc_id::VARCHAR), doc_id, size
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized
), cut AS (
  SELECT doc_id, size, source_size, target, start, floor(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole
  FROM placed JOIN goal ON placed.source IS NOT DISTINCT FROM goal.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + least(size, greatest(budget - whole * source_size - start, 0)))::BIGINT AS taken
FROM cut
"""


#: Unsigned crc32 of a number's decimal text: every byte is taken in, then eight shifts follow it.
CRC = """xor(4294967295, list_reduce([4294967295] || flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split({}::VARCHAR, '')]),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""

OP11_SQL = f"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-')) AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         {CRC.format("doc_id")} AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS bent
  FROM fields
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, row_number() OVER () AS r FROM hashed
), tree AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY k) AS nodes FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, [sha256(nodes[i] || coalesce(nodes[i + 1], '')) FOR i IN range(1, len(nodes) + 1, 2)] FROM tree WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM tree WHERE len(nodes) = 1
), top AS (
  SELECT 0 AS level, list(subroot ORDER BY j) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, [sha256(nodes[i] || coalesce(nodes[i + 1], '')) FOR i IN range(1, len(nodes) + 1, 2)] FROM top WHERE len(nodes) > 1
), steps AS (
  SELECT r, 0 AS part, level, k >> level AS place, nodes FROM leaves JOIN tree ON leaves.lang IS NOT DISTINCT FROM tree.lang WHERE len(nodes) > 1
  UNION ALL
  SELECT r, 1, level, j >> level, nodes FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang CROSS JOIN top WHERE len(nodes) > 1
), paths AS (
  SELECT r, list(coalesce(CASE WHEN place % 2 = 1 THEN 'L' || nodes[place] ELSE 'R' || nodes[place + 2] END, '-') ORDER BY part, level) AS path FROM steps GROUP BY r
)
SELECT doc_id, leaf, subroot, top.nodes[1] AS root, sha256(array_to_string([s[2:] FOR s IN coalesce(path, [])], '')) AS proof_sha256,
       list_reduce([coalesce(bent, leaf)] || coalesce(path, []),
           lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root,
       folded_root = root AS verified
FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang CROSS JOIN top LEFT JOIN paths USING (r)
WHERE len(top.nodes) = 1
"""

OP12_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT DISTINCT conv_id AS c, {CRC.format("conv_id")} % 9 AS h FROM turns
), rebuilt AS (
  SELECT c, 0 AS part, pos, digest, strlen(text) AS size FROM ids JOIN turns ON turns.conv_id = c - c % 5 WHERE pos <= h
  UNION ALL
  SELECT c, 1, pos, digest, strlen(text) FROM ids JOIN turns ON turns.conv_id = c WHERE pos > h
), steps AS (
  SELECT c, size, row_number() OVER own AS depth, string_agg(digest, '') OVER own AS path
  FROM rebuilt WINDOW own AS (PARTITION BY c ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), places AS (
  SELECT c, depth, size, sha256(path) AS node, coalesce(lag(sha256(path)) OVER (PARTITION BY c ORDER BY depth), '') AS parent FROM steps
  UNION ALL
  SELECT c, 0, 0, '', NULL FROM ids
), marked AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY c) AS last FROM places
), nodes AS (
  SELECT node, parent, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(c, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
  FROM marked GROUP BY node, parent, depth
), counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN (SELECT parent, count(*) AS n FROM nodes GROUP BY parent) k ON k.parent = node
), under AS (
  SELECT DISTINCT a.node AS above, b.node AS node FROM places a JOIN places b ON a.c = b.c AND a.depth <= b.depth
), sums AS (
  SELECT above, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM under JOIN counted USING (node) GROUP BY above
)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, t.ends_sha256
FROM counted t JOIN sums ON above = t.node LEFT JOIN counted p ON p.node = t.parent
"""


@query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_embedding_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_token_count")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # a folder of vocabulary files; only this query needs it

    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_line_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(table(spark, sf_dir, "documents"))


@query("op6_mix_sources", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("op13_nearest")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"))
