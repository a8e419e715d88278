"""DuckDB SQL for the queries that SQL can express, from their definitions."""

from __future__ import annotations

from tapeworks.llm import jaccard, line_dedup, mixing, substrings, vectors

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def reach(links: str) -> str:
    """CTEs: ``closure`` (id, component), the smallest id reachable over the
    rows (a, b), in both directions, of ``links``."""
    return f"""
reached(id, other) AS (
  SELECT a, a FROM {links} UNION SELECT reached.id, l.b FROM reached JOIN {links} l ON reached.other = l.a),
closure AS (SELECT id, min(other) AS component FROM reached GROUP BY id)"""


OP4 = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {WORDS} AS words FROM documents),
grams AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < {jaccard.GRAM} THEN array_to_string(words, ' ')
           ELSE array_to_string(words[k:k + {jaccard.GRAM - 1}], ' ') END AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {jaccard.GRAM - 2}, 2))) AS k FROM texts WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT c.a, c.b, c.n = s.n AND c.n = t.n AS same FROM common c JOIN sizes s ON c.a = s.doc_id JOIN sizes t ON c.b = t.doc_id
  WHERE c.n >= {jaccard.THRESHOLD} * (s.n + t.n - c.n) - 1e-9),
per_doc AS (SELECT a, count(*) AS n, min(CASE WHEN same THEN b END) AS twin FROM links GROUP BY a),
{reach('links')}
SELECT d.doc_id, least(d.doc_id, coalesce(p.twin, d.doc_id)) AS class_id, coalesce(p.n, 0)::BIGINT AS n_links,
       coalesce(c.component, d.doc_id) AS group_id, coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.a LEFT JOIN closure c ON d.doc_id = c.id
"""

OP5 = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= {vectors.COSINE}),
per_vector AS (SELECT a, count(*) AS n FROM links GROUP BY a),
{reach('links')}
SELECT e.vec_id, coalesce(p.n, 0)::BIGINT AS n_links, coalesce(c.component, e.vec_id) AS component_id,
       coalesce(c.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN per_vector p ON e.vec_id = p.a LEFT JOIN closure c ON e.vec_id = c.id
"""

OP6 = f"""
WITH texts AS (SELECT doc_id, {WORDS} AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM texts),
win AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER f AS run, count(*) OVER f AS n FROM w
  WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {substrings.WINDOW - 1} FOLLOWING)),
later AS (
  SELECT doc_id, pos FROM win WHERE n = {substrings.WINDOW} QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + {substrings.WINDOW})) AS pos FROM later),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM w ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, (len(t.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""


def apportion(name: str, parties: str, group: str, key: str) -> str:
    """CTEs ending in ``name``: the rows of ``parties`` (votes, most, house) with
    their ``seats`` by highest quotients votes / (2 k + 1)."""
    return f"""
{name}_n AS (SELECT *, count(*) OVER g AS n_, sum(votes) OVER g AS all_ FROM {parties} WINDOW g AS (PARTITION BY {group})),
{name}_b AS (
  SELECT *, least(most, CASE WHEN all_ > 0 AND house > n_ / 2 THEN floor(votes * (house - 0.5 * n_) / all_ + 0.5) ELSE 0 END)::BIGINT AS sure,
         least(most, CASE WHEN all_ > 0 THEN floor(votes * (house + 0.5 * n_) / all_ + 0.5) + 1 ELSE 0 END)::BIGINT AS top FROM {name}_n),
{name}_s AS (
  SELECT {group}, {key}, k, row_number() OVER (PARTITION BY {group} ORDER BY votes / (2 * k + 1) DESC, {key} NULLS LAST) AS place, open_
  FROM (SELECT *, unnest(range(sure, top)) AS k FROM
        (SELECT *, house - sum(sure) OVER (PARTITION BY {group}) AS open_ FROM {name}_b)) x),
{name}_w AS (SELECT {group}, {key}, count(*) AS won FROM {name}_s WHERE place <= open_ GROUP BY {group}, {key}),
{name} AS (
  SELECT b.*, b.sure + coalesce(w.won, 0) AS seats FROM {name}_b b LEFT JOIN {name}_w w
  ON b.{group} IS NOT DISTINCT FROM w.{group} AND b.{key} IS NOT DISTINCT FROM w.{key})"""


def _digits(text: str) -> str:
    return f"('0x' || md5({text})[1:15])::BIGINT"


_LIMIT = mixing.MAX_REPEATS
_BLOCK = mixing.BLOCK_WORDS
OP3 = f"""
WITH sizes AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM sizes GROUP BY source),
s1 AS (SELECT *, [{', '.join(map(str, mixing.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
              sum(source_size) OVER () AS total FROM s0),
s2 AS (SELECT *, source_size * {_LIMIT} / weight AS ratio FROM s1),
s3 AS (SELECT *, (total - coalesce(sum(source_size * {_LIMIT}) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
s4 AS (SELECT *, max(level) OVER () AS held FROM s3),
sources AS (SELECT source, docs, source_size, CASE WHEN ratio <= held THEN (source_size * {_LIMIT})::DOUBLE ELSE held * weight END AS target FROM s4),
source_votes AS (SELECT *, 0 AS everything, target AS votes, floor(sum(target) OVER () / {_BLOCK})::BIGINT AS house,
                        source_size * {_LIMIT} // {_BLOCK} AS most FROM sources),
{apportion('quotas', 'source_votes', 'everything', 'source')},
placed AS (
  SELECT z.*, q.source_size, q.target, q.seats AS source_seats,
         {_digits(f"'{mixing.SEED}:shard:' || coalesce(z.doc_id::VARCHAR, '')")} % ceil(q.docs / {mixing.DOCS_PER_SHARD})::BIGINT AS shard
  FROM sizes z JOIN quotas q ON z.source IS NOT DISTINCT FROM q.source),
shard_votes AS (
  SELECT source, shard, sum(size)::BIGINT AS votes, any_value(source_seats) AS house, sum(size)::BIGINT * {_LIMIT} // {_BLOCK} AS most
  FROM placed GROUP BY source, shard),
{apportion('shards', 'shard_votes', 'source', 'shard')},
streamed AS (
  SELECT p.*, h.seats * {_BLOCK} AS quota, h.votes AS words,
         sum(p.size) OVER (PARTITION BY p.source, p.shard ORDER BY {_digits(f"'{mixing.SEED}:' || coalesce(p.doc_id::VARCHAR, '')")}, p.doc_id, p.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - p.size AS start
  FROM placed p JOIN shards h ON p.source IS NOT DISTINCT FROM h.source AND p.shard = h.shard)
SELECT doc_id, size, source, source_size, target,
       (CASE WHEN words > 0 THEN quota // words * size + greatest(0, least(quota % words, start + size) - start) ELSE 0 END)::BIGINT AS taken
FROM streamed
"""

ORACLE_SQL = {
    "op3_source_mixing": OP3,
    "op4_jaccard_join": OP4,
    "op5_embedding_near_dedup": OP5,
    "op6_substring_dedup": OP6,
    "op9_line_dedup": line_dedup.ORACLE_SQL,
}
