"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from ledgerlens.llm import url_filter
from ledgerlens.llm.queries import FORGED


def _url_filter() -> str:
    weights = url_filter.vocabulary()
    terms = ", ".join(f"('{t}', {w})" for t, w in sorted(weights.items()))
    fits = []
    for (host, path), verdict in url_filter.RULES.items():
        fits.append(f"SELECT page_id, '{host}{path}' AS rule, '{verdict}' AS said FROM parts WHERE (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH parts AS (
  SELECT page_id, coalesce({lower.format("url")}, '') AS low,
    coalesce({lower.format("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")}, '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), terms(term, weight) AS (VALUES {terms}),
fits AS ({" UNION ALL ".join(fits)}),
longest AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said FROM fits GROUP BY page_id),
hits AS (
  SELECT page_id, sum(weight) AS weight FROM parts, terms
  WHERE regexp_matches(low, '(^|[^a-z0-9])' || term || '($|[^a-z0-9])') GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(said, CASE WHEN weight >= 1 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN longest l USING (page_id) LEFT JOIN hits h USING (page_id)"""


WARC = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), digests AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY hex) AS keeper,
    list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST(list_sum(list_transform(range(5), lambda j: (
        (instr('0123456789abcdef', substr(hex, 1 + CAST((5 * i + j) // 4 AS INT), 1)) - 1) // CAST(2 ** (3 - (5 * i + j) % 4) AS INT)) % 2
        * CAST(2 ** (4 - j) AS INT))) AS INT), 1)), lambda a, b: a || b) AS payload_digest
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM digests"""

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{FORGED}'), (-7, 1, 'assistant', '{FORGED}')
), written AS (
  SELECT *, length(role) + length(text) + 17 + len(regexp_extract_all(role || chr(10) || text, '<\\\\*/?s>|\\[\\\\*/?INST\\]')) AS size FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(3 + sum(size) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id"""



def _centroids(clusters: int = 8, rounds: int = 10) -> str:
    """Vectors and centroids as one row per component; each round is a pair of tables."""
    steps = [
        "raw AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE len(embedding) = 64)",
        "kept AS (SELECT vec_id FROM raw GROUP BY vec_id HAVING count(v) = 64 AND bool_and(isfinite(v)))",
        "x AS MATERIALIZED (SELECT vec_id, i, CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT) AS v FROM raw SEMI JOIN kept USING (vec_id))",
        f"first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept ORDER BY c LIMIT {clusters})",
        "c0 AS MATERIALIZED (SELECT c, i, v FROM x JOIN first USING (vec_id))",
    ]
    for r in range(rounds + 1):
        far = f"SELECT x.vec_id, c.c, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d FROM x JOIN c{r} c USING (i) GROUP BY ALL"
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM ({far}) GROUP BY vec_id)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT c, i, sum(v) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id) GROUP BY ALL)")
            # An integer division that rounds down whatever the sign.
            mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, o.i, coalesce({mean}, o.v) AS v FROM c{r} o LEFT JOIN m{r} m ON m.c = o.c AND m.i = o.i)")
    return f"""
WITH {", ".join(steps)},
told AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN told USING (c)"""


HARD_NEGATIVES = """
WITH raw AS (
  SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL
), kept AS (SELECT vec_id FROM raw GROUP BY vec_id HAVING count(v) = count(*) AND bool_and(isfinite(v))),
x AS MATERIALIZED (SELECT vec_id, label, i, CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT) AS v FROM raw SEMI JOIN kept USING (vec_id)),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(sum(a.v * b.v) AS BIGINT) AS score
  FROM x a JOIN x b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10"""

ORACLES: dict[str, str] = {
    "op1_url_filter": _url_filter(), "op2_warc": WARC, "op6_chat": CHAT, "op11_centroids": _centroids(), "op12_hard_negatives": HARD_NEGATIVES,
}
