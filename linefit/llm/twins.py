"""DuckDB SQL for those queries that plain SQL can answer over whole tables."""

from __future__ import annotations

from linefit.llm import chat

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN strlen(h) >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(h) >= 1000 AND page_id < top THEN top END AS refers_to
FROM p"""

LINKS = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
  WHERE a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e)
    / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.95),
reach AS (
  SELECT vec_id AS v, vec_id AS r FROM embeddings
  UNION SELECT reach.v, link.b FROM reach JOIN link ON reach.r = link.a),
named AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v),
counted AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v = component_id AS kept
FROM named LEFT JOIN counted ON a = v"""


def chats() -> str:
    """The chat query: what was said, what the loss counts, and the output's length."""
    template = chat.Template()
    said = "</s>[INST] ok [/INST]"
    cases = " ".join(
        f"WHEN '{r}' THEN {len(template.before[r]) + len(template.after[r])}" for r in template.before
    )
    moves = " OR ".join(
        f"(before = '{state}' AND role IN ({', '.join(repr(r) for r in after)}))"
        for state, after in template.moves.items()
    )
    control = "<\\\\*(?:s>|/s>|<SYS>>|</SYS>>)|\\[\\\\*(?:INST\\]|/INST\\]|ROLE\\]|/ROLE\\])"
    return f"""
WITH rows_of AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{said}' UNION ALL SELECT -1, 1, 'assistant', '{said}'),
walked AS (
  SELECT *, coalesce(lag(role) OVER w, '{chat.START}') AS before, lead(role) OVER w IS NULL AS last
  FROM rows_of WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
judged AS (
  SELECT *, coalesce({moves}, false) AND (NOT last OR role IN ('assistant')) AS fine,
    CASE role {cases} END + length(text) + len(regexp_extract_all(text, '{control}')) AS chars
  FROM walked)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, bool_and(fine) AS valid
FROM judged GROUP BY conv_id"""


TWINS = {"op3_product_quantiser": LINKS, "op9_chat": chats(), "op10_warc": WARC}
