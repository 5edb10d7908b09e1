"""SQL for the operators of this subpackage that SQL can express."""

from __future__ import annotations

# Rules and hosts: the words, windows and lines of each text, then beta priors by moments.
_OP1 = r"""
WITH words AS (
  SELECT doc_id, source, text,
         list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 1))) AS i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows)
  WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), measured AS (
  SELECT doc_id, source AS host, len(w)::BIGINT AS n_words,
         length(regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM words LEFT JOIN covered USING (doc_id)
), ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > word_chars AS f_symbols, 2 * n_dup_lines > n_lines AS f_lines
  FROM measured
), hosts AS (
  SELECT host, count(*) AS n, sum(f_symbols::INT) AS symbols, sum(f_lines::INT) AS lines,
         sum((base_failed OR f_symbols OR f_lines)::INT) AS anyrule
  FROM ruled GROUP BY host
), rates AS (
  SELECT host, n, rule, failed, failed / n AS rate
  FROM hosts, LATERAL (SELECT unnest(['symbols', 'lines', 'any']) AS rule, unnest([symbols, lines, anyrule]) AS failed)
), priors AS (
  SELECT rule, avg(rate) AS m,
         least(greatest(CASE WHEN var_pop(rate) > 1e-12 THEN avg(rate) * (1 - avg(rate)) / var_pop(rate) - 1
                             ELSE 1000.0 END, 1.0), 1000.0) AS s
  FROM rates GROUP BY rule
), shrunk AS (
  SELECT host, max(CASE WHEN rule = 'symbols' THEN (failed + s * m) / (n + s) END) AS symbols,
         max(CASE WHEN rule = 'lines' THEN (failed + s * m) / (n + s) END) AS lines,
         max(CASE WHEN rule = 'any' THEN (failed + s * m) / (n + s) END) AS anyrule
  FROM rates JOIN priors USING (rule) GROUP BY host
), judged AS (
  SELECT r.*, h.anyrule >= 0.9 AS host_rejected,
         (h.symbols >= 0.01 AND f_symbols) OR (h.lines >= 0.01 AND f_lines) AS habit_failed
  FROM ruled r JOIN shrunk h ON r.host IS NOT DISTINCT FROM h.host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR host_rejected OR habit_failed) AS kept, host_rejected, habit_failed
FROM judged
"""

_OP5 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# Own rules first; then the rules of all urls that links reach, over any number of steps.
_OP9 = r"""
WITH RECURSIVE rules AS (
  SELECT * FROM (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'),
                        ('org/fr/', 'allow')) AS t(rule, verdict)
), tags AS (
  SELECT url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'),
                               lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')),
                   lambda x: trim(regexp_extract(x, '(?is)\bhref\s*=\s*["'']?([^"''>\s]*)', 1))),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'),
                               lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')),
                   lambda x: regexp_extract(regexp_extract(x, '(?is)\bcontent\s*=\s*"([^"]*)"', 1),
                                            '(?is)\burl\s*=\s*[''"]?([^''"]*)', 1)))) AS link
  FROM pages
), ends AS (
  SELECT url, CASE
      WHEN link = '' OR starts_with(link, '#') THEN NULL
      WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
      WHEN starts_with(link, '//') THEN regexp_extract(url, '(?s)^(.*?):', 1) || ':' || link
      WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || link
      ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
           || coalesce(nullif(regexp_extract(url, '(?s)^.*?://[^/?#]*((?:[^?#]*/)?)', 1), ''), '/') || link END AS target
  FROM tags WHERE link IS NOT NULL
), keys AS (
  SELECT lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)) || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS a,
         lower(regexp_extract(target, '(?s)^.*?://([^/?#]*)', 1)) || regexp_extract(target, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b
  FROM ends WHERE target LIKE '%://%' AND url LIKE '%://%'
), edges AS (
  SELECT a, b FROM keys WHERE a <> b UNION SELECT b, a FROM keys WHERE a <> b
), reach(node, other) AS (
  SELECT a, a FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
), judged_keys AS (
  SELECT k.other, (SELECT max_by(verdict, length(rule)) FROM rules
     WHERE (h = split_part(rule, '/', 1) OR ends_with(h, '.' || split_part(rule, '/', 1)))
       AND starts_with(p, substr(rule, length(split_part(rule, '/', 1)) + 1))) AS verdict
  FROM (SELECT DISTINCT other, regexp_extract(other, '^([^/?#]*)', 1) AS h,
               regexp_extract(other, '(?s)^[^/?#]*([^?#]*)', 1) AS p FROM reach) k
), blocked AS (
  SELECT node FROM reach JOIN judged_keys USING (other) GROUP BY node
  HAVING bool_or(verdict = 'block') AND NOT coalesce(bool_or(verdict = 'allow'), false)
), parsed AS (
  SELECT page_id, lower(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         CASE WHEN url LIKE '%://%' THEN lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1))
              || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS key
  FROM pages
), own AS (
  SELECT page_id, host, path, key,
    (SELECT max_by(rule, length(rule)) FROM rules
     WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
       AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1))) AS rule
  FROM parsed
)
SELECT page_id, host, path, rule,
       coalesce((SELECT verdict FROM rules WHERE rules.rule = own.rule),
                CASE WHEN key IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM own
"""

_OP11 = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_dot_product(a.v, c.v)::BIGINT AS score
  FROM whole a JOIN whole c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), hard AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
         p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 5
"""


def _tree(name: str, levels: int) -> str:
    """Nodes of ``name``0 (g, pos, h) rolled up ``levels`` times, with the hashes beside each node."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}{k}_beside AS (
  SELECT g, pos, h, count(*) OVER (PARTITION BY g) AS n,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{k} WINDOW run AS (PARTITION BY g, pos // 8 ORDER BY pos)
), {name}{k + 1} AS (
  SELECT g, pos // 8 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
  FROM {name}{k}_beside GROUP BY g, pos // 8
)""")
    return ", ".join(parts)


def _folds(source: str, name: str, levels: int, g: str, pos: str) -> tuple[str, str]:
    """CTEs that fold f of ``source`` level by level and collect what is beside; the last one's name."""
    parts = []
    for k in range(levels):
        parts.append(f"""fold_{name}{k} AS (
  SELECT s.* EXCLUDE (f, beside), CASE WHEN b.n > 1 THEN sha256(b.before || f || b.after) ELSE f END AS f,
         beside || b.before || b.after AS beside
  FROM {source} s JOIN {name}{k}_beside b ON b.g = s.{g} AND b.pos = s.{pos} // {8**k}
)""")
        source = f"fold_{name}{k}"
    return ", ".join(parts), source


# Levels enough for 8**6 documents of one lang and as many langs as 8**3.
_DOC_LEVELS, _LANG_LEVELS = 6, 3
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_DOC_FOLDS, _DOC_LAST = _folds("started", "docs", _DOC_LEVELS, "g", "pos")
_LANG_FOLDS, _LANG_LAST = _folds("climbed", "langs", _LANG_LEVELS, "all_langs", "lang_pos")
_OP12 = f"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
), leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("text")} AS h,
         {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS changed,
         xor(list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INTEGER + 1])), 4294967295::UBIGINT) % 3 = 0 AS tampered
  FROM documents, crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves
), docs0 AS (SELECT g, pos, h FROM placed), {_tree("docs", _DOC_LEVELS)}, subroots AS (
  SELECT g AS lang_g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS pos FROM docs{_DOC_LEVELS}
), langs0 AS (SELECT '' AS g, pos, h FROM subroots), {_tree("langs", _LANG_LEVELS)}, started AS (
  SELECT p.doc_id, p.g, p.pos, p.h AS leaf, s.h AS subroot, s.pos AS lang_pos, '' AS all_langs,
         CASE WHEN coalesce(tampered, false) THEN changed ELSE p.h END AS f, '' AS beside
  FROM placed p JOIN subroots s ON s.lang_g = p.g
), {_DOC_FOLDS}, climbed AS (SELECT * FROM {_DOC_LAST}), {_LANG_FOLDS}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(beside) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM {_LANG_LAST}, langs{_LANG_LEVELS} r
"""

ORACLE: dict[str, str] = {
    "op1_host_rules": _OP1,
    "op5_exact_topk": _OP5,
    "op9_url_aliases": _OP9,
    "op11_hard_negatives": _OP11,
    "op12_merkle_manifest": _OP12,
}
