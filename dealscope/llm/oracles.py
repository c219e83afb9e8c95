"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

from .url_filter import RULES, Vocabulary

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _url_filter() -> str:
    """Rules and terms as relations; a term stands alone between other characters."""
    terms = Vocabulary()
    rules = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in RULES.items())
    words = ", ".join(
        [f"('{t}', TRUE)" for t in terms.strict] + [f"('{t}', FALSE)" for t in terms.soft]
    )
    return f"""
        WITH rules(rule, verdict) AS (VALUES {rules}),
        terms(term, strict) AS (VALUES {words}),
        cut AS (
          SELECT page_id, translate(url, {_LOWER}) AS low,
            CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END
              AS rest
          FROM pages),
        hosts AS (
          SELECT page_id, low, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw_host
          FROM cut),
        parts AS (
          SELECT page_id, low, translate(raw_host, {_LOWER}) AS host,
            regexp_extract(substr(coalesce(rest, ''), length(raw_host) + 1), '^[^?#]*') AS path
          FROM hosts),
        fitting AS (
          SELECT page_id, arg_max(rule, length(rule)) AS rule,
            arg_max(verdict, length(rule)) AS verdict
          FROM parts JOIN rules
            ON ('.' || host) LIKE ('%.' || split_part(rule, '/', 1))
            AND starts_with(path, substr(rule, strpos(rule, '/')))
          GROUP BY page_id),
        hits AS (
          SELECT page_id, count(*) FILTER (strict) AS n_strict,
            count(*) FILTER (NOT strict) AS n_soft
          FROM parts JOIN terms
            ON regexp_matches(low, '(^|[^\\pL\\pN])' || term || '($|[^\\pL\\pN])')
          GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN n_strict > 0
            OR n_soft >= {terms.soft_limit} THEN 'block' ELSE 'allow' END) AS verdict,
          coalesce(n_strict, 0) AS n_strict, coalesce(n_soft, 0) AS n_soft
        FROM parts LEFT JOIN fitting USING (page_id) LEFT JOIN hits USING (page_id)"""


# Every window of every document is compared with every window of the items.
_DECONTAMINATION = f"""
    WITH doc_words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
        '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
      FROM documents),
    item_words AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
        '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
      FROM benchmark),
    item_starts AS (
      SELECT item_id, w, least(10, len(w)) AS n, unnest(range(len(w) - least(10, len(w)) + 1)) AS i
      FROM item_words WHERE len(w) > 0),
    spans AS (
      SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS span FROM item_starts),
    sizes AS (SELECT DISTINCT n FROM spans),
    doc_starts AS (
      SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i
      FROM doc_words JOIN sizes ON len(w) >= n),
    doc_spans AS (
      SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS span FROM doc_starts),
    found AS (SELECT doc_id, n, i, item_id FROM doc_spans JOIN spans USING (n, span)),
    covered AS (
      SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
    named AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found),
    listed AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM named GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
      coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)"""

# CRC-32 of a decimal number's characters, bit by bit. Prefixes are lists of turns.
_CRC_BIT = "xor(c // 2, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)"
_CONVERSATION_TRIE = f"""
    WITH said AS (
      SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS size,
        md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '')
          || coalesce(text, '')) AS digest
      FROM conversations WHERE conv_id IS NOT NULL),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1
        AS pos
      FROM said),
    convs AS (
      SELECT DISTINCT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base,
        xor(list_reduce(list_prepend(4294967295::BIGINT,
          list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
          lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, k: {_CRC_BIT})),
          4294967295::BIGINT) % 9 AS head
      FROM said),
    rebuilt AS (
      SELECT c.conv_id, n.pos, n.digest, n.size
      FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.pos < c.head
      UNION ALL
      SELECT c.conv_id, n.pos, n.digest, n.size
      FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos >= c.head),
    paths AS (
      SELECT c.conv_id, coalesce(list(digest ORDER BY pos) FILTER (digest IS NOT NULL), []) AS path,
        coalesce(list(size ORDER BY pos) FILTER (digest IS NOT NULL), []) AS sizes
      FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
    steps AS (SELECT *, unnest(range(len(path) + 1)) AS depth FROM paths),
    nodes AS (
      SELECT depth, path[1 : depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
        any_value(CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END) AS size,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
          FILTER (len(path) = depth), '')) AS ends_sha256
      FROM steps GROUP BY depth, prefix),
    families AS (
      SELECT c.prefix[1 : c.depth - 1] AS prefix, count(*) AS n_children
      FROM nodes c WHERE c.depth > 0 GROUP BY 1),
    leaves AS (
      SELECT n.*, coalesce(f.n_children, 0) AS n_children
      FROM nodes n LEFT JOIN families f USING (prefix)),
    above AS (SELECT *, unnest(range(depth + 1)) AS d FROM leaves),
    sums AS (
      SELECT prefix[1 : d] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
        CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens
      FROM above GROUP BY 1)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
      s.n_leaves, s.saved_tokens, n.ends_sha256
    FROM leaves n JOIN sums s USING (prefix)
    LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1 : n.depth - 1]"""

ORACLES: dict[str, str] = {
    "op2_url_filter": _url_filter(),
    "op5_decontamination": _DECONTAMINATION,
    "op13_conversation_trie": _CONVERSATION_TRIE,
}
