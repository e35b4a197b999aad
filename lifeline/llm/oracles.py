"""DuckDB restatements of the queries that SQL can express, over whole tables."""

from __future__ import annotations

import re

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _FOLD.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def decontaminate(width: int, min_share: int) -> str:
    """Windows of every length that an item has, joined on their words.
    Words are rows and each carries the next ones, so long texts stay linear."""
    ahead = f"list(word) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND {width - 1} FOLLOWING)"
    return f"""WITH
item_words AS (SELECT row_number() OVER () AS k, item_id, {_WORDS} AS w FROM benchmark),
item_rows AS (SELECT k, least({width}, len(w)) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM item_words),
item_ahead AS (SELECT k, n, {ahead} AS said FROM item_rows),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(said, ' ') AS said
  FROM item_ahead JOIN item_words USING (k) WHERE len(said) = n),
doc_words AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
doc_rows AS (SELECT k, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
doc_ahead AS (SELECT k, i, {ahead} AS said FROM doc_rows),
found AS (
  SELECT d.k, d.i, d.n, x.item_id
  FROM (SELECT k, i, n, array_to_string(said[1 : n], ' ') AS said
        FROM doc_ahead, (SELECT DISTINCT n FROM windows) AS lengths WHERE len(said) >= n) AS d
  JOIN windows AS x ON d.said = x.said AND d.n = x.n),
hit AS (
  SELECT k, count(DISTINCT place) AS n_hit
  FROM (SELECT k, unnest(range(i, i + n)) AS place FROM found) GROUP BY k),
items AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.listed, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND {min_share} * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words AS d LEFT JOIN hit AS h USING (k) LEFT JOIN items AS t USING (k)"""


def url_rules(rules, default: str) -> str:
    """Every rule that fits a URL, the longest kept."""
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in rules)
    host = _FOLD.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")
    return f"""WITH
rules(on_host, on_path, verdict) AS (VALUES {values}),
urls AS (
  SELECT page_id, row_number() OVER () AS k, {host} AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages)
SELECT u.page_id, u.host, u.path, r.on_host || r.on_path AS rule, coalesce(r.verdict, '{default}') AS verdict
FROM urls AS u LEFT JOIN rules AS r
  ON (u.host = r.on_host OR ends_with(u.host, '.' || r.on_host)) AND starts_with(u.path, r.on_path)
QUALIFY row_number() OVER (PARTITION BY u.k ORDER BY length(r.on_host || r.on_path) DESC NULLS LAST) = 1"""


def chats(extra: str, control) -> str:
    """Conversations by their rows alone: lengths follow from the template and
    from a character more for each control string inside a text."""
    tails = "|".join(re.escape(c[1:]) for c in control).replace("'", "''")
    marked = lambda col: f"len(regexp_extract_all({col}, '[<\\[]\\\\*(?:{tails})'))"
    role = "replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')"
    ends = len("<|im_start|>") + len("\n") + len("<|im_end|>\n")
    return f"""WITH
said AS (
  SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL VALUES (-1, 0, 'user', '{extra}'), (-1, 1, 'assistant', '{extra}')),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM said)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({ends} + length({role}) + {marked(role)} + length(text) + {marked("text")}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


def merkle(arity: int, fields) -> str:
    """All nodes of all levels, then every leaf climbs to the root run by run."""

    def leaf(text: str = "text") -> str:
        values = [f"CAST({text if f == 'text' else f} AS VARCHAR)" for f in fields]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    def forest(name: str, leaves: str) -> str:
        """Runs of sibling nodes of every level that has several."""
        return f"""
{name}_nodes(tree, level, run, place, digest, n) AS (
  {leaves}
  UNION ALL
  SELECT tree, any_value(level) + 1, run // {arity}, run % {arity}, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + {arity - 1}) // {arity}
  FROM {name}_nodes WHERE n > 1 GROUP BY tree, run),
{name}_runs AS (SELECT tree, level, run, list(digest ORDER BY place) AS run_digests FROM {name}_nodes WHERE n > 1 GROUP BY ALL)"""

    def climb(name: str, forest: str, starts: str) -> str:
        """k, tree, level, index, node now, siblings so far."""
        before, after = "list_slice(run_digests, 1, index % {0})", "list_slice(run_digests, index % {0} + 2, {0})"
        left, right = (f"array_to_string({x.format(arity)}, '')" for x in (before, after))
        return f"""
{name}(k, tree, level, index, node, siblings) AS (
  {starts}
  UNION ALL
  SELECT k, c.tree, c.level + 1, index // {arity}, sha256({left} || node || {right}), siblings || {left} || {right}
  FROM {name} AS c JOIN {forest}_runs AS r ON r.tree = c.tree AND r.level = c.level AND r.run = index // {arity}),
{name}_end AS (SELECT k, tree, arg_max(node, level) AS node, arg_max(siblings, level) AS siblings FROM {name} GROUP BY k, tree)"""

    # the last bit of a checksum, bit by bit; its complement is the last bit of the state
    step = "list_reduce(range(8), lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b))"
    codes = "list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda s: CAST(ascii(s) AS BIGINT))"
    even = f"list_reduce({codes}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)) & 1 = 1"
    changed = f"CASE WHEN {even} THEN replace(text, chr(10), '') ELSE text END"
    start = "SELECT {0}, {1}, 0, {2}, {3}, '' FROM {4}"
    return f"""WITH RECURSIVE
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS index, count(*) OVER (PARTITION BY tree) AS n
  FROM (SELECT row_number() OVER () AS k, doc_id, coalesce('+' || source, '') AS tree, {leaf()} AS leaf, {leaf(changed)} AS later FROM documents)),
{forest("doc", f"SELECT tree, 0, index // {arity}, index % {arity}, leaf, n FROM leaves").strip()},
subroots AS (
  SELECT tree AS source_key, digest, row_number() OVER (ORDER BY tree) - 1 AS index, count(*) OVER () AS n FROM doc_nodes WHERE n = 1),
{forest("source", f"SELECT '', 0, index // {arity}, index % {arity}, digest, n FROM subroots").strip()},
{climb("source_climb", "source", start.format("source_key", "''", "index", "digest", "subroots")).strip()},
{climb("climb", "doc", start.format("k", "tree", "index", "leaf", "leaves")).strip()},
{climb("later_climb", "doc", start.format("k", "tree", "index", "later", "leaves")).strip()},
{climb("later_up", "source", start.format("e.k", "''", "s.index", "e.node", "later_climb_end AS e JOIN subroots AS s ON s.source_key = e.tree")).strip()}
SELECT d.doc_id, d.leaf, e.node AS subroot, s.node AS root, sha256(e.siblings || s.siblings) AS proof_sha256, l.node AS folded_root, l.node = s.node AS verified
FROM leaves AS d JOIN climb_end AS e USING (k) JOIN source_climb_end AS s ON s.k = d.tree JOIN later_up_end AS l ON l.k = d.k"""


def hard_negatives(positives: int, negatives: int) -> str:
    """Every anchor against every row."""
    return f"""WITH
usable AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.k, a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM usable AS a JOIN usable AS r ON a.k <> r.k WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT k, anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY k ORDER BY score DESC, other_id) AS p
  FROM scored WHERE same QUALIFY p <= {positives}),
negative AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.k, p.p ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM positive AS p JOIN scored AS s ON s.k = p.k AND NOT s.same
  WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= {negatives}"""
