"""Plain DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

from eventmart.llm import licenses, shards, urls

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _license_scan() -> str:
    rows = [(t, label, "true") for t, label in licenses.BASE_PHRASES] + [(t, label, "false") for t, label in licenses.NOTICES]
    templates = ", ".join(f"({n}, {_text(t)}, {_text(label)}, {exact})" for n, (t, label, exact) in enumerate(rows))
    k = licenses.K_WORDS
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
runs AS (
  SELECT r, p - 1 AS pos, array_to_string(w[p:p + {k - 1}], ' ') AS run
  FROM (SELECT r, w, unnest(range(1, len(w) - {k - 2})) AS p FROM docs)),
t AS (SELECT *, string_split(words, ' ') AS w FROM (VALUES {templates}) v(template, words, label, exact)),
t_runs AS (
  SELECT template, label, exact, len(w) - {k - 1} AS n_runs, p - 1 AS t_pos, array_to_string(w[p:p + {k - 1}], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - {k - 2})) AS p FROM t)),
votes AS (
  SELECT r, template, label, exact, n_runs, pos - t_pos AS diagonal, list(t_pos) AS matched, min(pos) AS first_word
  FROM runs JOIN t_runs USING (run) GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN exact OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {licenses.SLACK}, true)
            THEN 1 ELSE 0 END AS new FROM votes),
copies AS (
  SELECT r, template, label, exact, n_runs, copy, len(list_distinct(flatten(list(matched)))) AS covered, min(first_word) AS first_word
  FROM (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS copy FROM marked) GROUP BY ALL),
good AS (
  SELECT *, covered / n_runs AS share FROM copies
  WHERE CASE WHEN exact THEN covered = n_runs ELSE covered / n_runs >= {licenses.MIN_SHARE} END),
per AS (
  SELECT r, count(*) FILTER (exact) AS n_base, min(first_word) FILTER (exact) AS first_word, max(first_word) FILTER (exact) AS last_word,
         coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (exact))), ','), '') AS base_labels,
         array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) AS score
  FROM good GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(CAST(score AS DOUBLE), 0.0) AS score
FROM docs LEFT JOIN per USING (r)"""


def _url_filter() -> str:
    rules = ", ".join(f"({_text(h)}, {_text(p)}, {_text(v)})" for h, p, v in urls.RULES)
    return rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
parts AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM split),
rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
fits AS (
  SELECT r, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS n
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, '{urls.DEFAULT}') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (r)"""


def _near_dedup() -> str:
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[p:p + 2], ' ') FOR p IN range(1, len(w) - 1)]) END AS s FROM docs),
classes AS (SELECT min(doc_id) AS node, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY 2),
items AS (SELECT node, len(s) AS n, unnest(s) AS item FROM classes),
links AS (
  SELECT a.node AS a, b.node AS b FROM items a JOIN items b ON a.item = b.item AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (
  SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
named AS (SELECT node, least(node, coalesce(min(b), node)) AS component FROM classes LEFT JOIN reach ON a = node GROUP BY node),
of_set AS (SELECT s, component FROM classes JOIN named USING (node))
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
       coalesce(component, doc_id) = doc_id AS kept
FROM sets LEFT JOIN of_set ON list_sort(sets.s) = of_set.s"""


_TOP_K = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10"""


def _crc(byte: int) -> int:
    """What a byte adds to a running CRC-32."""
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


def _sharding() -> str:
    n, table = shards.SHARDS, "".join(f"{_crc(b):08x}" for b in range(256))
    return f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
bytes AS (
  SELECT r, doc_id, sha256(t) AS digest, strlen(t) + 1 AS size,
         [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(strlen(t))] AS bs
  FROM (SELECT *, hex(encode(t)) AS h FROM docs)),
sized AS (
  SELECT r, doc_id, digest, size,
         xor(list_reduce([CAST(4294967295 AS BIGINT)] || bs, lambda c, b: xor(c >> 8, CAST('0x' || '{table}'[8 * (xor(c, b) & 255) + 1:8 * (xor(c, b) & 255) + 8] AS BIGINT))), 4294967295) AS text_crc32
  FROM bytes),
g AS (SELECT digest, sum(size) AS b FROM sized GROUP BY digest),
ends AS (SELECT digest, CAST(sum(b) OVER (ORDER BY digest) AS BIGINT) AS e, CAST(b AS BIGINT) AS b FROM g),
limits AS (SELECT CAST(max(e) AS BIGINT) AS total, greatest(max(b), (max(e) + {n - 1}) // {n}) AS low FROM ends),
search(low, high, done, used) AS (
  SELECT CAST(low AS BIGINT), total, CAST(0 AS BIGINT), 0 FROM limits
  UNION ALL
  SELECT CASE WHEN used = {n} AND done < total THEN (s.low + s.high) // 2 + 1 ELSE s.low END,
         CASE WHEN done = total THEN (s.low + s.high) // 2 ELSE s.high END,
         CASE WHEN done = total OR used = {n} THEN 0
              ELSE (SELECT max(e) FROM ends WHERE e <= s.done + (s.low + s.high) // 2) END,
         CASE WHEN done = total OR used = {n} THEN 0 ELSE used + 1 END
  FROM search s, limits WHERE s.low < s.high),
capacity AS (SELECT min(high) AS c FROM search WHERE low = high),
cuts(shard, done, upto) AS (
  SELECT 0, CAST(0 AS BIGINT), (SELECT max(e) FROM ends, capacity WHERE e <= c)
  UNION ALL
  SELECT shard + 1, upto, (SELECT max(e) FROM ends, capacity WHERE e <= cuts.upto + c) FROM cuts, limits WHERE upto < total),
placed AS (SELECT digest, shard FROM ends JOIN cuts ON e > done AND e <= upto)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY digest, ((doc_id % 64) + 64) % 64, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sized JOIN placed USING (digest)"""


_FILTER_AUDIT = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT part,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 'E' ELSE '' END AS fails,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS bad
  FROM d),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_toxic FROM f GROUP BY ALL),
orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x) WHERE length(o) < 5 AND NOT contains(o, x)),
steps AS (SELECT o AS filter_order, s AS step, o[s:s] AS f, o[1:s - 1] AS earlier
          FROM orders, (VALUES (1), (2), (3), (4), (5)) v(s) WHERE length(o) = 5),
met AS (SELECT part, filter_order, step, f, fails, n, n_good, n_toxic, contains(fails, f) AS hit,
               length(translate(fails, earlier, '')) < length(fails) AS gone FROM cells, steps),
counted AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND hit THEN n_good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND hit THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""


def _conversation_trie() -> str:
    table = "".join(f"{_crc(b):08x}" for b in range(256))
    crc = ("xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(c AS VARCHAR), '')], "
           f"lambda a, b: xor(a >> 8, CAST('0x' || '{table}'[8 * (xor(a, b) & 255) + 1:8 * (xor(a, b) & 255) + 8] AS BIGINT))), 4294967295)")
    return rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT c, c - c % 20 AS b, {crc} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
turns AS (
  SELECT c.c, 0 AS own, t.p, t.role, t.text FROM c JOIN t ON t.c = c.b AND t.p <= c.h
  UNION ALL SELECT c.c, 1, t.p, t.role, t.text FROM c JOIN t ON t.c = c.c AND t.p > c.h),
numbered AS (
  SELECT *, sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS digest,
         row_number() OVER (PARTITION BY c ORDER BY own, p) AS d, count(*) OVER (PARTITION BY c) AS n FROM turns),
paths AS (
  SELECT c, d, n, len(regexp_extract_all(text, '[^ 	-]+')) AS words, string_agg(digest, '') OVER (PARTITION BY c ORDER BY d) AS key
  FROM numbered
  UNION ALL SELECT c.c, 0, coalesce(max(numbered.n), 0), 0, '' FROM c LEFT JOIN numbered ON numbered.c = c.c GROUP BY c.c),
nodes AS (
  SELECT key, min(c) AS conv_id, min(d) AS depth, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
         sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
  FROM paths GROUP BY key),
kids AS (SELECT substr(key, 1, length(key) - 64) AS up, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.key),
above AS (SELECT substr(key, 1, CAST(64 * a AS INTEGER)) AS key, saved, n_children FROM (
  SELECT *, unnest(range(depth + 1)) AS a FROM full_nodes)),
under AS (SELECT key, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM above GROUP BY key)
SELECT CAST(v.conv_id AS BIGINT) AS conv_id, CAST(v.depth AS BIGINT) AS depth, CAST(up.conv_id AS BIGINT) AS parent_conv_id,
       CAST(v.n_convs AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children, CAST(under.n_leaves AS BIGINT) AS n_leaves,
       CAST(under.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM full_nodes v JOIN under ON under.key = v.key
LEFT JOIN nodes up ON v.depth > 0 AND up.key = substr(v.key, 1, length(v.key) - 64)"""


def oracle_statements() -> dict[str, str]:
    return {
        "op2_license_scan": _license_scan(),
        "op5_url_filter": _url_filter(),
        "op6_minhash_near_dedup": _near_dedup(),
        "op8_exact_top_k": _TOP_K,
        "op10_sharding": _sharding(),
        "op11_filter_audit": _FILTER_AUDIT,
        "op13_conversation_trie": _conversation_trie(),
    }
