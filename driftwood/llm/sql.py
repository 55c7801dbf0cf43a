"""DuckDB SQL for the queries that SQL can express on whole tables."""

_SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_SPACE_WORDS} AS w FROM documents),
p AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50 AND doc_id IS NOT NULL),
x AS MATERIALIZED (SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS least FROM x GROUP BY h),
s AS (SELECT r, i FROM x JOIN f USING (h) WHERE doc_id > least),
gone AS (SELECT r, list(DISTINCT j) AS js FROM (SELECT r, unnest(range(i, i + 50)) AS j FROM s) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE list_filter(w, lambda y, k: NOT list_contains(js, k)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
q AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + 12], ' ') AS win
      FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM q),
x AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT r, w, n.n, unnest(range(1, len(w) - n.n + 2)) AS i FROM d JOIN n ON len(w) >= n.n)),
m AS MATERIALIZED (SELECT r, i, x.n, item FROM x JOIN q ON x.n = q.n AND x.win = q.win),
hit AS (SELECT r, count(DISTINCT j) AS k FROM (SELECT r, unnest(range(i, i + n)) AS j FROM m) GROUP BY r),
its AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(k, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, (coalesce(k, 0) > 0 AND 20 * coalesce(k, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

OP7 = r"""
WITH rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
a AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT r, page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path FROM a),
w AS (SELECT r, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
      FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN w USING (r)
"""

OP11 = """
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS MATERIALIZED (SELECT r, vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                    AND list_sum(list_transform(e, lambda x: abs(x))) > 0),
p AS MATERIALIZED (SELECT a.r, b.r AS s FROM ok a JOIN ok b ON a.r <> b.r AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT r, r AS s FROM ok UNION SELECT x.r, p.s FROM reach x JOIN p ON x.s = p.r),
c AS (SELECT reach.r, min(vec_id) AS c FROM reach JOIN ok ON ok.r = reach.s GROUP BY reach.r),
n AS (SELECT r, count(*) AS n FROM p GROUP BY r)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, CASE WHEN c.r IS NULL THEN vec_id ELSE c END AS component_id,
       vec_id IS NOT DISTINCT FROM (CASE WHEN c.r IS NULL THEN vec_id ELSE c END) AS kept
FROM v LEFT JOIN c USING (r) LEFT JOIN n USING (r)
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string: every byte is XORed in, then eight shifts follow (-1)."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda b: [ord(b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, x: {step}), 4294967295)"


# a state of the repair: cost, edits so far, lines so far; the least one by (cost, edits) is kept
def _edit(state: str, cost: str, letter: str, line: str = "") -> str:
    lines = f"list_append({state}.o, {line})" if line else f"{state}.o"
    return f"CASE WHEN {state} IS NULL THEN NULL ELSE {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {lines}}} END"


def _filled(at: str) -> tuple[str, ...]:
    """The four states with empty turns inserted where that is cheaper."""
    s = [f"{at}[{k}]" for k in range(1, 5)]
    user = f"list_min([{s[2]}, {', '.join(_edit(x, '3', 'I', chr(39) + 'user:' + chr(39)) for x in (s[0], s[1], s[3]))}])"
    return s[0], s[1], user, s[3]


def _spoken(at: str) -> str:
    """The state after an assistant turn, from filled states with the user turn in third place."""
    return f"list_min([{at}[4], " + _edit(f"{at}[3]", "3", "I", "'assistant:'") + "])"


def _read(at: str) -> str:
    """The four states after row x was deleted, kept or given another role."""
    late, may = "(CASE WHEN x.f = 3 THEN 3 ELSE 0 END)", "x.f NOT IN (1, 2)"
    s = [f"{at}[{k}]" for k in range(1, 5)]
    out = [[_edit(t, "4", "D")] for t in s]
    for a, b, i in ((0, 1, "s"), (0, 2, "u"), (1, 2, "u"), (3, 2, "u"), (2, 3, "a")):
        out[b].append(f"CASE WHEN {may} AND x.i = '{i}' THEN {_edit(s[a], late, 'K', 'x.l')} END")
    for a, b, role in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant")):
        out[b].append(f"CASE WHEN {may} THEN {_edit(s[a], f'3 + {late}', 'R', chr(39) + role + ':' + chr(39) + ' || x.t')} END")
    return "[" + ", ".join(f"list_min([{', '.join(o)}])" for o in out) + "]"


_STATE = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])"
_ROW = f"STRUCT(i VARCHAR, f INTEGER, l VARCHAR, t VARCHAR, k {_STATE}[])"
_BARE = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"
# one list per name, so that nothing is computed twice: lists of one element stand for names
_USER = "list_transform([c.k], lambda z: [" + ", ".join(_filled("z")) + "])[1]"
_BOTH = f"list_transform([{_USER}], lambda z: [z[1], z[2], z[3], {_spoken('z')}])[1]"
_STEP = f"list_transform([{_BOTH}], lambda z: {_read('z')})[1]"
_CLOSED = _BOTH.replace("c.k", "q.k")

OP12 = f"""
WITH a AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
b AS MATERIALIZED (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                          CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                          unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM a),
m AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n FROM b),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS seen, {_BARE} AS bare FROM m),
f AS MATERIALIZED (SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before,
                          CASE WHEN bare = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (f = 1) AS blank,
             count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
             list({{'i': i, 'f': f, 'l': role || ':' || text, 't': text, 'k': NULL}}::{_ROW} ORDER BY n) AS turns FROM f GROUP BY conv_id),
r AS (SELECT *, list_reduce(list_prepend({{'i': '', 'f': 0, 'l': '', 't': '',
             'k': [{{'c': 0, 'a': '', 'o': []}}, NULL, NULL, NULL]}}::{_ROW}, turns),
             lambda c, x: {{'i': '', 'f': 0, 'l': '', 't': '', 'k': {_STEP}}}::{_ROW}) AS q FROM g),
d AS (SELECT *, list_transform([{_CLOSED}], lambda z: list_min([z[1], z[4]]))[1] AS w FROM r)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(array_to_string(w.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN d ON i.conv_id IS NOT DISTINCT FROM d.conv_id
"""


def _leaf(text: str) -> str:
    part = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    return "sha256(" + " || ".join(part(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, leaves: str) -> str:
    """All nodes (g, k, j, node) of the trees over ``leaves`` (g, j, node); a level of several nodes has one above it."""
    return f"""{name} AS (SELECT g, 0 AS k, j, node, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
UNION ALL (WITH up AS (SELECT g, k + 1 AS k, j // 3 AS j, sha256(string_agg(node, '' ORDER BY j)) AS node FROM {name} WHERE n > 1 GROUP BY g, k, j // 3)
           SELECT *, count(*) OVER (PARTITION BY g) AS n FROM up))"""


def _siblings(name: str, nodes: str) -> str:
    beside = lambda way: f"coalesce(string_agg(b.node, '' ORDER BY b.j) FILTER (b.j {way} a.j), '')"
    return f"""{name} AS MATERIALIZED (SELECT a.g, a.k, a.j, {beside('<')} AS l, {beside('>')} AS r
FROM {nodes} a JOIN {nodes} b ON a.g = b.g AND a.k = b.k AND a.j // 3 = b.j // 3 WHERE a.n > 1 GROUP BY a.g, a.k, a.j)"""


OP13 = f"""
WITH RECURSIVE s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT source FROM documents)),
h AS MATERIALIZED (SELECT doc_id, source, {_leaf("text")} AS leaf,
                          CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS now FROM documents),
x AS MATERIALIZED (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j, doc_id, leaf AS node, now
                   FROM h JOIN s ON h.source IS NOT DISTINCT FROM s.source),
{_levels("t", "x")},
sub AS MATERIALIZED (SELECT g, node FROM t WHERE n = 1),
y AS (SELECT 0 AS g, g AS j, node FROM sub),
{_levels("u", "y")},
top AS (SELECT node AS root FROM u WHERE n = 1),
{_siblings("ts", "t")},
{_siblings("us", "u")},
w AS (SELECT x.g, x.j, list({{'l': l, 'r': r}} ORDER BY k) AS p FROM x JOIN ts ON x.g = ts.g AND ts.j = x.j // (3 ** ts.k)::BIGINT GROUP BY x.g, x.j),
z AS (SELECT y.j AS g, list({{'l': l, 'r': r}} ORDER BY k) AS p FROM y JOIN us ON us.j = y.j // (3 ** us.k)::BIGINT GROUP BY y.j),
e AS (SELECT doc_id, x.node AS leaf, sub.node AS subroot, root, now, list_concat(coalesce(w.p, []), coalesce(z.p, [])) AS p
      FROM x JOIN sub ON x.g = sub.g CROSS JOIN top LEFT JOIN w ON w.g = x.g AND w.j = x.j LEFT JOIN z ON z.g = x.g),
f AS (SELECT *, list_reduce(list_prepend({{'l': now, 'r': ''}}, p), lambda c, q: {{'l': sha256(q.l || c.l || q.r), 'r': ''}}).l AS folded_root FROM e)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda q: q.l || q.r), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
"""

ORACLES = {"op2_fixed_block_anchors": OP2, "op3_aho_corasick": OP3, "op7_blocked_bloom": OP7,
           "op11_metric_range_join": OP11, "op12_conversation_repair": OP12, "op13_merkle_manifest": OP13}
