"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

from .queries import DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, MIX

WORD = r"'[^\x20\x09-\x0D]+'"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: All pairs of documents that share a shingle, then everything reachable.
NEAR_DUPLICATES = f"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORD}) AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN [w[1]] ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS g FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT both_ways.b, reach.other FROM reach JOIN both_ways ON both_ways.a = reach.doc),
least_id AS (SELECT doc, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least_id ON doc = d.doc_id LEFT JOIN sizes USING (doc_id)
"""


def _share(level: int) -> str:
    """Water filling of each parent's budget among the nodes of one level."""
    own = [f"l{i}" for i in range(level + 1)]
    above = ", ".join(own[:-1]) or "1"
    order = f"PARTITION BY {above} ORDER BY supply / weight, {own[-1]}"
    weight = {
        0: "CASE l0 " + " ".join(f"WHEN {d} THEN {w}" for d, w in DOMAIN_WEIGHTS) + " ELSE 1.0 END",
        1: "CASE WHEN l0 IS NOT NULL THEN CASE l1 " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in LANGUAGE_WEIGHTS.items()) + " ELSE 1.0 END ELSE 1.0 END",
        2: "1.0",
    }[level]
    join = " AND ".join(f"n.{c} IS NOT DISTINCT FROM p.{c}" for c in own[:-1]) or "true"
    return f"""
nodes{level} AS (SELECT n.*, p.budget FROM (SELECT *, CAST({weight} AS DOUBLE) AS weight FROM (SELECT {', '.join(own)}, sum(supply) AS supply FROM leaves GROUP BY ALL)) n JOIN budget{level} p ON {join}),
ranked{level} AS (SELECT *, budget - coalesce(sum(supply) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS to_come FROM nodes{level}),
marked{level} AS (SELECT *, supply * to_come <= weight * rest AS exhausted FROM ranked{level}),
budget{level + 1} AS (SELECT {', '.join(own)}, CASE WHEN exhausted THEN CAST(supply AS DOUBLE)
  ELSE weight * (arg_min(rest / to_come, supply / weight) FILTER (NOT exhausted) OVER (PARTITION BY {above})) END AS budget FROM marked{level}),"""


def _draw(value: str) -> str:
    return f"CAST('0x' || substr(md5('{MIX['seed']}:' || coalesce(CAST({value} AS VARCHAR), '')), 1, 15) AS BIGINT)"


BUDGET_MIX = f"""
WITH words AS (SELECT doc_id, lang, source, TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 AS l0, lang AS l1, source AS l2,
  CAST(len(regexp_extract_all(coalesce(text, ''), {WORD})) AS BIGINT) AS tokens, {_draw('doc_id')} AS draw, {_draw('text')} AS tie FROM documents),
docs AS (SELECT * FROM words WHERE tokens > 0),
leaves AS (SELECT l0, l1, l2, CAST(sum(tokens) AS BIGINT) AS tokens, CAST({MIX['max_epochs']} * sum(tokens) AS BIGINT) AS supply FROM docs GROUP BY ALL),
budget0 AS (SELECT CAST(least(sum(supply), floor(sum(tokens) * {MIX['budget_share']})) AS DOUBLE) AS budget FROM leaves),
{''.join(map(_share, range(3)))}
quotas AS (SELECT l.*, least(CAST(round(b.budget) AS BIGINT), l.supply) AS quota FROM leaves l JOIN budget3 b
  ON l.l0 IS NOT DISTINCT FROM b.l0 AND l.l1 IS NOT DISTINCT FROM b.l1 AND l.l2 IS NOT DISTINCT FROM b.l2),
placed AS (SELECT d.*, quota // q.tokens AS whole, quota % q.tokens AS rest, coalesce(sum(d.tokens) OVER
  (PARTITION BY d.l0, d.l1, d.l2 ORDER BY draw, tie RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
  - sum(d.tokens) OVER (PARTITION BY d.l0, d.l1, d.l2, draw, tie) AS begins
  FROM docs d JOIN quotas q ON d.l0 IS NOT DISTINCT FROM q.l0 AND d.l1 IS NOT DISTINCT FROM q.l1 AND d.l2 IS NOT DISTINCT FROM q.l2)
SELECT doc_id, lang, source, CAST(whole + CAST(begins < rest AS INTEGER) AS BIGINT) AS epochs FROM placed WHERE whole + CAST(begins < rest AS INTEGER) > 0
"""

#: Equal texts by a window over the texts themselves.
EXACT_DUPLICATES = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
ranked AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS nth FROM texts)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(t) AS text_sha256 FROM ranked
"""

#: The checksum of a decimal id: each byte is mixed in, then eight single-bit steps.
CRC32 = """xor(list_reduce([4294967295::UBIGINT] || flatten([[ascii(c)::UBIGINT] || [x::UBIGINT FOR x IN [256,256,256,256,256,256,256,256]] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda acc, x: CASE WHEN x < 256 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384::UBIGINT * (acc & 1)) END), 4294967295::UBIGINT)"""


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _tree(name: str, start: str) -> str:
    """All nodes over the lowest level ``start`` (g, idx, n, h), level by level."""
    return f"""{name}(g, lvl, idx, n, h) AS (SELECT g, 0, idx, n, h FROM ({start}) UNION ALL
  SELECT g, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY g, lvl, idx // 2, n)"""


#: A leaf's path is every node whose index differs from its own ancestor's in the last bit;
#: folding goes up level by level.
MERKLE = f"""
WITH RECURSIVE raw AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
  {_leaf(f"n_chars + CAST({CRC32} % 7 = 0 AS INTEGER)")} AS claimed FROM documents),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY lang) AS n FROM raw),
{_tree('nodes', 'SELECT g, idx, n, leaf AS h FROM ranked')},
subroots AS (SELECT g, lvl AS top, h FROM nodes WHERE n = 1),
{_tree('upper', 'SELECT 0 AS g, g AS idx, (SELECT count(*) FROM subroots) AS n, h FROM subroots')},
root AS (SELECT h AS root, lvl AS height FROM upper WHERE n = 1),
whole AS (SELECT g, lvl, idx, h FROM nodes),
steps AS (SELECT r.doc_id, r.g, w.lvl AS lvl, (r.idx >> w.lvl) & 1 AS slot, w.h AS sib FROM ranked r JOIN whole w ON w.g = r.g AND w.idx = xor(r.idx >> w.lvl, 1)
  UNION ALL SELECT r.doc_id, r.g, 1000 + u.lvl, (r.g >> u.lvl) & 1, u.h FROM ranked r JOIN upper u ON u.idx = xor(r.g >> u.lvl, 1)),
proofs AS (SELECT doc_id, sha256(string_agg(sib, '' ORDER BY lvl)) AS proof_sha256 FROM steps GROUP BY 1),
climbs AS (SELECT r.doc_id, s.top, s.top + root.height AS height, coalesce(r.claimed, r.leaf) AS h FROM ranked r JOIN subroots s USING (g) CROSS JOIN root),
folds(doc_id, lvl, top, height, h) AS (SELECT doc_id, 0, top, height, h FROM climbs UNION ALL
  SELECT f.doc_id, f.lvl + 1, f.top, f.height, sha256(CASE WHEN s.slot = 1 THEN s.sib || f.h ELSE f.h || coalesce(s.sib, '') END)
  FROM folds f LEFT JOIN steps s ON s.doc_id = f.doc_id AND s.lvl = CASE WHEN f.lvl < f.top THEN f.lvl ELSE 1000 + f.lvl - f.top END WHERE f.lvl < f.height)
SELECT r.doc_id, r.leaf, s.h AS subroot, root.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.root AS verified
FROM ranked r JOIN subroots s USING (g) CROSS JOIN root LEFT JOIN proofs p USING (doc_id) JOIN folds f ON f.doc_id = r.doc_id AND f.lvl = f.height
"""

ORACLE_SQL: dict[str, str] = {"op2_bbit_minhash": NEAR_DUPLICATES, "op3_budget_mix": BUDGET_MIX, "op11_merkle_manifest": MERKLE, "op13_chunk_recipes": EXACT_DUPLICATES}
