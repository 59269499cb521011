"""The registered queries as plain SQL, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from affinis.plans.queries import FOLDS, MAX_TEST, PUSH_ROUNDS, WALK_ROUNDS

#: 0.8^94 is the first even power of 0.8 below 1e-9.
MOVES = 94

RAW = """raw AS (
  SELECT o_custkey AS u, l_partkey AS i, l_quantity AS r, o_orderdate AS ts
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""

RATES = RAW + """,
rates AS (SELECT u, i, greatest(0e0, max(r)) AS r, min(ts) AS ts FROM raw GROUP BY u, i)"""

DENSE = """rates AS (
  SELECT DISTINCT user_id AS u, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS i FROM events)"""

EVENT_RATES = """rates AS (
  SELECT u, i, greatest(0e0, max(r)) AS r, min(ts) AS ts FROM (
    SELECT user_id AS u, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS i, value + 0e0 AS r, ts FROM events)
  GROUP BY u, i)"""


def _held(start: int, stop: int, cap: str = "") -> str:
    return f"""
ordered AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY ts, i) AS place FROM rates),
parted AS (SELECT *, place BETWEEN {start} AND {stop} {cap} AS held FROM ordered)"""


TRAIN_TEST = _held(1, 10) + """,
train AS (SELECT u, i, r, ts FROM parted WHERE NOT held),
test AS (SELECT u, i FROM parted WHERE held)"""


def _members(key: str, member: str, key_name: str, name: str) -> str:
    return f"""WITH {RAW}, d AS (SELECT DISTINCT u, i, {member} // 4096 AS s FROM raw)
SELECT {key} AS "{key_name}", s AS segment, CAST(count(*) AS INTEGER) AS n,
       string_agg(CAST({member} AS VARCHAR), ',' ORDER BY {member}) AS {name}
FROM d GROUP BY {key}, s"""


def _both(sims: str, score: str) -> str:
    return f"SELECT i, j, {score} FROM {sims} UNION ALL SELECT j, i, {score} FROM {sims}"


def _top(name: str, sims: str, score: str, k: int, directed: bool = False) -> str:
    rows = f"SELECT i, j, {score} FROM {sims}" if directed else _both(sims, score)
    return f"""
{name} AS (
  SELECT i, j, {score} AS s, CAST(n AS INTEGER) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY {score} DESC, j) AS n FROM ({rows}))
  WHERE n <= {k})"""


def _to_40_bits(value: str) -> str:
    """A double without its last 13 bits: equal quotients with different rounding errors are one number."""
    return f"(({value}) * 8193) - ((({value}) * 8193) - ({value}))"


def _cosine(t: str, product: str = "least(a.r, b.r)") -> str:
    return f"""
weight AS (SELECT i, sum(r) AS w FROM {t} GROUP BY i HAVING sum(r) > 0),
shared AS (
  SELECT a.i AS i, b.i AS j, sum({product}) AS total
  FROM {t} a JOIN {t} b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i),
quotient AS (
  SELECT s.i, s.j, s.total / sqrt(x.w * y.w) AS v FROM shared s JOIN weight x ON x.i = s.i JOIN weight y ON y.i = s.j),
sims AS (SELECT i, j, {_to_40_bits('v')} AS sim FROM quotient)"""


def _moment(t: str) -> str:
    return f"""
mean AS (SELECT i, count(*) AS n, fsum(r) AS total, fsum(r * r) AS squares, fsum(r) / count(*) AS m,
                min(r) = max(r) AS flat FROM {t} GROUP BY i),
moment AS (
  SELECT i, any_value(n) AS n, any_value(total) AS total, any_value(squares) AS squares, any_value(m) AS m,
         CASE WHEN any_value(flat) THEN 0e0 ELSE fsum((r - m) * (r - m)) END AS v
  FROM {t} JOIN mean USING (i) GROUP BY i)"""


def _pearson(t: str) -> str:
    return f"""{_moment(t)},
centred AS (SELECT u, i, r - m AS c FROM {t} JOIN moment USING (i) WHERE v > 0),
shared AS (
  SELECT a.i AS i, b.i AS j, fsum(a.c * b.c) AS total
  FROM centred a JOIN centred b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i),
quotient AS (
  SELECT s.i, s.j, s.total / (sqrt(x.v) * sqrt(y.v)) AS v
  FROM shared s JOIN moment x ON x.i = s.i JOIN moment y ON y.i = s.j),
sims AS (SELECT i, j, {_to_40_bits('v')} AS sim FROM quotient)"""


def _swing(t: str, alpha: str = "5e-1", weighted: bool = False, having: str = "") -> str:
    top = "x.wu * x.wv" if weighted else "1e0"
    weight = f"(SELECT u, 1e0 / sqrt(count(*)) AS w FROM {t} GROUP BY u)"
    extra = f" JOIN {weight} wa ON wa.u = a.u JOIN {weight} wb ON wb.u = b.u" if weighted else ""
    cols = ", wa.w AS wu, wb.w AS wv" if weighted else ""
    return f"""
link AS (SELECT a.i AS i, a.u AS u, b.u AS v{cols} FROM {t} a JOIN {t} b ON a.i = b.i AND a.u < b.u{extra}),
both_have AS (SELECT u, v, count(*) AS k FROM link GROUP BY u, v HAVING count(*) > 1),
quad AS (
  SELECT x.i AS i, y.i AS j, x.u AS u, x.v AS v, k, CAST(round({top} / ({alpha} + k) * 1e10) AS BIGINT) AS term
  FROM link x JOIN link y ON x.u = y.u AND x.v = y.v AND x.i < y.i
  JOIN both_have h ON h.u = x.u AND h.v = x.v),
sims AS (SELECT i, j, sum(term) AS units FROM quad GROUP BY i, j {having})"""


SWING_TOP = _top("top", "sims", "units", 20)
MODEL = 'SELECT i AS item_i, j AS item_j, {score} AS sim, n AS rank FROM top'
FROM_SIM = MODEL.format(score="round(s, 6)")
FROM_UNITS = MODEL.format(score="CAST(s AS DOUBLE) / 1e10")


def _recs(t: str, sim: str, unseen: bool = False) -> str:
    skip = f"WHERE NOT EXISTS (SELECT 1 FROM {t} h WHERE h.u = s.u AND h.i = s.i)" if unseen else ""
    return f"""
score AS (
  SELECT h.u, m.j AS i, sum(CAST(round({sim} * 1e10) AS BIGINT)) AS units
  FROM {t} h JOIN top m ON m.i = h.i GROUP BY h.u, m.j),
recs AS (
  SELECT u, i, units, CAST(n AS INTEGER) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY units DESC, i) AS n FROM score s {skip})
  WHERE n <= 100)"""


SHOW_RECS = 'SELECT u AS "user", i AS item, CAST(units AS DOUBLE) / 1e10 AS score, n AS rank FROM recs'

COUNTS = """
eligible AS (SELECT u FROM recs INTERSECT SELECT u FROM test INTERSECT SELECT u FROM train),
counts AS (
  SELECT (SELECT count(*) FROM recs JOIN test USING (u, i) WHERE u IN (SELECT u FROM eligible)) AS hits,
         (SELECT count(*) FROM eligible) * 100 AS slots,
         (SELECT count(*) FROM test WHERE u IN (SELECT u FROM eligible)) AS test_items,
         (SELECT count(DISTINCT i) FROM recs) AS recommended_items,
         (SELECT count(DISTINCT i) FROM train) AS train_items)"""

PRECISION = "hits / CAST(nullif(slots, 0) AS DOUBLE) AS precision"
RECALL = "hits / CAST(nullif(test_items, 0) AS DOUBLE) AS recall"
COVERAGE = "recommended_items / CAST(nullif(train_items, 0) AS DOUBLE) AS coverage"
def _percent(metric: str) -> str:
    value, name = metric.rsplit(" AS ", 1)
    return f"round_even({value} * 100, 4) || '%' AS {name}"


ALL_METRICS = f"""SELECT hits, slots, test_items, recommended_items, train_items,
  {PRECISION}, {RECALL}, {COVERAGE} FROM counts"""

EDGES = """
edge AS (SELECT DISTINCT 'u:' || u AS src, 'i:' || i AS dst FROM rates
         UNION ALL SELECT DISTINCT 'i:' || i, 'u:' || u FROM rates)"""
DEGREE = """
degree AS (SELECT src AS v, count(*) AS deg FROM edge GROUP BY src)"""
TRANSITION = f"{EDGES},{DEGREE},\ntransition AS (SELECT src, dst, 1e0 / deg AS w FROM edge JOIN degree ON v = src)"


def _walk(t: str, seed: str, start: str, moves: int = MOVES) -> str:
    """The walk by its definition, one move at a time, from all ``seed`` of ``t``; state tables s0, s1, ...

    Vertex numbers: item i is i, user u is -1 - u. x has settled, w waits.
    """
    parts = [
        f"""
link AS (SELECT DISTINCT -1 - u AS src, i AS dst FROM {t} UNION ALL SELECT DISTINCT i, -1 - u FROM {t}),
degree AS (SELECT src AS v, count(*) AS deg FROM link GROUP BY src)""",
        f"s0 AS (SELECT DISTINCT {seed} AS seed, {start} AS v, 0e0 AS x, 1e0 AS w FROM {t})",
    ]
    for n in range(1, moves + 1):
        parts.append(
            f"""s{n} AS MATERIALIZED (
  SELECT seed, v, sum(x) AS x, sum(w) AS w FROM (
    SELECT seed, v, x + 2e-1 * w AS x, 0e0 AS w FROM s{n - 1}
    UNION ALL SELECT seed, dst, 0e0, 8e-1 * w / deg FROM s{n - 1} JOIN degree USING (v) JOIN link ON src = v WHERE w > 0)
  GROUP BY seed, v)"""
        )
    return ",\n".join(parts)


ITEM_WALK = _walk("rates", "i", "i")
LAST = f"s{MOVES}"
VERTEX = "CASE WHEN v < 0 THEN 'u:' || (-1 - v) ELSE 'i:' || v END"


def _walk_recs(t: str) -> str:
    return f"""{_walk(t, 'u', '-1 - u')},
recs AS (
  SELECT u, i, r, CAST(n AS INTEGER) AS n FROM (
    SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(r, 9) DESC, i) AS n FROM (
      SELECT seed AS u, v AS i, x AS r FROM {LAST} WHERE v >= 0) w
    WHERE NOT EXISTS (SELECT 1 FROM {t} h WHERE h.u = w.u AND h.i = w.i))
  WHERE n <= 100)"""


SHOW_WALK_RECS = 'SELECT u AS "user", i AS item, round(r, 6) AS score, n AS rank FROM recs'


#: A vertex pushes from 1e-6 of the mass per edge on; mass is counted in units of 1e-15.
PRUNED, MASS = 10**9, 10**15


def _push(t: str) -> str:
    """All users' walks by push, all vertices of a round at once; vertices are numbered as in ``_walk``."""
    hot, share = f"w >= {PRUNED} * deg", "((800 * w) // (1000 * deg))"
    parts = [
        f"""
link AS (SELECT DISTINCT -1 - u AS src, i AS dst FROM {t} UNION ALL SELECT DISTINCT i, -1 - u FROM {t}),
degree AS (SELECT src AS v, count(*) AS deg FROM link GROUP BY src)""",
        f"""s0 AS (SELECT v AS seed, v, CAST(0 AS BIGINT) AS x, CAST({MASS} AS BIGINT) AS w
       FROM degree WHERE v < 0 AND {PRUNED} * deg <= {MASS})""",
    ]
    for n in range(1, PUSH_ROUNDS + 1):
        parts.append(
            f"""s{n} AS MATERIALIZED (
  SELECT seed, v, CAST(sum(x) AS BIGINT) AS x, CAST(sum(w) AS BIGINT) AS w FROM (
    SELECT seed, v, CASE WHEN {hot} THEN x + w - {share} * deg ELSE x END AS x, CASE WHEN {hot} THEN 0 ELSE w END AS w
    FROM s{n - 1} JOIN degree USING (v)
    UNION ALL SELECT seed, dst, 0, {share} FROM s{n - 1} JOIN degree USING (v) JOIN link ON src = v WHERE {hot})
  GROUP BY seed, v)"""
        )
    parts.append(
        f"""ended AS (SELECT -1 - seed AS u, v, deg, x + w - (800 * w) // 1000 AS units, (800 * w) // 1000 AS rest, {hot} AS hot
         FROM s{PUSH_ROUNDS} JOIN degree USING (v)),
mass AS (SELECT u, CAST(sum(rest) AS BIGINT) AS rest, NOT bool_or(hot) AS at_rest FROM ended GROUP BY u)"""
    )
    return ",\n".join(parts)


def _push_recs(t: str) -> str:
    return f"""{_push(t)},
recs AS (
  SELECT u, i, units, deg, CAST(n AS INTEGER) AS n FROM (
    SELECT u, v AS i, units, deg, row_number() OVER (PARTITION BY u ORDER BY units DESC, v) AS n FROM ended e
    WHERE v >= 0 AND units > 0 AND NOT EXISTS (SELECT 1 FROM {t} h WHERE h.u = e.u AND h.i = e.v))
  WHERE n <= 100)"""


def _evaluated(model: str, top: str, sim: str) -> str:
    return f"WITH {RATES},{TRAIN_TEST},{model},{top},{_recs('train', sim)},{COUNTS}"


COSINE_TOP = _top("top", "sims", "sim", 20)
ROUND5 = """
rounded AS (
  SELECT i, j, (units // 100000 + CASE WHEN units % 100000 > 50000
    OR (units % 100000 = 50000 AND (units // 100000) % 2 = 1) THEN 1 ELSE 0 END) * 100000 AS units FROM sims)"""
TOP50 = f"WITH {RATES},{_swing('rates', '1e0')},{ROUND5},{_top('top', 'rounded', 'units', 50)}"
EVAL_COSINE = _evaluated(_cosine("train"), COSINE_TOP, "m.s")
EVAL_SWING = _evaluated(_swing("train"), SWING_TOP, "(CAST(m.s AS DOUBLE) / 1e10)")
SIMS_ONLY = 'SELECT i AS item_i, j AS item_j, CAST(units AS DOUBLE) / 1e10 AS sim FROM sims'


def _leave_n(start: int, stop: int) -> str:
    return f"""WITH {RATES},{_held(start, stop)}
SELECT u AS "user", i AS item, r AS rate, CASE WHEN held THEN 'test' ELSE 'train' END AS part FROM parted"""


ORACLES: dict[str, str] = {
    "interactions_raw": f"""WITH {RAW}
SELECT u AS "user", i AS item, r AS rate, CAST(epoch(ts) AS BIGINT) AS ts FROM raw""",
    "interactions_preview": f"""WITH {RATES}
SELECT u AS "user", i AS item, r AS rate FROM rates ORDER BY u, i LIMIT 5""",
    "interactions_max_rate": f'WITH {RATES} SELECT u AS "user", i AS item, r AS rate FROM rates',
    "interactions_distinct": f'WITH {RAW} SELECT DISTINCT u AS "user", i AS item FROM raw',
    "interactions_events": f'WITH {DENSE} SELECT u AS "user", i AS item FROM rates',
    "user_items_index": _members("u", "i", "user", "items"),
    "item_users_index": _members("i", "u", "item", "users"),
    "dataset_profile": f"""WITH {RATES}
SELECT count(*) AS n_rows, count(DISTINCT u) AS n_users, count(DISTINCT i) AS n_items FROM rates""",
    "dim_scan": """SELECT c_custkey AS "user", c_mktsegment AS segment, n_name AS nation
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "split_kfold": f"""WITH {RATES},
placed AS (SELECT *, row_number() OVER (ORDER BY ts, u, i) AS p, count(*) OVER () AS total FROM rates)
SELECT u AS "user", i AS item, r AS rate,
       CAST((p - 1) // ((total + {FOLDS - 1}) // {FOLDS}) + 1 AS INTEGER) AS fold FROM placed""",
    "split_leave_n_a": _leave_n(1, 10),
    "split_leave_n_b": _leave_n(11, 20),
    "split_leave_n_capped": f"""WITH {RATES},{_held(1, 10)},
capped AS (SELECT *, row_number() OVER (PARTITION BY held ORDER BY ts, u, i) AS p FROM parted)
SELECT u AS "user", i AS item, r AS rate,
       CASE WHEN held AND p <= {MAX_TEST} THEN 'test' ELSE 'train' END AS part FROM capped""",
    "item_cooccurrence": f"""WITH {RATES}
SELECT a.i AS item_i, b.i AS item_j, count(*) AS co
FROM rates a JOIN rates b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i""",
    "item_cooccurrence_min_support": f"""WITH {RATES}
SELECT a.i AS item_i, b.i AS item_j, count(*) AS co
FROM rates a JOIN rates b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i HAVING count(*) >= 3""",
    "user_cooccurrence": f"""WITH {RATES}
SELECT a.u AS user_u, b.u AS user_v, count(*) AS k
FROM rates a JOIN rates b ON a.i = b.i AND a.u < b.u GROUP BY a.u, b.u""",
    "item_pair_shared_users": f"""WITH {RATES}
SELECT a.i AS item_i, b.i AS item_j, a.u // 4096 AS segment, CAST(count(*) AS INTEGER) AS n,
       string_agg(CAST(a.u AS VARCHAR), ',' ORDER BY a.u) AS users
FROM rates a JOIN rates b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i, a.u // 4096""",
    "swing_quadruples": f"""WITH {RATES},{_swing('rates')}
SELECT i AS item_i, j AS item_j, u AS user_u, v AS user_v, k FROM quad""",
    "itemcf_item_weight": f"WITH {RATES} SELECT i AS item, sum(r) AS weight FROM rates GROUP BY i",
    "itemcf_item_moments": f"""WITH {RATES},{_moment('rates')}
SELECT i AS item, n, total, squares, round(m, 6) AS mean, round(v, 6) AS deviation FROM moment""",
    "itemcf_overlap": f"""WITH {RATES}
SELECT a.i AS item_i, b.i AS item_j, sum(least(a.r, b.r)) AS overlap
FROM rates a JOIN rates b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i""",
    "itemcf_cosine_topk": f"WITH {RATES},{_cosine('rates')},{COSINE_TOP} {FROM_SIM}",
    "itemcf_rawproduct_topk": f"WITH {RATES},{_cosine('rates', 'a.r * b.r')},{COSINE_TOP} {FROM_SIM}",
    "itemcf_pearson_topk": f"WITH {RATES},{_pearson('rates')},{COSINE_TOP} {FROM_SIM}",
    "itemcf_pearson_events_topk": f"WITH {EVENT_RATES},{_pearson('rates')},{COSINE_TOP} {FROM_SIM}",
    "swing_pairs": f"WITH {RATES},{_swing('rates')} {SIMS_ONLY}",
    "swing_min_support": f"""WITH {RATES},{_swing('rates', having='HAVING count(DISTINCT u) + count(DISTINCT v) > 0')},
support AS (SELECT a.i AS i, b.i AS j FROM rates a JOIN rates b ON a.u = b.u AND a.i < b.i
            GROUP BY a.i, b.i HAVING count(*) >= 3)
SELECT i AS item_i, j AS item_j, CAST(units AS DOUBLE) / 1e10 AS sim FROM sims JOIN support USING (i, j)""",
    "swing_topk": f"WITH {RATES},{_swing('rates')},{SWING_TOP} {FROM_UNITS}",
    "swing_ordered_topk": f"""WITH {RATES},{_swing('rates')},
twice AS (SELECT i, j, units * 2 AS units FROM sims),{_top('top', 'twice', 'units', 20)} {FROM_UNITS}""",
    "swing_alpha1_top50": f"{TOP50} {FROM_UNITS}",
    "swing_neighbor_list": f"""{TOP50}
SELECT i AS item_i, string_agg(CAST(j AS VARCHAR), ',' ORDER BY n) AS sim_item_list FROM top GROUP BY i""",
    "swing_firstseen_topk": f"""WITH {RATES},{_swing('rates')},
seen AS (SELECT i, row_number() OVER (ORDER BY ts, u, i) AS p FROM
         (SELECT *, row_number() OVER (PARTITION BY i ORDER BY ts, u) AS f FROM rates) WHERE f = 1),
directed AS (
  SELECT CASE WHEN x.p < y.p THEN s.i ELSE s.j END AS i, CASE WHEN x.p < y.p THEN s.j ELSE s.i END AS j, units
  FROM sims s JOIN seen x ON x.i = s.i JOIN seen y ON y.i = s.j),
{_top('top', 'directed', 'units', 20, directed=True)} {FROM_UNITS}""",
    "swing_weighted_topk": f"WITH {RATES},{_swing('rates', weighted=True)},{SWING_TOP} {FROM_UNITS}",
    "swing_item_weighted_topk": f"""WITH {RATES},{_swing('rates')},
iw AS (SELECT i, 1e0 / sqrt(count(*)) AS w FROM rates GROUP BY i),
scaled AS (
  SELECT s.i, s.j, CAST(round(CAST(units AS DOUBLE) * (x.w * y.w)) AS HUGEINT) AS units
  FROM sims s JOIN iw x ON x.i = s.i JOIN iw y ON y.i = s.j),
{_top('top', 'scaled', 'units', 20)} {FROM_UNITS}""",
    "swing_dense_topk": f"WITH {DENSE},{_swing('rates')},{SWING_TOP} {FROM_UNITS}",
    "sim_model_map": f"""WITH {RATES},{_cosine('rates')},{COSINE_TOP}
SELECT i AS item_i, CAST(count(*) AS INTEGER) AS n,
       string_agg(CAST(j AS VARCHAR) || ':' || CAST(CAST(round(s * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY n) AS sims
FROM top GROUP BY i""",
    "sim_model_roundtrip": f"WITH {RATES},{_cosine('rates')},{COSINE_TOP} {FROM_SIM}",
    "sim_model_single_key_roundtrip": f"WITH {RATES},{_swing('rates')},{SWING_TOP} {FROM_UNITS}",
    "recommend_itemcf_cosine": f"WITH {RATES},{_cosine('rates')},{COSINE_TOP},{_recs('rates', 'm.s')} {SHOW_RECS}",
    "recommend_itemcf_pearson": f"WITH {RATES},{_pearson('rates')},{COSINE_TOP},{_recs('rates', 'm.s')} {SHOW_RECS}",
    "recommend_swing": f"""WITH {RATES},{_swing('rates')},{SWING_TOP},
{_recs('rates', '(CAST(m.s AS DOUBLE) / 1e10)')} {SHOW_RECS}""",
    "recommend_swing_unseen": f"""WITH {RATES},{_swing('rates')},{SWING_TOP},
{_recs('rates', '(CAST(m.s AS DOUBLE) / 1e10)', unseen=True)} {SHOW_RECS}""",
    "eval_precision": f"{EVAL_COSINE} SELECT hits, slots, {PRECISION} FROM counts",
    "eval_recall": f"{EVAL_COSINE} SELECT hits, test_items, {RECALL} FROM counts",
    "eval_coverage": f"{EVAL_COSINE} SELECT recommended_items, train_items, {COVERAGE} FROM counts",
    "eval_itemcf_cosine": f"{EVAL_COSINE} {ALL_METRICS}",
    "eval_itemcf_pearson": f"{_evaluated(_pearson('train'), COSINE_TOP, 'm.s')} {ALL_METRICS}",
    "eval_swing": f"{EVAL_SWING} {ALL_METRICS}",
    "ppr_edges": f"WITH {RATES},{EDGES} SELECT src, dst FROM edge",
    "ppr_transition": f"WITH {RATES},{TRANSITION} SELECT src, dst, round(w, 10) AS weight FROM transition",
    "ppr_system_matrix": f"""WITH {RATES},{TRANSITION}
SELECT dst AS row, src AS col, round(-8e-1 * w, 10) AS value FROM transition
UNION ALL SELECT v, v, 1e0 FROM degree""",
    "ppr_vertex_index": f"""WITH {RATES},
vertex AS (SELECT DISTINCT 0 AS kind, u AS id FROM rates UNION ALL SELECT DISTINCT 1, i FROM rates)
SELECT CASE kind WHEN 0 THEN 'u:' ELSE 'i:' END || id AS vertex,
       row_number() OVER (ORDER BY kind, id) - 1 AS idx FROM vertex""",
    "ppr_iterate": f"""WITH {DENSE},{ITEM_WALK}
SELECT seed, round(sum(x), 8) AS settled, round(sum(w), 8) AS waiting FROM {LAST} GROUP BY seed""",
    "ppr_moves": f"""WITH {DENSE},{_walk('rates', 'i', 'i', 2 * WALK_ROUNDS)}
SELECT seed, v AS item, round(x, 9) AS settled, round(w, 9) AS waiting FROM s{2 * WALK_ROUNDS} WHERE v >= 0""",
    "ppr_converged": f"""WITH {DENSE},{ITEM_WALK},
named AS (SELECT seed, {VERTEX} AS vertex, x AS score FROM {LAST})
SELECT seed, vertex, round(score, 6) AS score, CAST(n AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY round(score, 9) DESC, vertex) AS n FROM named) WHERE n <= 100""",
    "ppr_dense_converged": f"""WITH {DENSE},{_walk('rates', 'u', '-1 - u')}
SELECT seed AS "user", v AS item, round(x, 6) AS rank FROM {LAST} WHERE v >= 0""",
    "ppr_residual": f"""WITH {DENSE},{ITEM_WALK},
part AS (
  SELECT seed, v, x FROM {LAST}
  UNION ALL SELECT seed, dst, -8e-1 * x / deg FROM {LAST} JOIN degree USING (v) JOIN link ON src = v
  UNION ALL SELECT seed, v, -2e-1 FROM s0)
SELECT seed, round(max(abs(r)), 8) AS residual FROM (SELECT seed, v, sum(x) AS r FROM part GROUP BY seed, v) GROUP BY seed""",
    "ppr_recommend_topn": f"WITH {DENSE},{_walk_recs('rates')} {SHOW_WALK_RECS}",
    "recommendations_roundtrip": f"WITH {DENSE},{_walk_recs('rates')} {SHOW_WALK_RECS}",
    "dim_users_file": """SELECT c_custkey AS "user", CAST(18 + c_custkey % 60 AS INTEGER) AS age,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS occupation, c_name AS zip FROM customer""",
    "dim_lists_file": """SELECT 'genre' AS kind, n_name AS name, CAST(n_nationkey AS BIGINT) AS n FROM nation
UNION ALL SELECT DISTINCT 'occupation', c_mktsegment, CAST(NULL AS BIGINT) FROM customer
UNION ALL SELECT 'total', 'nations', count(*) FROM nation UNION ALL SELECT 'total', 'customers', count(*) FROM customer""",
    "dim_items_file": """SELECT p_partkey AS item, p_name AS title, p_type AS url,
  array_to_string(list_filter(range(19), lambda i: p_partkey % 19 = i OR p_size % 19 = i), ',') AS genres FROM part""",
    "interactions_ingest": f"""WITH {RAW},
told AS (SELECT CASE WHEN i % 61 = 1 THEN CASE WHEN u % 77 = 0 THEN 'blank' ELSE 'fields' END
                     WHEN u % 77 = 0 THEN 'user' WHEN i % 50 = 0 THEN 'item' WHEN r = 13 THEN 'rate' ELSE 'none' END AS problem FROM raw)
SELECT problem, count(*) AS n FROM told GROUP BY problem
UNION ALL SELECT 'lines', count(*) FROM told UNION ALL SELECT 'kept', count(*) FROM told WHERE problem = 'none'
UNION ALL SELECT 'rejected', count(*) FROM told WHERE problem <> 'none'""",
    "split_leave_n_file_order": f"""WITH {RATES},
placed AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY md5(u || ':' || i)) AS p FROM rates)
SELECT u AS "user", i AS item, r AS rate, CASE WHEN p <= 10 THEN 'test' ELSE 'train' END AS part FROM placed""",
    "split_kfold_file_order": f"""WITH {RATES},
placed AS (SELECT *, row_number() OVER (ORDER BY md5(u || ':' || i)) AS p, count(*) OVER () AS total FROM rates)
SELECT u AS "user", i AS item, r AS rate,
       CAST((p - 1) // ((total + {FOLDS - 1}) // {FOLDS}) + 1 AS INTEGER) AS fold FROM placed""",
    "split_sorted_write": f"""WITH {RATES}
SELECT u AS "user", i AS item, row_number() OVER (ORDER BY u, i) AS position FROM rates""",
    "dataset_profile_sketches": f"WITH {RAW} SELECT count(*) AS n_rows, true AS users_close, true AS items_close FROM raw",
    "recommend_bucketed_roundtrip": f"WITH {RATES},{_cosine('rates')},{COSINE_TOP},{_recs('rates', 'm.s')} {SHOW_RECS}",
    "eval_percent": f"{EVAL_COSINE} SELECT {', '.join(map(_percent, (PRECISION, RECALL, COVERAGE)))} FROM counts",
    "ppr_push_recommend": f"""WITH {RATES},{_push_recs('rates')}
SELECT u AS "user", i AS item, CAST(units AS DOUBLE) / {MASS}e0 AS score, n AS rank,
       CAST(CASE WHEN at_rest THEN least(rest, {PRUNED} * deg) ELSE rest END AS DOUBLE) / {MASS}e0 AS error
FROM recs JOIN mass USING (u)""",
    "ppr_push_mass": f"""WITH {RATES},{_push('rates')}
SELECT u AS "user", CAST({MASS} - rest AS DOUBLE) / {MASS}e0 AS units, CAST(rest AS DOUBLE) / {MASS}e0 AS "left", at_rest FROM mass""",
    "eval_ppr_push": f"WITH {RATES},{TRAIN_TEST},{_push_recs('train')},{COUNTS} {ALL_METRICS}",
    "eval_ppr": f"WITH {EVENT_RATES},{TRAIN_TEST},{_walk_recs('train')},{COUNTS} {ALL_METRICS}",
}
