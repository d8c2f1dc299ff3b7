"""DuckDB SQL for the queries, built from named common table expressions."""

from __future__ import annotations

import re

from tallyforge.operators.report import COLOUR_TEXTS, COLUMN_TEXTS, RANKING_TEXTS

_WR = "CASE WHEN w + l > 0 THEN round_even(100.0::DOUBLE * w / (w + l), 2) END"
_PAGES = """SELECT a, b, page, w, l, t, w + l + t AS n FROM (
  SELECT x.brand AS a, y.brand AS b, x.page, count(*) FILTER (qa > qb) AS w, count(*) FILTER (qa < qb) AS l, count(*) FILTER (qa = qb) AS t
  FROM (SELECT l_orderkey, p_brand AS brand, l_quantity AS qa, year(l_shipdate) AS page FROM lineitem JOIN {part} ON l_partkey = p_partkey WHERE l_linestatus = 'F') x
  JOIN (SELECT l_orderkey, p_brand AS brand, l_quantity AS qb FROM lineitem JOIN {part} ON l_partkey = p_partkey) y
  ON x.l_orderkey = y.l_orderkey AND x.brand <> y.brand GROUP BY ALL)"""
_SHARES = "SELECT deck, 100.0::DOUBLE * q / sum(q) OVER () AS share FROM (SELECT p_brand AS deck, sum(l_quantity) AS q FROM lineitem JOIN {part} ON l_partkey = p_partkey GROUP BY 1)"
_CUT = "SELECT deck, share, share_cum FROM (SELECT *, sum(share) OVER (ORDER BY share DESC, deck ROWS UNBOUNDED PRECEDING) AS share_cum FROM {shares}) WHERE share_cum - share < 80"
_CANONICAL = """SELECT *, round_even(share_frac * 100, 2) AS share_pct, (row_number() OVER (ORDER BY share_frac DESC, deck))::INT AS ord FROM (
      SELECT coalesce(canonical, trim(deck)) AS deck, sum(least(greatest(CASE WHEN share > 1 THEN share / 100 ELSE share END, 0), 1)) AS share_frac
      FROM {cut} LEFT JOIN aliases ON lower(trim(regexp_replace(deck, '\\s+', ' ', 'g'))) = key GROUP BY 1)"""
_MAXN = """SELECT *, CASE WHEN n > 0 THEN round_even(100.0::DOUBLE * w / n, 2) ELSE 0.0::DOUBLE END AS winrate FROM (
  SELECT a, b, sum(w)::BIGINT AS w, sum(l)::BIGINT AS l, sum(t)::BIGINT AS t, count(*) AS tied, sum(w + l + t)::BIGINT AS n
  FROM (SELECT *, max(n) OVER (PARTITION BY a, b) AS most FROM {raw}) WHERE n = most GROUP BY a, b)"""
_NAMED = """SELECT a, b, sum(w)::BIGINT AS w, sum(l)::BIGINT AS l, sum(t)::BIGINT AS t, sum(n)::BIGINT AS n FROM (
  SELECT coalesce(i.canonical, trim(a)) AS a, coalesce(j.canonical, trim(b)) AS b, w, l, t, n FROM {maxn}
  LEFT JOIN aliases i ON lower(trim(regexp_replace(a, '\\s+', ' ', 'g'))) = i.key LEFT JOIN aliases j ON lower(trim(regexp_replace(b, '\\s+', ' ', 'g'))) = j.key) WHERE a <> b GROUP BY a, b"""
_SYM = """SELECT *, w + l + t AS n, """ + _WR + """ AS winrate FROM (
  SELECT a, b, w, l, t FROM {best} UNION ALL SELECT b, a, l, w, t FROM {best})"""
_BEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY least(a, b), greatest(a, b) ORDER BY w + l DESC, n DESC, a, b) AS r FROM {pairs}) WHERE r = 1"""
_CELLS = """SELECT x.deck AS a, x.ord AS a_ord, y.deck AS b, y.ord AS b_ord, CASE WHEN x.deck <> y.deck THEN coalesce(w, 0) END AS w, CASE WHEN x.deck <> y.deck THEN coalesce(l, 0) END AS l,
  CASE WHEN x.deck <> y.deck THEN coalesce(t, 0) END AS t, CASE WHEN x.deck <> y.deck THEN coalesce(w, 0) + coalesce(l, 0) END AS n_dir,
  CASE WHEN x.deck <> y.deck AND w + l > 0 THEN round_even(100.0::DOUBLE * w / (w + l), 2) END AS wr
  FROM {axis} x CROSS JOIN {axis} y LEFT JOIN {flat} f ON f.a = x.deck AND f.b = y.deck"""
_META = """SELECT deck, CASE WHEN mass > 0 THEN filled / sum(filled) OVER () ELSE 1.0::DOUBLE / count(*) OVER () END AS p_meta FROM (
  SELECT *, s + greatest(0.0::DOUBLE, 1 - mass) * ({to}) AS filled FROM (SELECT x.deck, coalesce(share_frac, 0) AS s, p_enc, sum(coalesce(share_frac, 0)) OVER () AS mass, 1.0::DOUBLE / count(*) OVER () AS even
  FROM axis x LEFT JOIN canonical USING (deck) LEFT JOIN enc USING (deck)))"""
_PHI = """CASE WHEN z = 0 THEN 50.0::DOUBLE ELSE 100 * (0.5::DOUBLE + sign(z) * exp(-z * z / 2) / sqrt(2 * pi()) *
  list_sum(list_transform(range(0, 121), lambda k: exp((2 * k + 1) * ln(abs(z)) - lgamma((2 * k + 2)::DOUBLE) + k * ln(2::DOUBLE) + lgamma((k + 1)::DOUBLE))))) END"""
_Z = "CASE WHEN stddev_pop({x}) OVER () > 1e-12 THEN ({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER () ELSE 0.0::DOUBLE END"
_LB = "lgamma(({a})::DOUBLE) + lgamma(({b})::DOUBLE) - lgamma(({a} + {b})::DOUBLE)"

CTES = {
    "raw": _PAGES.format(part="part"),
    "fparts": "SELECT p_partkey, p_brand || ' ' || split_part(p_type, ' ', 1) AS p_brand FROM part",
    "sparse": _PAGES.format(part="fparts"),
    "aliases": "SELECT * FROM (VALUES ('brand#2', 'Brand#2'), ('brand#21', 'Brand#2'), ('brand#22', 'Brand#2'), ('brand#3', 'Brand#3'), ('brand#31', 'Brand#3')) v(key, canonical)",
    "maxn": _MAXN.format(raw="raw"),
    "smaxn": _MAXN.format(raw="sparse"),
    "named": _NAMED.format(maxn="maxn"),
    "snamed": _NAMED.format(maxn="smaxn"),
    "best": _BEST.format(pairs="named"),
    "sbest": _BEST.format(pairs="snamed"),
    "mbest": _BEST.format(pairs="maxn"),
    "flat": _SYM.format(best="best"),
    "sflat": _SYM.format(best="sbest"),
    "shares": _SHARES.format(part="part"),
    "fshares": _SHARES.format(part="fparts"),
    "cut": _CUT.format(shares="shares"),
    "fcut": _CUT.format(shares="fshares"),
    "canonical": _CANONICAL.format(cut="cut"),
    "fcanonical": _CANONICAL.format(cut="fcut"),
    "axis": "SELECT deck, ord FROM canonical",
    "faxis": "SELECT deck, ord FROM fcanonical",
    "cells": _CELLS.format(flat="flat", axis="axis"),
    "scells": _CELLS.format(flat="sflat", axis="faxis"),
    "enc": "SELECT b AS deck, sum(coalesce(n_dir, 0))::DOUBLE / sum(sum(coalesce(n_dir, 0))) OVER () AS p_enc FROM cells GROUP BY b",
    "meta": _META.format(to="coalesce(p_enc, 0)"),
    "mixed": "SELECT *, (0.5::DOUBLE * sum(abs(p_meta - p_enc)) OVER ()) AS tv, 0.3::DOUBLE AS gamma FROM meta JOIN enc USING (deck)",
    "blend": "SELECT deck, p_meta, p_enc, tv, gamma, ((1 - gamma) * p_meta + gamma * p_enc) / sum((1 - gamma) * p_meta + gamma * p_enc) OVER () AS p FROM mixed",
    "obs": "SELECT * FROM cells WHERE a <> b AND n_dir > 0",
    "split1": "SELECT *, CASE WHEN w + l <= 1 THEN 0 ELSE least(greatest(1, round_even((w + l) / 3.0::DOUBLE, 0), CASE WHEN w + l >= 4 THEN 2 ELSE 1 END), w + l - 1) END::BIGINT AS test FROM obs",
    "split2": "SELECT *, CASE WHEN w + l > 0 THEN least(greatest(round_even(test * w / (w + l)::DOUBLE, 0), 0), w) ELSE 0 END::BIGINT AS w_test FROM split1",
    "splits": "SELECT a, b, w - w_test AS w_train, l - l_test AS l_train, w_test, l_test FROM (SELECT *, least(greatest(test - w_test, 0), l) AS l_test FROM split2)",
    "scale": "SELECT n_med, n_75, sqrt(greatest(n_med, 1) * greatest(n_75, 1)) AS beta FROM (SELECT median(n_dir)::DOUBLE AS n_med, quantile_cont(n_dir, 0.75)::DOUBLE AS n_75 FROM obs)",
    "ks": "SELECT DISTINCT least(greatest(beta * m, 0.1::DOUBLE), 50.0::DOUBLE) AS k FROM scale CROSS JOIN (VALUES (0.25::DOUBLE), (0.5), (1.0), (2.0), (4.0)) v(m)",
    "post": """SELECT *, CASE WHEN a <> b THEN pa / (pa + pb) END AS p_hat, CASE WHEN a <> b THEN pa * pb / ((pa + pb) * (pa + pb) * (pa + pb + 1)) END AS var_hat
      FROM (SELECT *, coalesce(w, 0) + 3.0::DOUBLE AS pa, coalesce(l, 0) + 3.0::DOUBLE AS pb FROM cells)""",
    "rpost": """SELECT a, b, pa / (pa + pb) * 100 AS p_hat_pct, sqrt(pa * pb / ((pa + pb) * (pa + pb) * (pa + pb + 1))) * 100 AS se_pct,
      CASE WHEN n_dir > 0 THEN sqrt(greatest(wr / 100 * (1 - wr / 100) / n_dir, 0)) * 100 END AS se_binom_pct, w, l, n_dir, wr
      FROM (SELECT *, wr / 100 * n_dir + 3.0::DOUBLE AS pa, (1 - wr / 100) * n_dir + 3.0::DOUBLE AS pb FROM cells)""",
    "mean": """SELECT deck, coalesce(m, 0) * 100 AS mas, coalesce(s, 0) * 100 AS se, coalesce(m, 0) * 100 - 1.2::DOUBLE * (coalesce(s, 0) * 100) AS lb FROM axis LEFT JOIN (
      SELECT a AS deck, sum(wt * p_hat) AS m, sqrt(sum(wt * wt * var_hat)) AS s FROM (
        SELECT post.a, p_hat, var_hat, CASE WHEN sum(p) OVER (PARTITION BY post.a) > 0 THEN p / sum(p) OVER (PARTITION BY post.a) ELSE 1.0::DOUBLE / count(*) OVER (PARTITION BY post.a) END AS wt
        FROM post JOIN blend ON deck = post.b WHERE post.a <> post.b AND n_dir > 0) GROUP BY 1) USING (deck)""",
    "edges": """SELECT * FROM (SELECT x.a, x.b, x.a_ord, x.b_ord, x.n_dir AS n_ij, y.n_dir AS n_ji,
        CASE WHEN x.n_dir > 0 AND y.n_dir > 0 THEN 2.0::DOUBLE * x.n_dir * y.n_dir / (x.n_dir + y.n_dir) WHEN x.n_dir > 0 THEN x.n_dir ELSE y.n_dir END::DOUBLE AS n_base,
        CASE WHEN x.n_dir > 0 AND y.n_dir > 0 THEN (x.n_dir / (x.n_dir + 6.0::DOUBLE) + y.n_dir / (y.n_dir + 6.0::DOUBLE)) / 2 WHEN x.n_dir > 0 THEN x.n_dir / (x.n_dir + 6.0::DOUBLE) WHEN y.n_dir > 0 THEN y.n_dir / (y.n_dir + 6.0::DOUBLE) END AS s_bar,
        CASE WHEN x.n_dir > 0 AND y.n_dir > 0 THEN (x.p_hat + 1 - y.p_hat) / 2 WHEN x.n_dir > 0 THEN x.p_hat WHEN y.n_dir > 0 THEN 1 - y.p_hat END AS p_bar
      FROM post x JOIN post y ON x.a = y.b AND x.b = y.a WHERE x.a_ord < x.b_ord) WHERE s_bar >= 5 / (5 + 6.0::DOUBLE)""",
    "degree": "SELECT min(coalesce(n, 0)) AS min_opp, median(coalesce(n, 0))::DOUBLE AS med_opp FROM axis LEFT JOIN (SELECT deck, count(*) AS n FROM (SELECT a AS deck FROM edges UNION ALL SELECT b FROM edges) GROUP BY 1) USING (deck)",
    "diag": """SELECT *, least(greatest(1.5::DOUBLE + 0.4 * least(greatest((near_share - 0.15) / 0.15, 0), 1) + 0.2 * least(greatest((0.60 - coalesce(s_med, 0.60)) / 0.10, 0), 1)
        + 0.2 * least(greatest((coalesce(hhi, 0.10) - 0.10) / 0.05, 0), 1) + 0.1 * least(greatest((8.0 - min_opp) / 5.0, 0), 1), 1.5), 2.1)::DOUBLE AS power FROM (
      SELECT coalesce(avg(CASE WHEN s_bar >= 5 / 11.0::DOUBLE AND s_bar < 5 / 11.0::DOUBLE + 0.1::DOUBLE THEN 1.0 ELSE 0.0 END), 0) AS near_share, median(s_bar) AS s_med,
        CASE WHEN sum(v) > 0 THEN sum(v * v) / pow(sum(v), 2) END AS hhi FROM (SELECT *, greatest(n_base, 1e-12) * abs(p_bar - 0.5) AS v FROM edges)) CROSS JOIN degree""",
    "soft": "SELECT a, b, n_eff, p * n_eff AS w_ij, (1 - p) * n_eff AS w_ji FROM (SELECT a, b, least(greatest(p_bar, 1e-9), 1 - 1e-9) AS p, greatest(n_base * pow(s_bar, power), 1e-9) AS n_eff FROM edges CROSS JOIN diag)",
    "sides": "SELECT a AS deck, b AS other, n_eff, w_ij AS won FROM soft UNION ALL SELECT b, a, n_eff, w_ji FROM soft",
    "nodes": """SELECT list(wins ORDER BY ord) AS wins, list(js ORDER BY ord) AS js, list(ns ORDER BY ord) AS ns, count(*) AS t FROM (
      SELECT x.ord, coalesce(sum(won), 0)::DOUBLE AS wins, coalesce(list(o.ord ORDER BY o.ord) FILTER (o.ord IS NOT NULL), []) AS js, coalesce(list(n_eff ORDER BY o.ord) FILTER (o.ord IS NOT NULL), []) AS ns
      FROM axis x LEFT JOIN sides s ON s.deck = x.deck LEFT JOIN axis o ON o.deck = s.other GROUP BY x.ord)""",
    "steps": """SELECT 0 AS i, list_transform(range(0, t), lambda x: 1.0::DOUBLE) AS pi, 1e9::DOUBLE AS moved FROM nodes
      UNION ALL SELECT i + 1, list_transform(fresh, lambda x: greatest(x, 1e-8)), list_max(list_transform(range(1, len(pi) + 1), lambda k: abs(fresh[k] - pi[k]) / (pi[k] + 1e-9))) FROM (
        SELECT i, pi, moved, list_transform(range(1, t + 1), lambda k: (wins[k] + 1.5::DOUBLE) / (coalesce(list_sum(list_transform(range(1, len(js[k]) + 1), lambda m: ns[k][m] / (pi[k] + pi[js[k][m]] + 1e-12::DOUBLE))), 0) + 1.5::DOUBLE + 1e-12)) AS fresh
        FROM steps CROSS JOIN nodes WHERE i < 500 AND moved >= 1e-6)""",
    "solved": "SELECT deck, pi[ord] AS pi FROM axis CROSS JOIN (SELECT pi FROM steps ORDER BY i DESC LIMIT 1)",
    "btp": """SELECT deck, 100.0::DOUBLE / (1 + exp(-theta / CASE WHEN stddev_pop(theta) OVER () > 1e-12 THEN stddev_pop(theta) OVER () ELSE 1 END)) AS bt
      FROM (SELECT deck, ln(pi / (exp(avg(ln(pi)) OVER ()) + 1e-12)) AS theta FROM solved)""",
    "cover": """SELECT a AS deck, count(*) FILTER (n_dir > 0) AS opp_used, count(*) AS opp_total, count(*) FILTER (coalesce(n_dir, 0) = 0) AS missing, 100.0::DOUBLE * count(*) FILTER (n_dir > 0) / count(*) AS coverage_pct, sum(coalesce(n_dir, 0))::DOUBLE AS n_eff,
      coalesce(array_to_string((list(b ORDER BY b_ord) FILTER (coalesce(n_dir, 0) = 0))[1:5], ', '), '') AS missing_sample FROM {cells} WHERE a <> b GROUP BY a""",
    "scored": "SELECT deck, mas, se, lb, bt, " + _PHI + " AS score FROM (SELECT *, 0.72::DOUBLE * (" + _Z.format(x="lb") + ") + (1 - 0.72::DOUBLE) * (" + _Z.format(x="bt") + ") AS z FROM mean JOIN btp USING (deck))",
    "ranked": "SELECT (row_number() OVER (ORDER BY score DESC, lb DESC, bt DESC, n_eff DESC, deck))::INT AS rank, deck, score, mas, lb, bt, se, n_eff, opp_used, opp_total, coverage_pct FROM scored JOIN cover USING (deck)",
    "roww": "SELECT x.deck AS a, y.deck AS b, p / sum(p) OVER (PARTITION BY x.deck) AS w_ab FROM axis x JOIN blend y ON x.deck <> y.deck",
    "pairs": """SELECT r.a, k.rank AS b_rank, CASE WHEN r.a <> r.b THEN r.b ELSE 'Mirror' END AS opponent, CASE WHEN r.a <> r.b THEN w END AS w, CASE WHEN r.a <> r.b THEN l END AS l, CASE WHEN r.a <> r.b THEN n_dir END AS n,
      round_even(wr, 2) AS wr_real, round_even(p_hat_pct, 2) AS p_hat, round_even(se_pct, 2) AS se_dir, round_even(se_binom_pct, 2) AS se_binom, round_even(p_hat_pct - wr, 2) AS gap,
      round_even(CASE WHEN r.a <> r.b THEN w_ab * 100 ELSE 0 END, 2) AS weight, round_even(CASE WHEN r.a <> r.b THEN w_ab * p_hat_pct ELSE 0 END, 2) AS contrib
      FROM rpost r LEFT JOIN roww q ON q.a = r.a AND q.b = r.b JOIN ranked k ON k.deck = r.b""",
    "styled": "SELECT *, CASE WHEN abs(gap) >= 8 THEN 'RED' WHEN abs(gap) >= 4 THEN 'YELLOW' END AS gap_flag, opponent = 'Mirror' AS is_mirror, (rank() OVER (PARTITION BY a ORDER BY contrib DESC NULLS LAST)) <= 5 AND contrib IS NOT NULL AS is_topk FROM pairs",
    "score": """SELECT a, b, w, l, t, n, winrate AS wr_dir, winrate FROM sflat WHERE w + l > 0 AND a IN (SELECT deck FROM faxis) AND b IN (SELECT deck FROM faxis)""",
    "alive": """SELECT 0 AS i, list(deck ORDER BY ord) AS d, [[]::VARCHAR[]] AS gone, greatest(1, floor((count(*) - 1) * 0.02::DOUBLE)::INT) AS allowed, TRUE AS moved FROM faxis
      UNION ALL SELECT i + 1, list_filter(d, lambda x: NOT list_contains(out, x)), list_append(gone, out), allowed, len(out) > 0 FROM (
        SELECT i, d, gone, allowed, CASE WHEN len(d) > 2 AND list_max(ex) > 0 THEN list_filter(d, lambda x, k: ex[k] = list_max(ex)) ELSE []::VARCHAR[] END AS out FROM (
          SELECT *, list_transform(d, lambda x: len(list_filter(holes, lambda h: h.a = x AND list_contains(d, h.b))) - allowed) AS ex FROM alive CROSS JOIN (SELECT list({'a': a, 'b': b}) AS holes FROM scells WHERE a <> b AND wr IS NULL) WHERE moved))""",
    "lmet": """SELECT r_name AS league, printf('S%06d', x.l_suppkey) AS a, printf('S%06d', y.l_suppkey) AS b, count(*) FILTER (x.l_quantity > y.l_quantity) AS w, count(*) FILTER (x.l_quantity < y.l_quantity) AS l
      FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey JOIN orders ON o_orderkey = x.l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""",
    "laxis": "SELECT league, deck, row_number() OVER (PARTITION BY league ORDER BY deck) AS ord FROM (SELECT league, a AS deck FROM lmet UNION SELECT league, b FROM lmet)",
    "lsoft": "SELECT league, a, b, m AS n_eff, p * m AS w_ij, (1 - p) * m AS w_ji FROM (SELECT league, a, b, (w + 3.0::DOUBLE) / (n + 6.0::DOUBLE) AS p, greatest(n * pow(n / (n + 6.0::DOUBLE), 1.5::DOUBLE), 1e-9) AS m FROM (SELECT *, w + l AS n FROM lmet) WHERE n > 0 AND n / (n + 6.0::DOUBLE) >= 5 / 11.0::DOUBLE)",
    "lsides": "SELECT league, a AS deck, b AS other, n_eff, w_ij AS won FROM lsoft UNION ALL SELECT league, b, a, n_eff, w_ji FROM lsoft",
    "lnodes": """SELECT league, list(wins ORDER BY ord) AS wins, list(js ORDER BY ord) AS js, list(ns ORDER BY ord) AS ns, count(*) AS t FROM (
      SELECT x.league, x.ord, coalesce(sum(won), 0)::DOUBLE AS wins, coalesce(list(o.ord ORDER BY o.ord) FILTER (o.ord IS NOT NULL), []) AS js, coalesce(list(n_eff ORDER BY o.ord) FILTER (o.ord IS NOT NULL), []) AS ns
      FROM laxis x LEFT JOIN lsides s ON s.deck = x.deck AND s.league = x.league LEFT JOIN laxis o ON o.deck = s.other AND o.league = s.league GROUP BY x.league, x.ord) GROUP BY league""",
    "lsteps": """SELECT league, 0 AS i, list_transform(range(0, t), lambda x: 1.0::DOUBLE) AS pi, 1e9::DOUBLE AS moved FROM lnodes
      UNION ALL SELECT league, i + 1, list_transform(fresh, lambda x: greatest(x, 1e-8)), list_max(list_transform(range(1, len(pi) + 1), lambda k: abs(fresh[k] - pi[k]) / (pi[k] + 1e-9))) FROM (
        SELECT s.league, i, pi, moved, list_transform(range(1, t + 1), lambda k: (wins[k] + 1.5::DOUBLE) / (coalesce(list_sum(list_transform(range(1, len(js[k]) + 1), lambda m: ns[k][m] / (pi[k] + pi[js[k][m]] + 1e-12::DOUBLE))), 0) + 1.5::DOUBLE + 1e-12)) AS fresh
        FROM lsteps s JOIN lnodes n ON n.league = s.league WHERE i < 500 AND moved >= 1e-6 AND len(list_filter(js, lambda x: len(x) > 0)) > 0)""",
    "lsolved": "SELECT x.league, x.deck, s.pi[x.ord] AS pi FROM laxis x JOIN (SELECT league, arg_max(pi, i) AS pi FROM lsteps GROUP BY league) s ON s.league = x.league",
    "lholes": "SELECT x.league, list({'a': x.deck, 'b': y.deck}) AS holes FROM laxis x JOIN laxis y ON x.league = y.league AND x.deck <> y.deck LEFT JOIN lmet m ON m.league = x.league AND m.a = least(x.deck, y.deck) AND m.b = greatest(x.deck, y.deck) AND m.w + m.l > 0 WHERE m.a IS NULL GROUP BY x.league",
    "lalive": """SELECT league, 0 AS i, list(deck ORDER BY ord) AS d, [[]::VARCHAR[]] AS gone, greatest(1, floor((count(*) - 1) * 0.05::DOUBLE)::INT) AS allowed, TRUE AS moved FROM laxis GROUP BY league
      UNION ALL SELECT league, i + 1, list_filter(d, lambda x: NOT list_contains(out, x)), list_append(gone, out), allowed, len(out) > 0 FROM (
        SELECT league, i, d, gone, allowed, CASE WHEN len(d) > 2 AND list_max(ex) > 0 THEN list_filter(d, lambda x, k: ex[k] = list_max(ex)) ELSE []::VARCHAR[] END AS out FROM (
          SELECT s.*, list_transform(d, lambda x: len(list_filter(holes, lambda h: h.a = x AND list_contains(d, h.b))) - allowed) AS ex FROM lalive s JOIN lholes h ON h.league = s.league WHERE moved))""",
}
_DRAW = "least(floor(('0x' || substr(md5('42/' || r || '/' || d), 1, 13))::BIGINT::DOUBLE * n / 4503599627370496.0::DOUBLE), n - 1)::BIGINT"
_LL = _LB.format(a="k * 0.5::DOUBLE + w_train + w_test", b="k * 0.5::DOUBLE + l_train + l_test") + " - (" + _LB.format(a="k * 0.5::DOUBLE + w_train", b="k * 0.5::DOUBLE + l_train") + ")"
CTES |= {
    "tests": "SELECT row_number() OVER (ORDER BY a_ord, b_ord) - 1 AS cell, w - w_test AS w_train, l - l_test AS l_train, w_test, l_test FROM (SELECT *, least(greatest(test - w_test, 0), l) AS l_test FROM split2) WHERE w_test + l_test > 0",
    "lowest": "SELECT greatest(min(k) / 2, 0.1::DOUBLE) AS l1, greatest(greatest(min(k) / 2, 0.1::DOUBLE) / 2, 0.1::DOUBLE) AS l2 FROM ks",
    "tried": "SELECT k, min(lev) AS lev FROM (SELECT k, 0 AS lev FROM ks UNION ALL SELECT l1, 1 FROM lowest UNION ALL SELECT l2, 2 FROM lowest) GROUP BY k",
    "klls": "SELECT k, lev, sum(" + _LL + ") AS ll FROM tests CROSS JOIN tried GROUP BY k, lev",
    "picks": """SELECT j, min(k) AS star, min(lo) AS lo, min(hi) AS hi FROM (SELECT *, max(ll) OVER (PARTITION BY j) AS best, min(k) OVER (PARTITION BY j) AS lo, max(k) OVER (PARTITION BY j) AS hi
      FROM klls JOIN (VALUES (0), (1), (2)) v(j) ON lev <= j) WHERE best - ll <= 0.001::DOUBLE * greatest(1, abs(best)) GROUP BY j""",
    "expanded": """SELECT CASE WHEN x.star = x.lo AND x.lo > 0.1::DOUBLE + 1e-12 THEN CASE WHEN y.star = y.lo AND y.lo > 0.1::DOUBLE + 1e-12 THEN 2 ELSE 1 END ELSE 0 END AS steps
      FROM (SELECT * FROM picks WHERE j = 0) x CROSS JOIN (SELECT * FROM picks WHERE j = 1) y""",
    "starred": "SELECT steps, star, lo, hi FROM expanded JOIN picks ON j = steps",
    "near_ks": "SELECT DISTINCT least(greatest(star * m, lo), hi) AS k FROM starred CROSS JOIN (VALUES (pow(2::DOUBLE, -0.5::DOUBLE)), (1.0::DOUBLE), (pow(2::DOUBLE, 0.5::DOUBLE))) v(m)",
    "gains": "SELECT cell, k, " + _LL + " AS ll FROM tests CROSS JOIN near_ks",
    "drawn": "SELECT r, " + _DRAW + " AS cell FROM (SELECT count(*) AS n FROM tests) CROSS JOIN range(50) a(r) CROSS JOIN (SELECT unnest(range(count(*))) AS d FROM tests)",
    "resampled": "SELECT r, arg_min(k, (-ll, k)) AS k FROM (SELECT r, k, sum(ll) AS ll FROM drawn JOIN gains USING (cell) GROUP BY r, k) GROUP BY r",
    "booted": "SELECT median(k) AS med, quantile_cont(k, 0.75) - quantile_cont(k, 0.25) AS spread, avg(CASE WHEN abs(k - star) <= 1e-12 THEN 1.0::DOUBLE ELSE 0 END) AS mode FROM resampled CROSS JOIN starred",
    "bounds": """SELECT *, abs(star - lo) <= 1e-12 OR abs(star - hi) <= 1e-12 AS edge, greatest(lo, 0.1::DOUBLE) AS low, least(hi, 50.0::DOUBLE, beta * 4) AS high,
      (SELECT ll FROM klls WHERE k = star) - (SELECT arg_min(ll, abs(k - least(greatest(beta, lo), hi))) FROM klls) AS gain, (SELECT sum(w_test + l_test) FROM tests) AS tested FROM starred CROSS JOIN booted CROSS JOIN scale""",
    "reasoned": """SELECT *, CASE WHEN edge AND mode >= 0.8 AND med > 0 AND spread / med <= 0.05 THEN 'best-boundary-override' WHEN edge OR (med > 0 AND spread / med > 0.35) OR mode < 0.5 THEN 'boot-clipped' ELSE 'best' END AS reason FROM bounds""",
    "kchosen": "SELECT star AS k_star, CASE WHEN reason = 'boot-clipped' THEN least(greatest(med, greatest(beta / 4, low)), high) ELSE least(greatest(star, low), high) END AS k_used, reason, beta, steps AS expansions, 100 * gain / tested AS delta_ll_100 FROM reasoned",
}
CTES["scover"] = CTES["cover"].replace("{cells}", "scells")
CTES["cover"] = CTES["cover"].replace("{cells}", "cells")


def _variant(mark: str, own: dict[str, str], swap: dict[str, str]) -> None:
    """Adds a copy of every expression, its name led by ``mark``, that reads the copies; ``own`` stand for some, ``swap`` for texts."""
    names = [n for n in CTES if n not in _SHARED]
    for name in names:
        text = own.get(name, CTES[name])
        for a, b in swap.items():
            text = text.replace(a, b)
        for other in names:
            text = re.sub(rf"\b(FROM|JOIN)\s+{other}\b(\s+[a-z]\b)?", lambda m, o=other: f"{m[1]} {mark}{o}" + (m[2] or f" AS {o}"), text)
        _COPIES[mark + name] = text


_SHARED = {"raw", "fparts", "aliases", "maxn", "named", "best", "flat", "shares", "fshares", "cut", "fcut", "canonical", "fcanonical", "sparse", "smaxn", "snamed", "sbest", "mbest", "sflat", "faxis", "scells", "score", "scover", "lmet", "laxis", "lsoft", "lsides", "lnodes", "lsteps", "lsolved", "lholes", "lalive"}
_COPIES: dict[str, str] = {}
_K = "(SELECT k_used FROM kchosen)"
# The whole way: entities with over 15 percent of cells missing go first, and the prior strength is the chosen one.
_variant("w_", {
    "axis": "SELECT deck, row_number() OVER (ORDER BY ord) AS ord FROM canonical WHERE deck IN (SELECT unnest(d) FROM (SELECT d FROM alive ORDER BY i DESC LIMIT 1))",
    "alive": CTES["alive"].replace("0.02::DOUBLE", "0.15::DOUBLE").replace("faxis", "canonical").replace("FROM scells", "FROM (" + _CELLS.format(flat="flat", axis="(SELECT deck, ord FROM canonical)") + ")"),
    "post": CTES["post"].replace("3.0::DOUBLE", f"{_K} / 2"), "edges": CTES["edges"].replace("6.0::DOUBLE", _K), "diag": CTES["diag"].replace("5 / 11.0::DOUBLE", f"5 / (5 + {_K})"),
}, {})
CTES |= _COPIES
_RECURSIVE = {"w_steps", "w_alive", "steps", "alive", "lsteps", "lalive"}


def sql(final: str) -> str:
    """``final`` with all expressions that it names, in order of definition of their needs."""
    order: list[str] = []

    def need(text: str, own: str = "") -> None:
        for name in CTES:
            if name != own and name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(CTES[name], name)
                if name not in order:
                    order.append(name)

    need(final)
    head = "WITH RECURSIVE " if _RECURSIVE & set(order) else "WITH "
    return head + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + final if order else final


_METAS = {"uniform": "even", "encounter": "coalesce(p_enc, 0)", "proportional": "CASE WHEN mass > 0 THEN s / mass ELSE even END"}
_CHECKS = {
    "diagonal": "x.a = x.b AND x.wr IS NOT NULL", "sum_100": "abs(x.wr + y.wr - 100) > 0.2", "n_symmetric": "x.n_dir <> y.n_dir", "w_is_l_mirrored": "x.w <> y.l",
    "t_symmetric": "x.t <> y.t", "n_is_w_plus_l": "x.n_dir <> x.w + x.l", "wr_in_range": "x.wr < 0 OR x.wr > 100", "n_not_negative": "x.n_dir < 0",
}
_SCORE_CHECKS = {
    "mirror": "x.a = x.b", "off_axis": "x.a NOT IN (SELECT deck FROM faxis) OR x.b NOT IN (SELECT deck FROM faxis)", "one_direction": "y.a IS NULL", "n_is_sum": "x.n <> x.w + x.l + x.t",
    "wr_formula": "abs(x.wr_dir - 100.0 * x.w / greatest(x.w + x.l, 1)) > 0.1", "winrate_is_wr_dir": "x.winrate <> x.wr_dir",
}
_CUT_URL = "regexp_replace(url, '[?#].*$', '')"

def _checked(checks: dict[str, str], rows: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER ({c}) AS n_bad FROM {rows}" for k, c in checks.items())


_COVER_CHECKS = {"rows_are_cells": "n_rows <> known", "overfill": "n_rows > known", "missing_rate": "total - known > total * 0.02::DOUBLE"}
_COVERED = "(SELECT count(*) FILTER (wr IS NOT NULL) AS known, count(*) AS total FROM scells WHERE a <> b) k CROSS JOIN (SELECT count(*) AS n_rows FROM score) s"
_AGAIN_CHECKS = {"wr_recomputed": "abs(c.wr - round_even(100.0::DOUBLE * s.w / (s.w + s.l), 2)) > 0.1", "n_recomputed": "c.n_dir <> coalesce(s.w + s.l, 0)"}
_AGAIN = "scells c LEFT JOIN score s ON s.a = c.a AND s.b = c.b WHERE c.a <> c.b"
_BT_CHECKS = {"sum_is_n_eff": "abs(w_ij + w_ji - n_eff) > 1e-6", "in_range": "NOT (w_ij > 0 AND w_ij < n_eff AND w_ji > 0 AND w_ji < n_eff)"}
_SCORED = "score x LEFT JOIN score y ON x.a = y.b AND x.b = y.a"
_LEGEND = [("columns", *x, None) for x in COLUMN_TEXTS] + [("settings", "prior strength", "6.0", None), ("settings", "entities", None, None)] + [("ranking", *x, None) for x in RANKING_TEXTS] + [("colours", *x) for x in COLOUR_TEXTS]
_TOLD = lambda x: "NULL::VARCHAR" if x is None else "'" + x.replace("'", "''") + "'"

BRANDS = sorted(f"Brand#{i}" for i in range(1, 26) if i not in (21, 22))


def _digest(table: str, kinds: dict[str, str]) -> str:
    """The digest of ``table``: columns by name, each with its JSON form in quotes or not."""
    parts = [f"'{len(c)}:{c}=' || CASE WHEN {c} IS NULL THEN '-' ELSE length({v})::VARCHAR || ':' || {v} END" for c, v in sorted((c, "('{\"v\":' || " + x + " || '}')") for c, x in kinds.items())]
    return f"SELECT count(*) AS n_rows, sum(('0x' || substr(sha256({' || '.join(parts)}), 1, 15))::BIGINT)::VARCHAR AS content FROM {table}"


_TEXT = "'\"' || {} || '\"'"
_DIGESTS = {
    "region": _digest("region", {"r_regionkey": "r_regionkey", "r_name": _TEXT.format("r_name")}),
    "kinds": _digest("part", {"p_brand": _TEXT.format("p_brand"), "p_size": "p_size"}),
    "holes": _digest("(SELECT nullif(p_brand, 'Brand#11') AS x, nullif(p_type, 'SMALL') AS y FROM part)", {"x": _TEXT.format("x"), "y": _TEXT.format("y")}),
}

ORACLES = {
    "count_numbers": "SELECT a, b, sum(w)::BIGINT AS w, sum(l)::BIGINT AS l, sum(t)::BIGINT AS t, sum(w + l + t)::BIGINT AS n FROM (SELECT l_returnflag AS a, l_linestatus AS b, l_quantity::BIGINT AS w, l_linenumber::BIGINT AS l, CASE WHEN l_linenumber = 1 THEN 0 ELSE 100 * l_linenumber END::BIGINT AS t FROM lineitem) GROUP BY a, b",
    "content_digest": " UNION ALL ".join(f"SELECT '{k}' AS \"of\", n_rows, content FROM ({v})" for k, v in _DIGESTS.items()),
    "raw_matchups": sql("SELECT * FROM raw"),
    "maxn_flat": sql("SELECT * FROM maxn"),
    "alias_index": sql("SELECT * FROM aliases"),
    "alias_apply": sql("SELECT p_partkey, coalesce(canonical, trim('  ' || upper(p_brand) || ' ')) AS deck FROM part LEFT JOIN aliases ON lower(p_brand) = key"),
    "alias_coverage": sql("SELECT 100.0::DOUBLE * avg(CASE WHEN key IS NULL THEN 0 ELSE 1 END) AS coverage_pct FROM part LEFT JOIN aliases ON lower(p_brand) = key"),
    "count_coercion": "SELECT a, b, sum(w)::BIGINT AS w, sum(l)::BIGINT AS l, 0::BIGINT AS t, sum(w + l)::BIGINT AS n FROM (SELECT trim(o_orderpriority) AS a, trim(o_orderstatus) AS b, o_orderkey AS w, greatest(o_custkey - 700, 0) AS l FROM orders) GROUP BY a, b",
    "symmetrize": sql(_SYM.format(best="mbest")),
    "flat_alias": sql("SELECT * FROM flat"),
    "usage_share": sql("SELECT * FROM shares"),
    "top_meta_cut": sql("SELECT * FROM cut"),
    "top_meta_canonical": sql("SELECT * FROM canonical"),
    "top_meta_parts": "WITH q AS (SELECT p_name || '/' || p_partkey AS deck, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), s AS (SELECT deck, 100.0::DOUBLE * q / sum(q) OVER () AS share FROM q), c AS (SELECT *, sum(share) OVER (ORDER BY share DESC, deck ROWS UNBOUNDED PRECEDING) AS share_cum FROM s) SELECT deck, share, share_cum FROM c WHERE share_cum - share < 80",
    "order_ranks": "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place, (sum(o_totalprice::DECIMAL(18,2)) OVER (ORDER BY o_totalprice DESC, o_orderkey ROWS UNBOUNDED PRECEDING))::DOUBLE AS through FROM orders",
    "bootstrap_draws": f"SELECT r AS replicate, cell, count(*) AS times FROM (SELECT r, {_DRAW} AS cell FROM (SELECT count(*) AS n FROM orders) CROSS JOIN range(5) a(r) CROSS JOIN (SELECT unnest(range(count(*))) AS d FROM orders)) GROUP BY ALL",
    "k_choice": sql("SELECT * FROM kchosen"),
    "ranking_auto": sql("SELECT * FROM w_ranked"),
    "parse_percent": "SELECT c_custkey, round_even(c_acctbal, 2) AS pct FROM customer",
    "wr_matrix_exclude": sql("SELECT a, b, w, l, t, wr FROM cells"),
    "wr_matrix_half": sql("SELECT a, b, CASE WHEN a = b THEN 50.0 WHEN w + l + t > 0 THEN round_even(100.0::DOUBLE * (w + 0.5::DOUBLE * t) / (w + l + t), 2) END::DOUBLE AS wr FROM cells"),
    "n_dir_cells": sql("SELECT a, b, n_dir FROM cells"),
    "wr_pivot": sql("SELECT a, " + ", ".join(f"sum(winrate) FILTER (b = '{b}') AS \"{b}\"" for b in BRANDS) + " FROM flat GROUP BY a"),
    "missing_filter_kept": sql("SELECT deck, list_position(list_transform(gone, lambda g: list_contains(g, deck)), TRUE)::BIGINT - 1 AS dropped_round FROM faxis CROSS JOIN (SELECT gone FROM alive ORDER BY i DESC LIMIT 1)"),
    "score_table": sql("SELECT * FROM score"),
    "encounter_share": sql("SELECT * FROM enc"),
    **{f"meta_share_{k}": sql(_META.format(to=v)) for k, v in _METAS.items()},
    "meta_blend_fixed": sql("SELECT deck, p_meta, p_enc, tv, corr(p_meta, p_enc) OVER () AS corr, gamma, p FROM blend"),
    "meta_blend_auto": sql("SELECT deck, tv, gamma, greatest(v, 1e-12) / sum(greatest(v, 1e-12)) OVER () AS p FROM (SELECT deck, tv, g AS gamma, (1 - g) * p_meta + g * p_enc AS v FROM (SELECT deck, p_meta, p_enc, tv, least(greatest(0.1::DOUBLE + 1.5 * tv, 0.1), 0.6)::DOUBLE AS g FROM mixed))"),
    "row_weights": sql("SELECT * FROM roww"),
    "split_counts": sql("SELECT * FROM splits"),
    "k_scale": sql("SELECT * FROM scale"),
    "k_grid": sql("SELECT * FROM ks"),
    "predictive_ll": sql("SELECT k, sum(" + _LB.format(a="k / 2 + w_train + w_test", b="k / 2 + l_train + l_test") + " - (" + _LB.format(a="k / 2 + w_train", b="k / 2 + l_train") + ")) AS ll FROM splits CROSS JOIN ks WHERE w_test + l_test > 0 GROUP BY k"),
    "shrink_quantiles": sql("SELECT quantile_cont(r, 0.1) AS r_p10, quantile_cont(r, 0.5) AS r_p50, quantile_cont(r, 0.9) AS r_p90, median(CASE WHEN n_dir <= q25 THEN r END) AS r_small_med FROM (SELECT n_dir, 6.0::DOUBLE / (n_dir + 6.0::DOUBLE) AS r, (SELECT quantile_cont(n_dir, 0.25) FROM obs) AS q25 FROM obs)"),
    "posterior_cells": sql("SELECT a, b, p_hat, var_hat FROM post"),
    "report_posterior": sql("SELECT a, b, p_hat_pct, se_pct, se_binom_pct FROM rpost"),
    "mas_se_lb": sql("SELECT * FROM mean"),
    "bt_edges": sql("SELECT a, b, n_ij, n_ji, n_base, s_bar, p_bar FROM edges"),
    "bt_diagnostics": sql("SELECT * FROM diag"),
    "bt_soft_weights": sql("SELECT * FROM soft"),
    "bt_strength": sql("SELECT deck, pi / (exp(avg(ln(pi)) OVER ()) + 1e-12) AS pi FROM solved"),
    "league_weights": sql("SELECT * FROM lsoft"),
    "league_strength": sql("SELECT league, deck, pi / (exp(avg(ln(pi)) OVER (PARTITION BY league)) + 1e-12) AS pi FROM lsolved"),
    "league_filter": sql("SELECT x.league, x.deck, list_position(list_transform(gone, lambda g: list_contains(g, x.deck)), TRUE)::BIGINT - 1 AS dropped_round FROM laxis x LEFT JOIN (SELECT league, arg_max(gone, i) AS gone FROM lalive GROUP BY league) g ON g.league = x.league"),
    "bt_percent": sql("SELECT * FROM btp"),
    "composite_score": "SELECT deck, " + _PHI + " AS score FROM (SELECT deck, 0.72::DOUBLE * (" + _Z.format(x="lb") + ") + (1 - 0.72::DOUBLE) * (" + _Z.format(x="bt") + ") AS z FROM (SELECT s_name AS deck, s_acctbal AS lb, (s_suppkey % 17)::DOUBLE AS bt FROM supplier))",
    "ranking": sql("SELECT * FROM ranked"),
    "ranking_topk": sql("SELECT rank, deck, score FROM ranked WHERE rank <= 10"),
    "coverage": sql("SELECT * FROM scover"),
    "missing_pairs": sql("SELECT a AS deck, b AS missing_opponent FROM scells WHERE a <> b AND coalesce(n_dir, 0) <= 0"),
    "pairs_by_entity": sql("SELECT * FROM styled"),
    "summary_sheet": sql("SELECT rank, deck, " + ", ".join(f"round_even({c}, 2) AS {c}" for c in ("score", "mas", "lb", "bt", "se", "n_eff", "coverage_pct")) + ", opp_used, opp_total FROM ranked"),
    "heatmap_cells": sql("SELECT x.rank AS a_rank, y.rank AS b_rank, c.a, c.b, wr FROM cells c JOIN ranked x ON x.deck = c.a JOIN ranked y ON y.deck = c.b WHERE x.rank <= 12 AND y.rank <= 12 AND x.rank >= y.rank"),
    "gap_flags": "SELECT CASE WHEN abs(l_quantity - 25) >= 8 THEN 'RED' WHEN abs(l_quantity - 25) >= 4 THEN 'YELLOW' END AS gap_flag, count(*) AS n FROM lineitem GROUP BY 1",
    "topk_contrib": sql("SELECT a, opponent, contrib FROM styled WHERE is_topk"),
    "sheet_names": r"WITH b AS (SELECT deck, CASE WHEN c = '' THEN 'Sheet' ELSE c END AS base FROM (SELECT DISTINCT p_type || '/' || p_name AS deck, trim(substr(trim(replace(regexp_replace(p_type || '/' || p_name, '[\[\]:*?/\\]', '', 'g'), '~', '-')), 1, 31)) AS c FROM part)), n AS (SELECT *, row_number() OVER (PARTITION BY lower(base) ORDER BY deck) AS i FROM b) SELECT deck, CASE WHEN i = 1 THEN base ELSE substr(base, 1, 30 - length(i::VARCHAR)) || '~' || i END AS sheet FROM n",
    "validate_matrix": sql(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER ({c}) AS n_bad FROM cells x JOIN cells y ON x.a = y.b AND x.b = y.a" for k, c in _CHECKS.items())),
    "validate_shape": sql("SELECT unnest(['one_axis_only', 'no_name', 'cell_missing', 'cell_twice']) AS \"check\", unnest([count(*) FILTER (a NOT IN (SELECT b FROM scells)), count(*) FILTER (a IS NULL), count(DISTINCT a) * count(DISTINCT b) - count(DISTINCT (a, b)), count(*) - count(DISTINCT (a, b))])::BIGINT AS n_bad FROM scells"),
    "declared_usage": sql("SELECT deck, CASE WHEN deck = 'Brand#11' THEN 0 ELSE share END AS share FROM shares"),
    "validate_score": sql(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER ({c}) AS n_bad FROM score x LEFT JOIN score y ON x.a = y.b AND x.b = y.a" for k, c in _SCORE_CHECKS.items())),
    "validate_missing": sql("SELECT a, n_missing, allowed, n_missing <= allowed AS ok FROM (SELECT a, count(*) FILTER (wr IS NULL) AS n_missing, greatest(1, floor(count(*) * 0.02::DOUBLE)::BIGINT) AS allowed FROM scells WHERE a <> b GROUP BY a)"),
    "validate_coverage": sql(_checked(_COVER_CHECKS, _COVERED)),
    "validate_recomputed": sql(_checked(_AGAIN_CHECKS, _AGAIN)),
    "validate_bt_weights": sql(_checked(_BT_CHECKS, "soft")),
    "validate_verdict": sql("SELECT sum(n_bad) = 0 AS passed FROM (" + " UNION ALL ".join([_checked(_CHECKS, "scells x JOIN scells y ON x.a = y.b AND x.b = y.a"), _checked(_SCORE_CHECKS, _SCORED), _checked(_COVER_CHECKS, _COVERED), _checked(_AGAIN_CHECKS, _AGAIN)]) + ")"),
    "axis_difference": sql("SELECT deck, 'right' AS missing_in FROM axis WHERE deck NOT IN (SELECT p_brand FROM part) UNION ALL SELECT DISTINCT p_brand, 'left' FROM part WHERE p_brand NOT IN (SELECT deck FROM axis)"),
    "label_keys": "SELECT p_partkey, lower(trim(regexp_replace(p_type, '\\s+', ' ', 'g'))) AS inner_key, lower(replace(p_type, ' ', '  ')) AS outer_key FROM part",
    "alias_unchanged": sql("SELECT p_partkey, coalesce(canonical, '  ' || upper(p_brand) || ' ') AS deck FROM part LEFT JOIN aliases ON lower(p_brand) = key"),
    "usage_columns": sql("SELECT * FROM shares"),
    "csv_flat": sql("SELECT a, b, w, l, t, n, winrate FROM flat"),
    "csv_matrix": sql("SELECT x.a, y.b, winrate AS value FROM (SELECT DISTINCT a FROM flat) x CROSS JOIN (SELECT DISTINCT b FROM flat) y LEFT JOIN flat f ON f.a = x.a AND f.b = y.b"),
    "page_scan": sql("SELECT a, b, w, l, t, n, winrate FROM maxn"),
    "page_scan_counts": sql("SELECT count(DISTINCT a) AS total, count(DISTINCT a) FILTER (a < 'Brand#3') AS cache_hits FROM maxn"),
    "page_decklist": "SELECT row_number() OVER (ORDER BY q DESC, deck) AS rank, deck, floor(q * 100 / sum(q) OVER ())::BIGINT || ' %' AS share, q AS count, 'https://example.com/decks/' || deck AS url FROM (SELECT p_brand AS deck, sum(l_quantity)::BIGINT AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)",
    "cached_fetch": "SELECT page_id, coalesce(TIMESTAMP '2024-01-15 12:00:00' - seen < INTERVAL 720 MINUTE, FALSE) AS from_cache, coalesce(TIMESTAMP '2024-01-15 12:00:00' - seen < INTERVAL 720 MINUTE, FALSE) AS has_html FROM pages LEFT JOIN (SELECT url, max(ts) AS seen FROM pages JOIN events ON user_id = page_id WHERE ts < TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1) USING (url)",
    "pairs_report": sql("SELECT a, b_rank, opponent, w, l, n, wr_real, p_hat, se_binom, gap FROM pairs"),
    "report_sheets": sql("SELECT (row_number() OVER (ORDER BY r.o, r.sheet))::INT AS place, r.sheet AS sheet, r.deck AS deck, r.n AS n_rows FROM (SELECT unnest([{'o': -1, 'sheet': '00_Legenda', 'deck': NULL::VARCHAR, 'n': 23::BIGINT}, {'o': 0, 'sheet': '01_Summary', 'deck': NULL::VARCHAR, 'n': count(*)}] || list({'o': rank, 'sheet': deck, 'deck': deck, 'n': t})) AS r FROM (SELECT *, count(*) OVER () AS t FROM ranked))"),
    "legend": sql("SELECT ord, part, item, coalesce(meaning, (SELECT count(*)::VARCHAR FROM ranked)) AS meaning, colour FROM (VALUES " + ", ".join(f"({i}, {', '.join(map(_TOLD, r))})" for i, r in enumerate(_LEGEND)) + ") v(ord, part, item, meaning, colour)"),
    "ranking_display": sql("SELECT format('{:,}', rank) AS rank, deck, format('{:,.1f}', score) AS score, format('{:,.0f}', n_eff) AS n_eff, format('{:,.2f}', coverage_pct) AS coverage_pct FROM ranked WHERE rank <= 9"),
    "pairs_sorted": sql("SELECT a, (row_number() OVER (PARTITION BY a ORDER BY gap DESC NULLS LAST, b_rank))::INT AS b_rank, opponent, gap FROM pairs WHERE opponent <> 'Mirror'"),
    "workbook_cells": """WITH r AS (SELECT p_brand AS sheet, (row_number() OVER (PARTITION BY p_brand ORDER BY p_size))::INT AS row, p_size, count(*) AS parts, max(p_retailprice) AS price FROM part GROUP BY p_brand, p_size)
      SELECT sheet, row, 0 AS col, p_size::DOUBLE AS number, '' AS style FROM r UNION ALL SELECT sheet, row, 1, parts, CASE WHEN parts >= 3 THEN 'red' WHEN parts = 2 THEN 'yellow' ELSE '' END FROM r UNION ALL SELECT sheet, row, 2, price, '' FROM r""",
    "sheet_order": """WITH decks AS (SELECT deck, row_number() OVER (ORDER BY deck DESC) AS ord FROM (SELECT DISTINCT p_brand AS deck FROM part)),
      sheets AS (SELECT unnest([deck, deck || ' b', 'x ' || lower(deck)]) AS sheet FROM decks UNION ALL SELECT DISTINCT p_type FROM part UNION ALL VALUES ('00_Legenda'), ('01_Summary')),
      met AS (SELECT sheet, ord, CASE WHEN sheet = deck THEN 0 WHEN starts_with(lower(deck), lower(sheet)) OR starts_with(lower(sheet), lower(deck)) THEN 1 WHEN contains(lower(sheet), lower(deck)) OR contains(lower(deck), lower(sheet)) THEN 2 END AS kind FROM sheets CROSS JOIN decks),
      best AS (SELECT sheet, arg_min(ord, kind * 1000 + ord) AS ord FROM met WHERE kind IS NOT NULL GROUP BY 1)
      SELECT sheet, (row_number() OVER (ORDER BY CASE WHEN sheet IN ('00_Legenda', '01_Summary') THEN 0 WHEN ord IS NOT NULL THEN 1 ELSE 2 END, ord, sheet))::INT AS place FROM sheets LEFT JOIN best USING (sheet)""",
    "sheet_order_parts": """WITH d AS (SELECT p_partkey AS ord, p_name || ' ' || p_partkey AS deck FROM part),
      sheets AS (SELECT DISTINCT CASE ord % 4 WHEN 0 THEN upper(deck) WHEN 1 THEN 'my ' || deck WHEN 2 THEN substr(deck, 3, 60) ELSE 'none ' || ord || '?' END AS sheet FROM d),
      met AS (SELECT sheet, ord, CASE WHEN sheet = deck THEN 0 WHEN starts_with(lower(deck), lower(sheet)) OR starts_with(lower(sheet), lower(deck)) THEN 1 WHEN contains(lower(sheet), lower(deck)) OR contains(lower(deck), lower(sheet)) THEN 2 END AS kind FROM sheets CROSS JOIN d),
      best AS (SELECT sheet, arg_min(ord, (kind, ord)) AS ord FROM met WHERE kind IS NOT NULL GROUP BY 1)
      SELECT sheet, (row_number() OVER (ORDER BY CASE WHEN ord IS NOT NULL THEN 1 ELSE 2 END, ord, sheet))::INT AS place FROM sheets LEFT JOIN best USING (sheet)""",
    "report_workbook": sql("""SELECT 0 AS place, '00_Legenda' AS sheet, 23 AS n_rows, 1::BIGINT AS best, 1::BIGINT AS strong UNION ALL SELECT 1, '01_Summary', count(*)::INT, 0, 0 FROM ranked
      UNION ALL SELECT (r.rank + 1)::INT, s.a, count(*)::INT, count(*) FILTER (is_topk AND NOT is_mirror), count(*) FILTER (gap_flag = 'RED') FROM styled s JOIN ranked r ON r.deck = s.a GROUP BY r.rank, s.a"""),
    "cache_writeback": "SELECT page_id, bool_or(page_id % 2 = 0) OVER (PARTITION BY trim(url)) AS second, TRUE AS third, length(max(html) OVER (PARTITION BY trim(url))) AS chars FROM pages",
    "retention_applied": "SELECT 'delete' AS action, TRUE AS done, count(*) FILTER (r_regionkey % 2 = 0) AS n FROM region UNION ALL SELECT 'keep', FALSE, count(*) FROM region UNION ALL SELECT 'left', FALSE, count(*) FROM region",
    "alias_file": "SELECT DISTINCT p_type AS canonical, unnest([p_type, p_brand]) AS spelling FROM part",
    "pivot_strict": sql("SELECT a, " + ", ".join(f"sum(winrate) FILTER (b = '{b}') AS \"{b}\"" for b in BRANDS if b != "Brand#31") + " FROM flat GROUP BY a"),
    "bt_without_edges": sql("SELECT deck, 50.0::DOUBLE AS bt FROM axis"),
    "matchup_url": "SELECT page_id, h || CASE WHEN ends_with(p, '/matchups') THEN p ELSE p || '/matchups' END || CASE WHEN length(q) > 1 THEN q ELSE '' END || CASE WHEN length(f) > 1 THEN f ELSE '' END AS matchup_url FROM (SELECT page_id, regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1) AS h, rtrim(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/') AS p, regexp_extract(url, '^[^?#]*(\\?[^#]*)', 1) AS q, regexp_extract(url, '(#.*)$', 1) AS f FROM pages)",
    "cache_key": "SELECT page_id, substr(sha256(url), 1, 16) AS cache_key FROM pages",
    "cache_fresh": "SELECT event_id, TIMESTAMP '2024-01-15 12:00:00' - ts < INTERVAL 720 MINUTE AS fresh FROM events",
    "url_dedupe": f"SELECT min(page_id) AS page_id, {_CUT_URL} AS url FROM pages GROUP BY 2",
    "retention_plan": "SELECT CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 THEN 'delete' ELSE 'keep' END AS action, count(*) AS n FROM orders GROUP BY 1",
}
