"""The queries of ``monthly`` in plain SQL, for comparison."""

from __future__ import annotations

_W = """w AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, r_name AS country, c_mktsegment AS platform,
         CAST(floor(p_size / 10) AS INT) AS root, p_size AS node, p_type AS l1,
         concat(p_type, '/', split_part(p_name, ' ', 2)) AS l2,
         concat(p_type, '/', split_part(p_name, ' ', 2), '/', split_part(p_name, ' ', 1)) AS leaf,
         p_partkey AS item, split_part(p_name, ' ', 1) AS raw_brand, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(18,2)) AS list_price, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(20,4)) AS amt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
)"""
_CUR = "cur AS (SELECT * FROM w WHERE item % 29 <> 0)"
_PREV = """prev AS (
  SELECT month, country, platform, CASE WHEN node IN (40, 41) THEN 9 ELSE root END AS root, node, l1,
         CASE WHEN item % 31 = 0 THEN concat(l1, '/moved') ELSE l2 END AS l2, leaf, item, raw_brand,
         CASE WHEN item % 37 = 0 THEN 'OTHERS' ELSE brand END AS brand, list_price,
         CAST(qty + CASE WHEN item % 17 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS qty, amt
  FROM w WHERE item % 23 <> 0 AND month < DATE '2001-11-01'
)"""
_M, _B = "DATE '2001-06-01'", "DATE '2001-05-01'"


def _sum(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE)"


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _r(x: str, n: int = 6) -> str:
    return f"floor(({x}) * {10**n} + 0.5) / {10**n}"


def _ratio(a: str, b: str, n: int = 6) -> str:
    return _r(f"CASE WHEN {_d(b)} <> 0 THEN {_d(a)} / {_d(b)} END", n)


def _of(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([_W, *more]) + "\n" + body


def _recursive(body: str, *more: str) -> str:
    return _of(body, *more).replace("WITH ", "WITH RECURSIVE ", 1)


_BOTH = (_CUR, _PREV)
_SITE = "country, platform"
_TOTALS = f"count(*) AS rows, {_sum('qty')} AS qty, {_sum('amt')} AS amt"

_C1 = f"""
SELECT month, country, platform, CAST(gid AS INT) AS gid, {_d('a')} AS amt, {_d('q')} AS qty, items, {_ratio('a', 'q')} AS mean_price,
       {_ratio('a', 'sum(a) OVER (PARTITION BY month, gid)')} AS share
FROM (SELECT month, country, platform, grouping(month, country, platform) AS gid, sum(amt) AS a, sum(qty) AS q, count(DISTINCT item) AS items
      FROM w GROUP BY GROUPING SETS ((month), (month, country), (month, country, platform)))"""


def _months(keys: str, how: str) -> str:
    side = lambda m, s: f"(SELECT {keys}, item, sum(qty) AS q{s}, sum(amt) AS a{s} FROM w WHERE month = {m} GROUP BY {keys}, item)"
    return f"{side(_B, 0)} x {how} JOIN {side(_M, 1)} y USING ({keys}, item)"


_BAND = "CAST(" + " + ".join(f"CASE WHEN price >= {e} THEN 1 ELSE 0 END" for e in (1000.0, 2000.0, 3000.0, 5000.0)) + " AS INT)"


def _bands(where: str) -> str:
    return f"""SELECT l2, band, count(*) AS items, {_d('sum(q)')} AS qty, {_d('sum(a)')} AS amt, {_ratio('sum(a)', 'sum(sum(a)) OVER (PARTITION BY l2)')} AS share
      FROM (SELECT *, {_BAND} AS band FROM (SELECT l2, item, sum(qty) AS q, sum(amt) AS a, {_d('sum(amt)')} / {_d('sum(qty)')} AS price FROM w {where} GROUP BY l2, item HAVING sum(qty) <> 0))
      GROUP BY l2, band"""


_CHANGE = f"""
SELECT n.month, n.country, n.platform, {_d('n.v')} AS amt, {_ratio('n.v - p.v', 'p.v')} AS change_1, {_ratio('n.v - y.v', 'y.v')} AS change_12
FROM s n LEFT JOIN s p ON p.country = n.country AND p.platform = n.platform AND p.month = CAST(n.month - INTERVAL '1' MONTH AS DATE)
LEFT JOIN s y ON y.country = n.country AND y.platform = n.platform AND y.month = CAST(n.month - INTERVAL '12' MONTH AS DATE)"""
_S = "s AS (SELECT month, country, platform, sum(amt) AS v FROM w GROUP BY month, country, platform)"

_BREAK = """brk AS (
  SELECT month, country, platform, value, list_aggregate(h, 'median') AS median,
         list_aggregate(list_transform(h, lambda x: abs(x - list_aggregate(h, 'median'))), 'median') AS mad
  FROM (SELECT *, list(value) OVER (PARTITION BY country, platform ORDER BY month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS h
        FROM (SELECT month, country, platform, CAST(sum(amt) AS DOUBLE) AS value FROM w GROUP BY month, country, platform))
  WHERE len(h) = 6
)"""


def _jump(k: float) -> str:
    return f"""jump AS (
  SELECT country, platform, item, month, prior_month, {_r('price / prior')} AS moved, a AS amt
  FROM (SELECT *, lag(price) OVER o AS prior, lag(month) OVER o AS prior_month
        FROM (SELECT country, platform, item, month, {_sum('amt')} AS a, {_sum('amt')} / {_sum('qty')} AS price FROM w GROUP BY country, platform, item, month HAVING sum(qty) <> 0)
        WINDOW o AS (PARTITION BY country, platform, item ORDER BY month))
  WHERE price / prior > {k} OR price / prior < 1 / {k}
)"""


_NAMES = """names AS (
  SELECT item, CASE WHEN item % 3 = 0 THEN upper(raw_brand) WHEN item % 3 = 1 THEN concat(raw_brand, '(', l1, ')') ELSE raw_brand END AS raw_brand,
         CASE WHEN item % 9 = 0 THEN brand WHEN item % 9 = 1 THEN concat(upper(raw_brand), '/', brand) ELSE concat(raw_brand, '（', l1, '）') END AS brand, sum(amt) AS amt
  FROM w GROUP BY ALL
)"""
_SPLIT = "string_split_regex({}, '[/／()（）]')"


def _parts(col: str, low: bool = False) -> str:
    x = f"unnest({_SPLIT.format(col)})"
    return f"trim(lower({x}))" if low else f"trim({x})"


_JUDGED = """judged AS (
  SELECT d.doc_id AS item, lang, source, CAST(n_chars AS DECIMAL(20,4)) AS amt,
         CASE WHEN d.doc_id % 10 = 0 THEN 'unsure' WHEN quality = 0 OR toxic = 1 THEN 'mismatch' ELSE 'match' END AS verdict,
         CASE WHEN d.doc_id % 3 = 0 THEN 'top' ELSE 'random' END AS reason
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""
_DEFECTS = """defects(id, country, platform, l2, measure, bound) AS (
  VALUES (1, 'ASIA', NULL, NULL, 'amt', 60000.0), (2, NULL, 'BUILDING', 'SMALL/bolt', 'qty', 60.0), (3, 'EUROPE', 'FURNITURE', NULL, 'qty', 1.0), (4, 'NOWHERE', NULL, NULL, 'amt', 1.0)
)"""
_RECHECK = f"""recheck AS (
  SELECT id, measure, CASE WHEN v IS NULL THEN 'not evaluable' WHEN v > bound THEN 'still present' ELSE 'fixed' END AS state, {_r('v', 4)} AS value
  FROM (SELECT id, measure, bound, sum(floor(CASE WHEN measure = 'qty' THEN q ELSE a END * 10000 + 0.5)) / 10000 / sum(n) AS v
        FROM (SELECT d.id, d.measure, CAST(d.bound AS DOUBLE) AS bound, s.q, s.a, s.n FROM defects d
              LEFT JOIN (SELECT country, platform, l2, {_sum('qty')} AS q, {_sum('amt')} AS a, count(*) AS n
                         FROM (SELECT month, country, platform, l2, item, sum(qty) AS qty, sum(amt) AS amt FROM w GROUP BY ALL) GROUP BY country, platform, l2) s
              ON (d.country IS NULL OR d.country = s.country) AND (d.platform IS NULL OR d.platform = s.platform) AND (d.l2 IS NULL OR d.l2 = s.l2))
        GROUP BY id, measure, bound)
)"""
_RESTATED = f"""
SELECT coalesce(c.month, p.month) AS month, coalesce(c.country, p.country) AS country, coalesce(c.platform, p.platform) AS platform, {_ratio('c.v', 'p.v')} AS ratio
FROM (SELECT month, country, platform, sum(amt) AS v FROM cur GROUP BY ALL) c
FULL JOIN (SELECT month, country, platform, sum(amt) AS v FROM prev GROUP BY ALL) p USING (month, country, platform)"""
_FLAGGED = f"""chg AS ({_CHANGE}), rst AS ({_RESTATED}), flagged AS (
  SELECT 'level' AS module, json_object('month', CAST(month AS VARCHAR), 'country', country, 'platform', platform)::VARCHAR AS key, 'change_1' AS metric, change_1 AS value, 'month-on-month' AS rule, 2 AS severity FROM chg WHERE change_1 < -0.9 OR change_1 > 2.0
  UNION ALL SELECT 'level', json_object('month', CAST(month AS VARCHAR), 'country', country, 'platform', platform)::VARCHAR, 'change_12', change_12, 'year-on-year', 1 FROM chg WHERE change_12 < -0.9 OR change_12 > 3.0
  UNION ALL SELECT 'restated', json_object('month', CAST(month AS VARCHAR), 'country', country, 'platform', platform)::VARCHAR, 'ratio', ratio, 'restated', 3 FROM rst WHERE ratio < 0.95 OR ratio > 1.05
)"""
_TOLD = """told(country, platform, f, t) AS (
  VALUES ('ASIA', 'BUILDING', DATE '1996-01-01', DATE '1998-12-01'), (NULL, 'FURNITURE', DATE '2000-01-01', DATE '2000-06-01'), ('EUROPE', NULL, DATE '1997-03-01', DATE '1997-03-01')
)"""
_MASK = "regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)*', '<mail>', 'g'), '[0-9]{1,3}(\\.[0-9]{1,3}){3}', '<address>', 'g'), '\\+?[0-9][0-9 ()-]{5,}[0-9]', '<number>', 'g')"
_LEAF_MIX = f"SELECT l2, root, count(DISTINCT item) AS items, {_sum('amt')} AS amt, {_ratio('count(DISTINCT item)', 'sum(count(DISTINCT item)) OVER (PARTITION BY l2)')} AS item_share, {_ratio('sum(amt)', 'sum(sum(amt)) OVER (PARTITION BY l2)')} AS share FROM w GROUP BY l2, root"
_RANKED = "SELECT l2, brand, sum(amt) AS a, row_number() OVER (PARTITION BY l2 ORDER BY sum(amt) DESC, brand) AS rank FROM w WHERE month = {} GROUP BY l2, brand"
_HEAD = "SELECT l2, item FROM (SELECT l2, item, row_number() OVER (PARTITION BY l2 ORDER BY sum(amt) DESC, item) AS r FROM w WHERE month = {} GROUP BY l2, item) WHERE r <= 5"

_KEY = "json_object('month', CAST(month AS VARCHAR), 'country', country, 'platform', platform)::VARCHAR"
_GRAINED = f"""chg AS ({_CHANGE}), g1 AS (
  SELECT DISTINCT month, country, platform, true AS h1 FROM chg WHERE change_1 < -0.9 OR change_1 > 2.0 OR change_12 < -0.9 OR change_12 > 3.0
), g2 AS (SELECT l2, root, true AS h2 FROM ({_LEAF_MIX}) WHERE share < 0.03
), g3 AS (SELECT DISTINCT month, country, platform, item, true AS h3 FROM jump
), hit AS (
  SELECT b.*, h1, h2, h3 FROM (SELECT month, country, platform, l2, root, item, sum(amt) AS amt FROM w GROUP BY ALL) b
  LEFT JOIN g1 USING (month, country, platform) LEFT JOIN g2 USING (l2, root) LEFT JOIN g3 USING (month, country, platform, item)
)"""

_FAMILIES = """names AS (
  SELECT item, CASE item % 4 WHEN 0 THEN concat(raw_brand, '(', raw_brand, '-k)') WHEN 1 THEN concat(raw_brand, '-k/', upper(concat(raw_brand, '-z'))) WHEN 2 THEN concat(raw_brand, '-z') ELSE raw_brand END AS raw_brand,
         CASE item % 8 WHEN 3 THEN brand WHEN 2 THEN upper(raw_brand) ELSE raw_brand END AS brand, sum(amt) AS amt
  FROM w GROUP BY ALL
), part AS (
  SELECT DISTINCT raw_brand, token FROM (SELECT raw_brand, trim(lower(unnest(string_split_regex(raw_brand, '[/／()（）]')))) AS token FROM names) WHERE token <> ''
), link AS (SELECT DISTINCT a.token AS x, b.token AS y FROM part a JOIN part b USING (raw_brand) WHERE a.token <> b.token
), reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), fam AS (SELECT x AS token, least(x, min(y)) AS family FROM reach GROUP BY x
), std AS (
  SELECT DISTINCT brand, token FROM (SELECT brand, trim(lower(unnest(string_split_regex(brand, '[/／()（）]')))) AS token FROM names) WHERE token <> ''
)"""

ORACLE: dict[str, str] = {
    "A1_load_sales": _of(f"SELECT {_SITE}, {_TOTALS} FROM w GROUP BY {_SITE}"),
    "A2_apply_scope": _of(f"SELECT month, {_SITE}, {_TOTALS} FROM w WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT {_SITE} FROM w) s WHERE s.country = w.country AND s.platform = w.platform AND s.country IN ('ASIA', 'EUROPE') AND s.platform IN ('BUILDING', 'MACHINERY', 'FURNITURE')) GROUP BY month, {_SITE}"),
    "A3_freeze": "SELECT DISTINCT p_type AS l1, p_brand FROM part",
    "A4_merge_rulings": _of("""SELECT coalesce(s.l2, r.l2) AS l2, coalesce(r.rule, s.rule) AS rule, CASE WHEN r.l2 IS NULL THEN 'standard' WHEN s.l2 IS NULL THEN 'new' ELSE 'ruling' END AS source
FROM std s FULL JOIN (SELECT l2, 'ruled' AS rule FROM std WHERE l2 LIKE '%bolt' UNION ALL SELECT concat(l2, '-new'), rule FROM std WHERE l2 LIKE '%gear') r ON s.l2 = r.l2""", "std AS (SELECT l2, min(l1) AS rule FROM w GROUP BY l2)"),
    "A5_land": _of(_C1),
    "A6_fingerprint": _of(f"SELECT count(*) AS rows, max(month) AS updated, {_sum('amt')} AS amt FROM w"),
    "A6_changed_months": _of("SELECT DISTINCT month FROM w WHERE item = 100 AND qty > 10"),
    "A5_landed_view": _of(f"{_CHANGE} WHERE n.month = {_M}", *_BOTH, _S.replace("FROM w", "FROM cur")),
    "A7_intake": f"SELECT conv_id, turn, role, {_MASK} AS text FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations f WHERE f.conv_id = c.conv_id AND f.conv_id % 3 = 0)",
    "A7_mask": f"SELECT doc_id, {_MASK} AS text FROM documents d WHERE regexp_matches(text, '[0-9@]')",
    "B1_arrival": _of(f"SELECT country, platform, l2, month, coalesce(n, 0) AS rows, coalesce(i, 0) AS items, n IS NULL AS missing FROM (SELECT DISTINCT country, platform, l2 FROM w) CROSS JOIN (SELECT DISTINCT month FROM w) LEFT JOIN (SELECT country, platform, l2, month, count(*) AS n, count(DISTINCT item) AS i FROM w GROUP BY ALL) USING (country, platform, l2, month)"),
    "B2_duplicates": f"SELECT n, count(*) AS groups, CAST(sum(n - 1) AS BIGINT) AS excess_rows, {_sum('over_amt')} AS excess_amt FROM (SELECT count(*) AS n, sum(amt) - max(amt) AS over_amt FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt FROM lineitem) GROUP BY l_orderkey, l_linenumber) WHERE n > 1 GROUP BY n",
    "B3_fill_rate": _of(" UNION ALL ".join(f"SELECT month, {_SITE}, '{c}' AS field, {_ratio(f'count(*) FILTER (WHERE {x})', 'count(*)')} AS filled FROM w GROUP BY month, {_SITE}" for c, x in (("raw_brand", "item % 7 <> 0 AND raw_brand <> ''"), ("brand", "item % 11 <> 0 AND brand <> ''"), ("list_price", "list_price IS NOT NULL")))),
    "B4_push_diff": _of(f"""SELECT month, status, count(*) AS keys, {_sum('coalesce(ca, 0) - coalesce(pa, 0)')} AS effect FROM (
  SELECT coalesce(c.month, p.month) AS month, c.amt AS ca, p.amt AS pa, CASE WHEN p.item IS NULL THEN 'added' WHEN c.item IS NULL THEN 'removed' WHEN c.qty = p.qty AND c.amt = p.amt AND c.l2 = p.l2 AND c.brand = p.brand AND c.root = p.root THEN 'same' ELSE 'changed' END AS status
  FROM (SELECT month, country, platform, item, l2, brand, root, sum(qty) AS qty, sum(amt) AS amt FROM cur GROUP BY ALL) c
  FULL JOIN (SELECT month, country, platform, item, l2, brand, root, sum(qty) AS qty, sum(amt) AS amt FROM prev GROUP BY ALL) p
  ON c.month = p.month AND c.country = p.country AND c.platform = p.platform AND c.item = p.item) GROUP BY month, status""", *_BOTH),
    "B4_push_diff_by_tree": _of(f"""SELECT month, status, count(*) AS keys, {_sum('coalesce(ca, 0) - coalesce(pa, 0)')} AS effect FROM (
  SELECT coalesce(c.month, p.month) AS month, c.amt AS ca, p.amt AS pa, CASE WHEN p.item IS NULL THEN 'added' WHEN c.item IS NULL THEN 'removed' WHEN c.qty = p.qty AND c.amt = p.amt AND c.l2 = p.l2 AND c.brand = p.brand AND c.root = p.root THEN 'same' ELSE 'changed' END AS status
  FROM (SELECT month, country, platform, item, l2, brand, root, sum(qty) AS qty, sum(amt) AS amt FROM cur GROUP BY ALL) c
  FULL JOIN (SELECT month, country, platform, item, l2, brand, root, sum(qty) AS qty, sum(amt) AS amt FROM prev GROUP BY ALL) p
  ON c.month = p.month AND c.country = p.country AND c.platform = p.platform AND c.item = p.item) GROUP BY month, status""", *_BOTH),
    "B4_changed_parts": _of("SELECT month, country, platform, count(*) AS parts FROM (SELECT month, country, platform, item, sum(qty) AS q FROM w WHERE item = 100 GROUP BY ALL) WHERE q > 10 GROUP BY month, country, platform"),
    "B5_restatement_by_tree": _of(f"SELECT coalesce(c.month, p.month) AS month, {_d('c.v')} AS cur_amt, {_d('p.v')} AS prev_amt, {_ratio('c.v', 'p.v')} AS ratio FROM (SELECT month, sum(amt) AS v FROM cur GROUP BY month) c FULL JOIN (SELECT month, sum(amt) AS v FROM prev GROUP BY month) p USING (month)", *_BOTH),
    "B5_restatement": _of(f"SELECT coalesce(c.month, p.month) AS month, {_d('c.v')} AS cur_amt, {_d('p.v')} AS prev_amt, {_ratio('c.v', 'p.v')} AS ratio FROM (SELECT month, sum(amt) AS v FROM cur GROUP BY month) c FULL JOIN (SELECT month, sum(amt) AS v FROM prev GROUP BY month) p USING (month)", *_BOTH),
    "C1_site_totals": _of(_C1),
    "C2_period_change": _of(_CHANGE, _S),
    "C3_level_break": _of("SELECT month, country, platform, value, median, mad FROM brk WHERE mad > 0 AND abs(value - median) > 3.0 * mad", _BREAK),
    "D1_coverage_split": _of(f"SELECT {_SITE}, {_sum('CASE WHEN a0 IS NULL THEN a1 ELSE 0 END')} AS added, {_sum('CASE WHEN a1 IS NULL THEN a0 ELSE 0 END')} AS lost, {_sum('CASE WHEN a0 IS NOT NULL AND a1 IS NOT NULL THEN a1 - a0 ELSE 0 END')} AS matched, {_sum('coalesce(a1, 0) - coalesce(a0, 0)')} AS change FROM {_months(_SITE, 'FULL')} GROUP BY {_SITE}"),
    "D2_count_mean_split": _of(f"SELECT l2, n0, n1, {_r('(n1 - n0) * (s0 / n0)', 4)} AS by_count, {_r('n1 * (s1 / n1 - s0 / n0)', 4)} AS by_mean FROM (SELECT l2, count(a0) AS n0, count(a1) AS n1, {_sum('a0')} AS s0, {_sum('a1')} AS s1 FROM {_months('l2', 'FULL')} GROUP BY l2) WHERE n0 > 0 AND n1 > 0"),
    "D3_volume_price_split": _of(f"SELECT l2, {_d('v')} / 10000 AS by_volume, {_d('c - v')} / 10000 AS by_price, {_d('c')} / 10000 AS change FROM (SELECT l2, sum(CAST(floor((CAST(q1 AS DOUBLE) - CAST(q0 AS DOUBLE)) * (CAST(a0 AS DOUBLE) / CAST(q0 AS DOUBLE)) * 10000 + 0.5) AS BIGINT)) AS v, sum(CAST((a1 - a0) * 10000 AS BIGINT)) AS c FROM {_months('l2', 'INNER')} GROUP BY l2)"),
    "E1_category_results": _of(f"SELECT l1, l2, leaf, CAST(grouping(l1, l2, leaf) AS INT) AS gid, count(DISTINCT item) AS items, {_sum('qty')} AS qty, {_sum('amt')} AS amt FROM w GROUP BY ROLLUP (l1, l2, leaf)"),
    "E2_price_bands": _of(_bands("")),
    "E3_band_shift": _of(f"SELECT l2, sum(floor(abs(coalesce(x.share, 0.0) - coalesce(y.share, 0.0)) * 1000000 + 0.5)) / 2000000 AS shift, count(*) AS bands FROM ({_bands(f'WHERE month = {_M}')}) x FULL JOIN ({_bands(f'WHERE month = {_B}')}) y USING (l2, band) GROUP BY l2"),
    "F1_price_summary": _of(f"""SELECT l2, mean_price, {_r('quantile_cont(price, 0.1)', 4)} AS p10, {_r('quantile_cont(price, 0.5)', 4)} AS p50, {_r('quantile_cont(price, 0.9)', 4)} AS p90, {_r('min(price)', 4)} AS low, {_r('max(price)', 4)} AS high
FROM (SELECT l2, item, month, {_sum('amt')} / {_sum('qty')} AS price FROM w GROUP BY l2, item, month HAVING sum(qty) <> 0) JOIN (SELECT l2, {_ratio('sum(amt)', 'sum(qty)', 4)} AS mean_price FROM w GROUP BY l2) USING (l2) GROUP BY l2, mean_price"""),
    "F2_price_jump": _of("SELECT * FROM jump", _jump(1.5)),
    "F3_peer_outliers": _of(f"SELECT l2, item, {_r('price', 4)} AS price, {_r('price / median', 4)} AS times, a AS amt, suffix(l2, '-其他') AS catch_all FROM p JOIN md USING (l2) JOIN ml USING (l2) WHERE mad > 0 AND abs(price - median) > 2.0 * mad",
        f"p AS (SELECT CASE WHEN suffix(l2, 'bolt') THEN concat(l2, '-其他') ELSE l2 END AS l2, item, {_sum('amt')} AS a, {_sum('amt')} / {_sum('qty')} AS price FROM w GROUP BY 1, item HAVING sum(qty) <> 0)",
        "md AS (SELECT l2, median(price) AS median FROM p GROUP BY l2)", "ml AS (SELECT l2, median(abs(price - median)) AS mad FROM p JOIN md USING (l2) GROUP BY l2)"),
    "G1_tail_profile": _of(f"SELECT l2, count(*) AS items, count(*) FILTER (WHERE CAST(u - a AS DOUBLE) < 0.8 * CAST(t AS DOUBLE)) AS head_items, count(*) FILTER (WHERE CAST(a AS DOUBLE) < 20000.0) AS tail_items, {_ratio('count(*) FILTER (WHERE CAST(a AS DOUBLE) < 20000.0)', 'count(*)')} AS tail_share FROM (SELECT *, sum(a) OVER (PARTITION BY l2 ORDER BY a DESC, item ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS u, sum(a) OVER (PARTITION BY l2) AS t FROM (SELECT l2, item, sum(amt) AS a FROM w GROUP BY l2, item)) GROUP BY l2"),
    "G2_head_turnover": _of(f"SELECT l2, count(n) - count(n + t) AS entries, count(t) - count(n + t) AS exits, {_ratio('count(n + t)', 'count(*)')} AS overlap FROM (SELECT *, 1 AS n FROM ({_HEAD.format(_M)})) FULL JOIN (SELECT *, 1 AS t FROM ({_HEAD.format(_B)})) USING (l2, item) GROUP BY l2"),
    "G3_item_concentration": _of(f"SELECT l2, count(*) AS items, {_r('CAST(sum(a) FILTER (WHERE r <= 1) AS DOUBLE) / max(t)')} AS top1, {_r('CAST(sum(a) FILTER (WHERE r <= 3) AS DOUBLE) / max(t)')} AS top3, {_r('sum(floor(CAST(a AS DOUBLE) / t * (CAST(a AS DOUBLE) / t) * 1e12 + 0.5)) / 1e12')} AS concentration FROM (SELECT *, row_number() OVER (PARTITION BY l2 ORDER BY a DESC, item) AS r, CAST(sum(a) OVER (PARTITION BY l2) AS DOUBLE) AS t FROM (SELECT l2, item, sum(amt) AS a FROM w GROUP BY l2, item)) GROUP BY l2"),
    "G4_steady_price_surge": _of(f"SELECT country, platform, item, month, {_r('q / q0')} AS volume_times, a AS amt FROM (SELECT *, lag(q) OVER o AS q0, lag(price) OVER o AS p0 FROM (SELECT country, platform, item, month, {_sum('qty')} AS q, {_sum('amt')} AS a, {_sum('amt')} / {_sum('qty')} AS price FROM w GROUP BY country, platform, item, month HAVING sum(qty) <> 0) WINDOW o AS (PARTITION BY country, platform, item ORDER BY month)) WHERE q >= 5.0 * q0 AND abs(price / p0 - 1) <= 0.1"),
    "H1_brand_results": _of(f"SELECT month, l1, brand, count(DISTINCT item) AS items, {_sum('qty')} AS qty, {_sum('amt')} AS amt, {_ratio('sum(amt)', 'sum(sum(amt)) OVER (PARTITION BY month, l1)')} AS share FROM w GROUP BY month, l1, brand"),
    "H2_leaf_brand": _of(f"SELECT month, country, platform, leaf, brand, {_sum('amt')} AS amt, {_sum('qty')} AS qty FROM w GROUP BY month, country, platform, leaf, brand"),
    "H3_brand_tokens": _of(f"SELECT token, count(*) AS rows, {_sum('amt')} AS amt FROM (SELECT {_parts('raw_brand')} AS token, amt FROM names) WHERE token <> '' GROUP BY token", _NAMES),
    "H4_brand_variants": _of(f"SELECT min(spelling) OVER g AS variant, spelling, count(*) OVER g AS spellings, CAST(a AS DOUBLE) AS amt FROM (SELECT spelling, sum(amt) AS a FROM (SELECT {_parts('raw_brand')} AS spelling, amt FROM names) WHERE spelling <> '' GROUP BY spelling) WINDOW g AS (PARTITION BY lower(spelling)) QUALIFY spellings > 1", _NAMES),
    "H5_swallowed": _of(f"""SELECT raw_brand, brand, rows, amt FROM pair p WHERE NOT EXISTS (
  SELECT 1 FROM rt JOIN st ON st.brand = p.brand WHERE rt.raw_brand = p.raw_brand AND (rt.token = st.token OR length(rt.token) >= 4 AND levenshtein(rt.token, st.token) <= 1))
AND NOT EXISTS (SELECT 1 FROM rt JOIN al ON al.token = rt.token JOIN st ON st.token = al.alias WHERE rt.raw_brand = p.raw_brand AND st.brand = p.brand)""",
        _NAMES, f"pair AS (SELECT raw_brand, brand, count(*) AS rows, {_sum('amt')} AS amt FROM names GROUP BY raw_brand, brand)",
        f"rt AS (SELECT * FROM (SELECT DISTINCT raw_brand, {_parts('raw_brand', True)} AS token FROM names) WHERE token <> '')",
        f"st AS (SELECT * FROM (SELECT DISTINCT brand, {_parts('brand', True)} AS token FROM names) WHERE token <> '')",
        "al AS (SELECT DISTINCT x.token, y.token AS alias FROM rt x JOIN rt y ON x.raw_brand = y.raw_brand AND x.token <> y.token)"),
    "H6_split_brands": _of(f"SELECT token, standard, count(*) OVER (PARTITION BY token) AS standards, {_ratio('a', 'sum(a) OVER (PARTITION BY token)')} AS share FROM (SELECT token, brand AS standard, sum(amt) AS a FROM (SELECT DISTINCT item, {_parts('raw_brand', True)} AS token, brand, amt FROM names) WHERE token <> '' GROUP BY token, brand) QUALIFY standards > 1", _NAMES),
    "H5_swallowed_families": _recursive(f"""SELECT raw_brand, brand, rows, amt FROM (SELECT raw_brand, brand, count(*) AS rows, {_sum('amt')} AS amt FROM names GROUP BY ALL) n
WHERE NOT EXISTS (SELECT 1 FROM part p LEFT JOIN fam f ON f.token = p.token, std s LEFT JOIN fam g ON g.token = s.token WHERE p.raw_brand = n.raw_brand AND s.brand = n.brand
  AND (p.token = s.token OR f.family = g.family OR length(p.token) >= 4 AND levenshtein(p.token, s.token) <= 1))""", _FAMILIES),
    "H6_split_families": _recursive(f"""SELECT family, standard, count(*) OVER (PARTITION BY family) AS standards, {_ratio('a', 'sum(a) OVER (PARTITION BY family)')} AS share FROM (
  SELECT family, brand AS standard, sum(amt) AS a FROM (SELECT raw_brand, brand, sum(amt) AS amt FROM names GROUP BY ALL) n
  JOIN (SELECT DISTINCT raw_brand, coalesce(family, token) AS family FROM part LEFT JOIN fam USING (token)) USING (raw_brand) GROUP BY ALL) QUALIFY count(*) OVER (PARTITION BY family) > 1""", _FAMILIES),
    "H7_non_brand": _of(f"SELECT trim(name) AS name, kind, count(*) AS rows, {_sum('amt')} AS amt FROM (SELECT *, CASE WHEN trim(name) = '' THEN 'blank' WHEN regexp_full_match(name, '[0-9]+') THEN 'digits' WHEN name IN ('red', 'blue', 'new') THEN 'word' END AS kind FROM (SELECT item, CASE WHEN item % 13 = 0 THEN '  ' WHEN item % 17 = 0 THEN CAST(item AS VARCHAR) ELSE raw_brand END AS name, sum(amt) AS amt FROM w GROUP BY item, raw_brand)) WHERE kind IS NOT NULL GROUP BY 1, 2"),
    "H8_others_yoy": _of(f"SELECT n.month, n.l1, {_r('n.s')} AS share, {_r('y.s')} AS last_year, {_r('n.s - y.s')} AS change FROM sh n LEFT JOIN sh y ON y.l1 = n.l1 AND y.month = CAST(n.month - INTERVAL '12' MONTH AS DATE)", _PREV, "sh AS (SELECT month, l1, CAST(coalesce(sum(amt) FILTER (WHERE brand = 'OTHERS'), 0) AS DOUBLE) / CAST(sum(amt) AS DOUBLE) AS s FROM prev GROUP BY month, l1)"),
    "H9_leaf_top_brands": _of(f"SELECT n.l2, n.brand, n.rank, b.rank AS base_rank, {_ratio('n.a', 't.a')} AS share FROM ({_RANKED.format(_M)}) n JOIN (SELECT l2, sum(amt) AS a FROM w WHERE month = {_M} GROUP BY l2) t ON n.l2 = t.l2 LEFT JOIN ({_RANKED.format(_B)}) b ON b.l2 = n.l2 AND b.brand = n.brand WHERE n.rank <= 5"),
    "I1_tree_totals": _of(" UNION ALL ".join(f"SELECT {x} AS node, {n} AS depth, count(DISTINCT item) AS items, {_sum('qty')} AS qty, {_sum('amt')} AS amt FROM w GROUP BY {x}" for x, n in (("CAST(root AS VARCHAR)", 1), ("concat(root, '/', node)", 2)))),
    "I2_tree_diff": _of("SELECT node, state, parent, base_parent FROM (SELECT node, c.root AS parent, p.root AS base_parent, CASE WHEN p.root IS NULL THEN 'new' WHEN c.root IS NULL THEN 'gone' WHEN c.root <> p.root THEN 'moved' END AS state FROM (SELECT DISTINCT node, root FROM cur WHERE node <> 7) c FULL JOIN (SELECT DISTINCT node, root FROM prev WHERE node <> 12) p USING (node)) WHERE state IS NOT NULL", *_BOTH),
    "I3_leaf_mix": _of(_LEAF_MIX),
    "I4_rare_roots": _of(f"SELECT * FROM ({_LEAF_MIX}) WHERE share < 0.05"),
    "I5_leaf_misplaced": _of(f"SELECT l2, count(*) AS nodes, {_sum('a')} AS amt, {_ratio('sum(a)', 'max(t)')} AS share FROM (SELECT l2, root, sum(amt) AS a FROM w GROUP BY l2, root) x JOIN (SELECT l2, sum(amt) AS t FROM w GROUP BY l2) USING (l2) WHERE NOT EXISTS (SELECT 1 FROM mix m WHERE m.l2 = x.l2 AND m.root = x.root AND m.share >= 0.1) GROUP BY l2", f"mix AS ({_LEAF_MIX})"),
    "J1_label_sample": _of("""SELECT l2, item, string_agg(reason, ',' ORDER BY reason) AS reason FROM (
  SELECT l2, item, 'random' AS reason FROM (SELECT *, row_number() OVER (PARTITION BY l2 ORDER BY md5('1|' || CAST(item AS VARCHAR)), item) AS r FROM p) WHERE r <= 5
  UNION ALL SELECT l2, item, 'top' FROM (SELECT *, row_number() OVER (PARTITION BY l2 ORDER BY a DESC, item) AS r FROM p) WHERE r <= 3
  UNION ALL SELECT l2, item, 'costly' FROM p JOIN (SELECT l2, quantile_cont(price, 0.95) AS cut FROM p GROUP BY l2) USING (l2) WHERE price >= cut) GROUP BY l2, item""", "p AS (SELECT l2, item, sum(amt) AS a, CAST(sum(amt) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) AS price FROM w GROUP BY l2, item HAVING sum(qty) <> 0)"),
    "J2_verdicts": f"WITH {_JUDGED} SELECT item, CASE WHEN v IN ('match', 'mismatch') THEN v ELSE 'undecided' END AS verdict FROM (SELECT item % 200 AS item, arg_max(verdict, item) AS v FROM judged GROUP BY item % 200)",
    "J3_leaf_mismatch": f"WITH {_JUDGED} SELECT lang, source, count(*) AS judged, count(*) FILTER (WHERE verdict = 'mismatch') AS mismatched, {_ratio(chr(99) + 'ount(*) FILTER (WHERE verdict = ' + chr(39) + 'mismatch' + chr(39) + ')', 'count(*)')} AS rate, {_ratio('coalesce(sum(amt) FILTER (WHERE verdict = ' + chr(39) + 'mismatch' + chr(39) + '), 0)', 'sum(amt)')} AS amt_rate FROM judged WHERE verdict <> 'unsure' GROUP BY lang, source",
    "J4_clustered": f"""WITH {_JUDGED}, g AS (
  SELECT lang, count(*) AS judged, count(*) FILTER (WHERE verdict = 'mismatch') AS mismatched, {_sum('amt')} AS judged_amt, CAST(coalesce(sum(amt) FILTER (WHERE verdict = 'mismatch'), 0) AS DOUBLE) AS found_amt,
         CAST(count(*) FILTER (WHERE verdict = 'mismatch' AND reason = 'random') AS DOUBLE) / nullif(count(*) FILTER (WHERE reason = 'random'), 0) AS rr
  FROM judged WHERE verdict <> 'unsure' GROUP BY lang)
SELECT lang, judged, mismatched, found_amt, {_r('rr')} AS random_rate, {_r('rr * (t - judged_amt) + found_amt', 4)} AS wrong_amt
FROM g JOIN (SELECT lang, CAST(sum(n_chars) AS DOUBLE) AS t FROM documents GROUP BY lang) USING (lang) WHERE mismatched >= 2 AND mismatched >= 0.1 * judged""",
    "J5_unknown_labels": _of(f"SELECT l2, count(*) AS rows, {_sum('amt')} AS amt FROM (SELECT month, country, platform, item, l2, brand, sum(amt) AS amt FROM prev GROUP BY ALL) p WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.l2 = p.l2) GROUP BY l2", *_BOTH),
    "J6_tag_fill": f"SELECT event_type, tag, filled, {_ratio('filled', 'n')} AS share FROM (SELECT event_type, tag, count(*) AS filled FROM (SELECT event_type, props, unnest(json_keys(props)) AS tag FROM events) WHERE json_extract_string(props, '$.' || tag) <> '' GROUP BY event_type, tag) JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) USING (event_type)",
    "J7_label_churn": _of(f"SELECT was AS label_from, l2 AS label_to, count(*) AS items, {_sum('a')} AS amt FROM (SELECT item, l2, sum(amt) AS a FROM cur GROUP BY item, l2) JOIN (SELECT DISTINCT item, l2 AS was FROM prev) USING (item) WHERE l2 <> was GROUP BY was, l2", *_BOTH),
    "K1_own_compare": _of(f"SELECT country, count(*) FILTER (WHERE e IS NOT NULL AND t IS NOT NULL) AS matched, count(*) FILTER (WHERE t IS NULL) AS only_estimate, count(*) FILTER (WHERE e IS NULL) AS only_truth, {_r('quantile_cont(x, 0.5)')} AS p50, {_r('quantile_cont(x, 0.9)')} AS p90 FROM (SELECT country, e, t, CASE WHEN t <> 0 THEN abs(CAST(e AS DOUBLE) / CAST(t AS DOUBLE) - 1) END AS x FROM (SELECT country, sum(CASE WHEN item % 13 <> 0 THEN amt END) AS e, sum(CASE WHEN item % 19 <> 0 THEN qty * list_price END) AS t FROM w WHERE brand = 'Brand#4' GROUP BY month, country, platform, item) WHERE e IS NOT NULL OR t IS NOT NULL) GROUP BY country"),
    "K2_carry_over": _of("""SELECT f.item, 'l2' AS field, f.wanted, CASE WHEN p.item IS NULL THEN 'not applicable' WHEN p.l2 <> f.wanted THEN 'lost' ELSE 'kept' END AS state, CAST(p.a AS DOUBLE) AS amt
FROM (SELECT DISTINCT item, CASE WHEN item % 20 = 0 THEN l2 ELSE concat(l2, '/fixed') END AS wanted FROM w WHERE item % 10 = 0) f LEFT JOIN (SELECT item, l2, sum(amt) AS a FROM w WHERE item % 30 <> 0 GROUP BY item, l2) p USING (item)"""),
    "K3_release_compare": _of(f"SELECT l1, country, platform, {_d('c.v')} AS cur_amt, {_d('p.v')} AS release_amt, {_ratio('c.v', 'p.v')} AS ratio FROM (SELECT l1, country, platform, sum(amt) AS v FROM cur GROUP BY ALL) c FULL JOIN (SELECT l1, country, platform, sum(amt) AS v FROM prev GROUP BY ALL) p USING (l1, country, platform)", *_BOTH),
    "K4_recheck": _of("SELECT * FROM recheck", _DEFECTS, _RECHECK),
    "K5_promises": _of(f"SELECT id, promised_by, CASE WHEN promised_by > {_M} THEN 'not due' WHEN state = 'fixed' THEN 'kept' ELSE 'broken' END AS promise FROM (VALUES (1, DATE '2001-05-01'), (2, DATE '2001-08-01'), (3, DATE '2001-06-01'), (4, DATE '2001-04-01')) v(id, promised_by) LEFT JOIN recheck USING (id)", _DEFECTS, _RECHECK),
    "K6_item_recon": _of(f"SELECT country, platform, item, CASE WHEN p IS NULL THEN 'new' WHEN c IS NULL THEN 'resolved' ELSE 'open' END AS state FROM (SELECT DISTINCT country, platform, item, 1 AS c FROM jump WHERE month = {_M}) FULL JOIN (SELECT DISTINCT country, platform, item, 1 AS p FROM jump WHERE month = {_B}) USING (country, platform, item)", _jump(1.8)),
    "K7_downgrade": _of("SELECT j.*, CASE WHEN EXISTS (SELECT 1 FROM told d WHERE j.month BETWEEN d.f AND d.t AND (d.country IS NULL OR d.country = j.country) AND (d.platform IS NULL OR d.platform = j.platform)) THEN 'explained' ELSE 'open' END AS state FROM jump j", _jump(1.8), _TOLD),
    "K8_flag_history": _of(f"SELECT item, coalesce(n, 0) AS times, first_month, last_month FROM (SELECT DISTINCT item FROM jump WHERE month = {_M}) LEFT JOIN (SELECT item, count(*) AS n, min(month) AS first_month, max(month) AS last_month FROM jump WHERE month < {_M} GROUP BY item) USING (item)", _jump(1.8)),
    "M1_screen": _of("SELECT module, key, metric, value, rule, severity FROM flagged", *_BOTH, _S, _FLAGGED),
    "M2_digest": _of(f"SELECT * FROM (SELECT module, count(*) OVER (PARTITION BY module) AS flags, CAST(sum(amt) OVER (PARTITION BY module) AS DOUBLE) AS module_amt, row_number() OVER (PARTITION BY module ORDER BY amt DESC, key, metric) AS rank, key, metric, {_d('amt')} AS amt FROM flagged JOIN (SELECT json_object('month', CAST(month AS VARCHAR), 'country', country, 'platform', platform)::VARCHAR AS key, sum(amt) AS amt FROM w GROUP BY 1) USING (key)) WHERE rank <= 5", *_BOTH, _S, _FLAGGED),
    "M3_impact": _of(f"SELECT count(*) FILTER (WHERE hit) AS rows, CAST(coalesce(sum(amt) FILTER (WHERE hit), 0) AS DOUBLE) AS touched, {_ratio('coalesce(sum(amt) FILTER (WHERE hit), 0)', 'sum(amt)')} AS share FROM (SELECT amt, EXISTS (SELECT 1 FROM jump j WHERE j.month = b.month AND j.country = b.country AND j.platform = b.platform AND j.item = b.item) AS hit FROM (SELECT month, country, platform, item, sum(amt) AS amt FROM w GROUP BY ALL) b)", _jump(1.8)),
    "M3_impact_of_grains": _of(f"SELECT country, platform, count(*) FILTER (WHERE h1 OR h2 OR h3) AS rows, CAST(coalesce(sum(amt) FILTER (WHERE h1 OR h2 OR h3), 0) AS DOUBLE) AS touched, {_ratio('coalesce(sum(amt) FILTER (WHERE h1 OR h2 OR h3), 0)', 'sum(amt)')} AS share FROM hit GROUP BY country, platform", _S, _jump(1.8), _GRAINED),
    "M3_module_impact": _of(" UNION ALL ".join(f"SELECT '{m}' AS module, country, platform, count(*) AS rows, {_sum('amt')} AS amt FROM hit WHERE {h} GROUP BY country, platform" for m, h in (("level", "h1"), ("tree", "h2"), ("price", "h3"))), _S, _jump(1.8), _GRAINED),
    "M4_drill_flags": _of(f"""SELECT {_KEY} AS key, rank, item, {_d('a0')} AS base_amt, {_d('a1')} AS amt, {_d('d')} AS change FROM (
  SELECT *, coalesce(a1, 0) - coalesce(a0, 0) AS d, row_number() OVER (PARTITION BY month, country, platform ORDER BY abs(coalesce(a1, 0) - coalesce(a0, 0)) DESC, item) AS rank FROM (
    SELECT month, country, platform, item, sum(a0) AS a0, sum(a1) AS a1 FROM (
      SELECT g.*, item, v AS a1, NULL AS a0 FROM g JOIN s USING (month, country, platform)
      UNION ALL SELECT g.*, item, NULL, v FROM g JOIN s ON s.month = CAST(g.month - INTERVAL '1' MONTH AS DATE) AND s.country = g.country AND s.platform = g.platform
    ) GROUP BY ALL)) WHERE rank <= 5""",
        *_BOTH, _S.replace("s AS", "t AS", 1), f"chg AS ({_CHANGE.replace('FROM s n', 'FROM t n').replace('JOIN s ', 'JOIN t ')})", f"rst AS ({_RESTATED})", """g AS (
  SELECT DISTINCT month, country, platform FROM chg WHERE change_1 < -0.9 OR change_1 > 2.0 OR change_12 < -0.9 OR change_12 > 3.0
  UNION SELECT month, country, platform FROM rst WHERE ratio < 0.95 OR ratio > 1.05
), s AS (SELECT month, country, platform, item, sum(amt) AS v FROM w GROUP BY ALL)"""),
    "M4_drill": _of(f"SELECT item, {_d('a0')} AS base_amt, {_d('a1')} AS amt, {_d('coalesce(a1, 0) - coalesce(a0, 0)')} AS change FROM (SELECT item, sum(amt) AS a1 FROM w WHERE month = {_M} AND country = 'ASIA' AND platform = 'BUILDING' GROUP BY item) FULL JOIN (SELECT item, sum(amt) AS a0 FROM w WHERE month = {_B} AND country = 'ASIA' AND platform = 'BUILDING' GROUP BY item) USING (item) ORDER BY abs(coalesce(a1, 0) - coalesce(a0, 0)) DESC, item LIMIT 20"),
    "M5_recompute_view": "SELECT side, (SELECT count(*) FROM region WHERE r_name IS NULL) AS rows FROM (VALUES ('landed'), ('recomputed')) v(side)",
    "M5_recompute": f"SELECT side, (SELECT count(DISTINCT date_trunc('month', l_shipdate)) FROM lineitem WHERE CAST(date_trunc('month', l_shipdate) AS DATE) = {_M}) AS rows FROM (VALUES ('landed'), ('recomputed')) v(side)",
    "M6_acceptance": _of(f"""SELECT m.module, t.country, t.platform, CASE WHEN o > 0 THEN 'fail' WHEN n > 0 THEN 'explained' ELSE 'pass' END AS status, coalesce(n, 0) AS flags, {_ratio('coalesce(a, 0)', 't.v')} AS share
FROM (SELECT DISTINCT module FROM fl) m CROSS JOIN (SELECT country, platform, sum(amt) AS v FROM w GROUP BY country, platform) t
LEFT JOIN (SELECT module, country, platform, count(*) AS n, count(*) FILTER (WHERE state = 'open') AS o, sum(amt) AS a FROM fl GROUP BY ALL) g ON g.module = m.module AND g.country = t.country AND g.platform = t.platform""",
        _jump(1.8), _BREAK, """fl AS (SELECT 'price' AS module, country, platform, CASE WHEN country = 'ASIA' AND month BETWEEN DATE '2001-01-01' AND DATE '2001-12-01' THEN 'explained' ELSE 'open' END AS state, CAST(amt AS DECIMAL(24,4)) AS amt FROM jump
  UNION ALL SELECT 'level', country, platform, 'open', CAST(value AS DECIMAL(24,4)) FROM brk WHERE mad > 0 AND abs(value - median) > 3.0 * mad)"""),
}
