"""The catalogue's queries as SQL over the same tables, written independently."""

from __future__ import annotations

LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
ROW_TEXT = "l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber"
FACT_TEXT = '"order" || \'|\' || item || \'|\' || supplier || \'|\' || line'


def _hash(purpose: str, key: str) -> str:
    return f"('0x' || substr(md5('{purpose}|42|' || {key}), 1, 8))::BIGINT"


FACTS = f"""facts AS (
  SELECT o_custkey AS "user", l_partkey AS item, l_quantity AS rating,
         l_orderkey AS "order", l_suppkey AS supplier, l_linenumber AS line
  FROM {LINES})"""
ALIASES = """first_of AS (SELECT p_brand, p_type, min(p_partkey) AS f FROM part GROUP BY ALL),
brand_first AS (SELECT p_brand, min(p_partkey) AS bf FROM part GROUP BY ALL),
one_alias AS (
  SELECT p_partkey AS bad_id, CASE WHEN p_partkey = f THEN bf ELSE f END AS good_id, p_size
  FROM part JOIN first_of USING (p_brand, p_type) JOIN brand_first USING (p_brand) WHERE p_size % 5 <> 0),
aliases AS (SELECT * FROM one_alias UNION ALL SELECT bad_id, 0, p_size FROM one_alias WHERE p_size = 7)"""
ACTIVE = f"""{FACTS},
active AS (SELECT "user" FROM facts GROUP BY "user" HAVING count(DISTINCT item) >= 40),
act AS (SELECT * FROM facts WHERE "user" IN (SELECT "user" FROM active))"""
SPLIT = f"""{ACTIVE},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY "user"
             ORDER BY md5('user-split|42|' || {FACT_TEXT}), "order", item, supplier, line) AS rn,
         count(*) OVER (PARTITION BY "user") AS cnt
  FROM act),
split AS (
  SELECT "user", item, rating, "order", supplier, line,
         CASE WHEN rn <= greatest(1, floor(cnt * 0.8::DOUBLE)) THEN 'train' ELSE 'test' END AS split
  FROM numbered)"""
TOTALS = "totals AS (SELECT item, sum(rating) AS total FROM facts GROUP BY item)"
TOP = f"""{TOTALS},
top AS (SELECT item, total, row_number() OVER (ORDER BY total DESC, item)::INTEGER AS rank
        FROM totals ORDER BY total DESC, item LIMIT 50)"""
LISTS = f"""{SPLIT}, {TOP},
held AS (SELECT DISTINCT "user", item FROM split WHERE split = 'test'),
lists AS (
  SELECT u."user", top.item, top.total AS score, top.rank
  FROM (SELECT DISTINCT "user" FROM held) u, top),
labelled AS (
  SELECT lists.*, CASE WHEN held.item IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label
  FROM lists LEFT JOIN held ON held."user" = lists."user" AND held.item = lists.item)"""


def _walk(part: str, order: str) -> str:
    """Hits and the hit count at the previous miss for every miss of a ranking."""
    over = f"OVER ({part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""walk AS (SELECT *, sum(label) {over} AS tp FROM labelled),
misses AS (
  SELECT *, coalesce(lag(tp) OVER ({part} ORDER BY {order}), 0) AS tp0 FROM walk WHERE label = 0)"""


USER_WALK = _walk('PARTITION BY "user"', "score DESC, item")
POOL_WALK = _walk("", 'score DESC, "user", item')
PER_USER = f"""{LISTS}, {USER_WALK},
size_of AS (SELECT "user", sum(label) AS p, sum(1 - label) AS n FROM labelled GROUP BY "user"),
per_user AS (
  SELECT s."user", p::BIGINT AS hits, n::BIGINT AS misses,
         CASE WHEN p > 0 AND n > 0 THEN a.stepwise / (p * n) ELSE 0.5 END AS stepwise,
         CASE WHEN p > 0 AND n > 0 THEN a.exact / (p * n) ELSE 0.5 END AS exact
  FROM size_of s LEFT JOIN (
    SELECT "user", sum((tp + tp0) / 2) AS stepwise, sum(tp) AS exact FROM misses GROUP BY "user") a
  ON a."user" = s."user"),
held_n AS (SELECT "user", count(*) AS held_out FROM held GROUP BY "user"),
judged AS (
  SELECT per_user."user", hits, misses, stepwise, exact, held_out - hits AS unlisted,
         CASE WHEN hits + misses > 0 THEN hits::DOUBLE / (hits + misses) ELSE 0 END AS prec,
         CASE WHEN held_out > 0 THEN hits::DOUBLE / held_out ELSE 0 END AS rec,
         CASE WHEN misses + held_out > 0 THEN hits::DOUBLE / (misses + held_out) ELSE 0 END AS jac
  FROM per_user JOIN held_n USING ("user"))"""
POOLED = f"""WITH {LISTS}, {POOL_WALK}
SELECT (SELECT sum(label)::BIGINT FROM labelled) AS hits, count(*) AS misses,
       round(sum((tp + tp0) / 2) / ((SELECT sum(label) FROM labelled) * count(*)), 9) AS stepwise,
       round(sum(tp) / ((SELECT sum(label) FROM labelled) * count(*)), 9) AS exact
FROM misses"""

ANSWER = f"CASE WHEN l_quantity + {_hash('noise', ROW_TEXT)} % 30 > 45 THEN 1 ELSE 0 END"
JUDGED = f"""judged AS (
  SELECT {ANSWER} AS y, CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END AS p,
         l_quantity AS coarse, l_extendedprice AS fine FROM lineitem)"""
CONFUSION = f"""{JUDGED},
c AS (SELECT count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 0) AS tn,
             count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn
      FROM judged)"""
CLASSES = f"""classes AS (
  SELECT least(12, floor((l_quantity + {_hash('noise13', ROW_TEXT)} % 12) / 4))::DOUBLE AS label,
         least(13, floor((l_quantity + 6) / 4))::DOUBLE AS prediction FROM lineitem)"""


def _curve(score: str) -> str:
    return f"""WITH {JUDGED},
points AS (SELECT {score} AS s, sum(y) AS pos, sum(1 - y) AS neg FROM judged GROUP BY {score}),
curve AS (
  SELECT *, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM points),
steps AS (
  SELECT *, tp::DOUBLE / (tp + fp) AS pr, lag(tp, 1, 0) OVER w AS tp0, lag(fp, 1, 0) OVER w AS fp0,
         lag(tp::DOUBLE / (tp + fp)) OVER w AS pr0
  FROM curve WINDOW w AS (ORDER BY s DESC))
SELECT round(sum((fp - fp0)::DOUBLE * (tp + tp0) / 2) / (sum(pos)::DOUBLE * sum(neg)), 8) AS roc_auc,
       round(sum((tp - tp0)::DOUBLE * (pr + coalesce(pr0, pr)) / 2) / sum(pos), 8) AS pr_auc,
       sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg
FROM steps"""


def _index(column: str) -> str:
    """Frequency rank of the small parts' values; others get the next index."""
    return f"""(SELECT {column} AS v, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i
   FROM part WHERE p_size <= 4 AND p_brand <> 'Brand#11' AND p_type <> 'PROMO' GROUP BY {column})"""


def _shape(table: str, columns: int) -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, {columns}::INTEGER AS n_columns FROM {table}"


def _correlations(*names: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(corr({n}, l_extendedprice), 6) AS correlation FROM lineitem"
        for n in names
    )


def _categories(feature: str, value: str) -> str:
    """Detected categories: 0.0 first, the others in order; many values stay as they are."""
    return f"""SELECT '{feature}' AS feature, v AS value, n,
  CASE WHEN count(*) OVER () > 20 THEN v
       ELSE (row_number() OVER (ORDER BY v <> 0, v) - 1)::DOUBLE END AS output
FROM (SELECT ({value})::DOUBLE AS v, count(*) AS n FROM lineitem GROUP BY 1)"""


def _best_split(target: str, cost: str) -> str:
    """All splits between neighbouring values of four columns, the cheapest first."""
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS f, {c}::DOUBLE AS v, count(*) AS n, sum(t) AS s FROM r GROUP BY {c}"
        for c in ("l_linenumber", "l_quantity", "l_discount", "l_tax")
    )
    return f"""WITH r AS (SELECT {target} AS t, * FROM lineitem),
vals AS ({values}),
cum AS (
  SELECT f, v, sum(n) OVER (PARTITION BY f ORDER BY v) AS nl, sum(s) OVER (PARTITION BY f ORDER BY v) AS sl,
         sum(n) OVER (PARTITION BY f) AS nt, sum(s) OVER (PARTITION BY f) AS st
  FROM vals),
best AS (
  SELECT nl, sl, nt - nl AS nr, st - sl AS sr FROM cum WHERE nl < nt
  ORDER BY {cost.format(n="nl", s="sl")} + {cost.format(n="(nt - nl)", s="(st - sl)")} LIMIT 1),
leaves AS (SELECT nl AS n, sl / nl AS m FROM best UNION ALL SELECT nr, sr / nr FROM best)"""


SIX = "l_orderkey, l_partkey, l_suppkey, l_linenumber"

ORACLES: dict[str, str] = {
    "parse_fixed_width": f"""
SELECT year(o_orderdate)::DOUBLE AS year, month(o_orderdate)::DOUBLE AS month,
  day(o_orderdate)::DOUBLE AS day, ((l_linenumber * 3) % 24)::DOUBLE AS hour,
  (l_partkey % 180001 - 90000)::DOUBLE / 1000 AS latitude,
  (l_suppkey % 360001 - 180000)::DOUBLE / 1000 AS longitude,
  (o_custkey % 1000 - 100)::DOUBLE AS "elevationDimension",
  (o_custkey % 360)::DOUBLE AS "directionAngle", (l_quantity * 7) / 10 AS "speedRate",
  (floor(l_extendedprice)::BIGINT % 22001)::DOUBLE AS "ceilingHeightDimension",
  floor(l_extendedprice) AS "distanceDimension",
  (l_linenumber * 10 - 35)::DOUBLE / 10 AS "dewPointTemperature",
  (l_quantity * 4 - 12 * abs(month(o_orderdate) - 7) + o_custkey % 10)::DOUBLE / 10 AS "airTemperature"
FROM {LINES} WHERE l_discount <> 0 AND l_quantity <> 50 AND l_tax <> 0.08""",
    "fixed_width_rejects": f"""
SELECT CASE WHEN l_tax = 0.08 THEN 'short' ELSE 'bad year' END AS reason, count(*) AS n
FROM {LINES} WHERE l_discount <> 0 AND (l_tax = 0.08 OR l_quantity = 50) GROUP BY 1""",
    "parse_dimension_lenient": """
SELECT p_partkey::INTEGER AS item,
  CASE p_size WHEN 3 THEN '' WHEN 4 THEN p_name || chr(9) || p_brand ELSE p_name END AS name
FROM part WHERE p_size > 2""",
    "dimension_rejects": """
SELECT CASE p_size WHEN 1 THEN p_partkey || ' ' || p_name ELSE 'x' || p_partkey || chr(9) || p_name END AS value,
  CASE p_size WHEN 1 THEN 'no tab' ELSE 'bad id' END AS reason
FROM part WHERE p_size <= 2""",
    "parse_alias": f"""
WITH {ALIASES} SELECT bad_id::INTEGER AS bad_id, good_id::INTEGER AS good_id FROM aliases WHERE p_size > 2""",
    "parse_facts": f"""
SELECT o_custkey::INTEGER AS "user", l_partkey::INTEGER AS item, l_quantity AS rating
FROM {LINES} WHERE l_tax <> 0.08 AND l_quantity <> 50""",
    "fact_rejects": f"""
SELECT CASE WHEN l_tax = 0.08 THEN 'not three tokens' ELSE 'bad count' END AS reason, count(*) AS n
FROM {LINES} WHERE l_tax = 0.08 OR l_quantity = 50 GROUP BY 1""",
    "survey_csv": f"""
SELECT CASE WHEN l_quantity + {_hash('noise', ROW_TEXT)} % 30 > 45 THEN 'Yes' ELSE 'No' END AS "HeartDisease",
  l_returnflag AS "Smoking", l_linestatus AS "AgeCategory", CASE WHEN l_quantity > 25 THEN 'a, "b"' ELSE 'c' END AS "Race",
  'No' AS "Asthma", count(*) AS n, sum(l_quantity) AS bmi, count(*) FILTER (l_tax <> 0.08) AS n_mental, round(sum(l_tax), 4) AS sleep
FROM lineitem GROUP BY ALL""",
    "load_shape": " UNION ALL ".join(
        _shape(t, n)
        for t, n in (("customer", 5), ("events", 6), ("lineitem", 11), ("orders", 6), ("part", 6), ("supplier", 4))
    ),
    "alias_resolve": f"""
WITH {FACTS}, {ALIASES}
SELECT "user", coalesce(good_id, item) AS item, rating, "order", supplier, line, item AS raw_item
FROM facts LEFT JOIN one_alias ON bad_id = item""",
    "alias_merge": f"""
WITH {FACTS}, {ALIASES}
SELECT "user", coalesce(good_id, item) AS item, sum(rating) AS rating
FROM facts LEFT JOIN one_alias ON bad_id = item GROUP BY ALL""",
    "name_lookup_default": f"""
WITH {FACTS}, {TOTALS}
SELECT item, total, CASE WHEN p_size > 10 THEN p_name ELSE 'Unknown(' || item || ')' END AS name
FROM totals JOIN part ON p_partkey = item""",
    "active_users": f"""
WITH {FACTS} SELECT "user", count(DISTINCT item) AS n_items, count(*) AS n_rows
FROM facts GROUP BY "user" HAVING n_items >= 40""",
    "active_facts": f"WITH {ACTIVE} SELECT * FROM act",
    "user_item_sets": f"""
WITH {FACTS}
SELECT "user", item // 1024 AS chunk, string_agg(item::VARCHAR, ',' ORDER BY item) AS items
FROM (SELECT DISTINCT "user", item FROM facts) GROUP BY 1, 2""",
    "item_popularity": f"WITH {FACTS}, {TOTALS} SELECT * FROM totals",
    "top_n_popular": f"WITH {FACTS}, {TOP} SELECT * FROM top",
    "top_n_report": f"""
WITH {FACTS}, {TOP}
SELECT rank, printf('%2d. %s (item=%d, score=%.4f)', rank,
  CASE WHEN p_size > 10 THEN p_name ELSE 'Unknown(' || item || ')' END, item, total) AS line
FROM top JOIN part ON p_partkey = item""",
    "exclude_rated": f"""
WITH {FACTS}, {TOP}
SELECT u."user", item, total AS score, rank FROM (SELECT DISTINCT "user" FROM facts) u, top
WHERE NOT EXISTS (SELECT 1 FROM facts f WHERE f."user" = u."user" AND f.item = top.item)""",
    "distinct_ids": f"""
WITH {FACTS}
SELECT (SELECT count(*) FROM (SELECT DISTINCT "user", item FROM facts)) AS n_pairs,
  count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items FROM facts""",
    "max_user": "SELECT max(o_custkey) + 1 AS \"user\" FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)",
    "sample_ids": """
SELECT item, row_number() OVER (ORDER BY md5('sample|42|' || item), item)::INTEGER AS position
FROM (SELECT DISTINCT l_partkey AS item FROM lineitem) QUALIFY position <= 8""",
    "synthetic_user": f"""
WITH {FACTS}
SELECT (SELECT max("user") + 1 FROM facts) AS "user", item,
  (5300 - 300 * row_number() OVER (ORDER BY md5('sample|42|' || item), item))::DOUBLE AS rating
FROM (SELECT DISTINCT item FROM facts) QUALIFY rating > 2600""",
    "union_new_user": f"""
WITH {SPLIT}
SELECT "user", item, rating FROM split WHERE split = 'train'
UNION ALL
SELECT * FROM (
  SELECT (SELECT max("user") + 1 FROM facts), item,
    (5300 - 300 * row_number() OVER (ORDER BY md5('sample|42|' || item), item))::DOUBLE AS r
  FROM (SELECT DISTINCT item FROM facts) QUALIFY r > 2600)""",
    "hash_split": f"""
SELECT {SIX}, CASE WHEN {_hash('split', ROW_TEXT)} % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM lineitem""",
    "temporal_holdout": """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS year,
  CASE year(o_orderdate) WHEN 2001 THEN 'test' WHEN 2000 THEN 'valid' ELSE 'train' END AS split
FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001""",
    "per_user_split": f"WITH {SPLIT} SELECT * FROM split",
    "kfold_assign": f"SELECT {SIX}, ({_hash('fold', ROW_TEXT)} % 5)::INTEGER AS fold FROM lineitem",
    "cyclical_encoding": f"""
SELECT {SIX}, month(o_orderdate)::INTEGER AS month, ((l_linenumber * 3) % 24)::INTEGER AS hour,
  round(sin(month(o_orderdate) * pi() / 6), 9) + 0.0 AS month_sin,
  round(cos(month(o_orderdate) * pi() / 6), 9) + 0.0 AS month_cos,
  round(sin(((l_linenumber * 3) % 24) * pi() / 12), 9) + 0.0 AS hour_sin,
  round(cos(((l_linenumber * 3) % 24) * pi() / 12), 9) + 0.0 AS hour_cos
FROM {LINES}""",
    "string_index_keep": f"""
SELECT p_partkey, coalesce(b.i, (SELECT count(*) FROM {_index('p_brand')}))::DOUBLE AS p_brand_idx,
  coalesce(t.i, (SELECT count(*) FROM {_index('p_type')}))::DOUBLE AS p_type_idx
FROM part LEFT JOIN {_index('p_brand')} b ON b.v = p_brand LEFT JOIN {_index('p_type')} t ON t.v = p_type""",
    "string_index_label": """
SELECT (row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1)::INTEGER AS index,
  o_orderpriority AS priority, count(*) AS n
FROM orders GROUP BY o_orderpriority""",
    "assemble_vector": f"""
SELECT {SIX}, l_quantity AS v0, l_discount AS v1, CASE WHEN l_tax > 0 THEN l_tax ELSE -1 END AS v2
FROM lineitem""",
    "category_detect": " UNION ALL ".join(
        f"SELECT * FROM ({_categories(f, v)})"
        for f, v in (("line", "l_linenumber - 4"), ("quantity", "l_quantity"), ("discount", "l_discount"), ("tax", "l_tax"))
    ),
    "standardize": f"""
WITH s AS (
  SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs, avg(l_discount) AS dm,
         stddev_samp(l_discount) AS ds, avg(l_tax) AS tm, stddev_samp(l_tax) AS ts FROM lineitem)
SELECT {SIX}, round((l_quantity - qm) / qs, 6) AS z_l_quantity,
  round((l_discount - dm) / ds, 6) AS z_l_discount, round((l_tax - tm) / ts, 6) AS z_l_tax,
  0.0::DOUBLE AS z_fixed
FROM lineitem, s""",
    "binary_confusion": f"WITH {CONFUSION} SELECT tp, tn, fp, fn FROM c",
    "binary_rates": f"""
WITH {CONFUSION}
SELECT tp, tn, fp, fn, round(tp::DOUBLE / (tp + fp), 9) AS precision, round(tp::DOUBLE / (tp + fn), 9) AS recall,
  round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 9) AS accuracy,
  round((tp::DOUBLE / (tp + fn) + tn::DOUBLE / (tn + fp)) / 2, 9) AS class_accuracy
FROM c""",
    "binary_rates_zero": f"""
WITH {CONFUSION}
SELECT 0::BIGINT AS tp, tn + fp AS tn, 0::BIGINT AS fp, fn + tp AS fn, 0.0::DOUBLE AS precision, 0.0::DOUBLE AS recall,
  round((tn + fp)::DOUBLE / (tp + tn + fp + fn), 9) AS accuracy, 0.5::DOUBLE AS class_accuracy
FROM c""",
    "binary_report": f"""
WITH rates AS (WITH {CONFUSION}
  SELECT tp::DOUBLE AS tp, tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn,
    round(tp::DOUBLE / (tp + fp), 8) AS precision, round(tp::DOUBLE / (tp + fn), 8) AS recall,
    round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 8) AS accuracy,
    round((tp::DOUBLE / (tp + fn) + tn::DOUBLE / (tn + fp)) / 2, 8) AS class_accuracy FROM c),
areas AS ({_curve("fine")})
SELECT metric, value FROM (UNPIVOT rates ON tp, tn, fp, fn, precision, recall, accuracy, class_accuracy INTO NAME metric VALUE value)
UNION ALL SELECT 'roc_auc', roc_auc FROM areas UNION ALL SELECT 'pr_auc', pr_auc FROM areas""",
    "als_list_check": f"""
WITH {SPLIT} SELECT DISTINCT "user", 50::BIGINT AS n_items, 50::BIGINT AS n_different, 50::BIGINT AS n_products
FROM split WHERE split = 'test'""",
    "new_user_check": f"""
WITH {FACTS} SELECT max("user") + 1 AS "user", 25::BIGINT AS n_items, 0::BIGINT AS n_rated FROM facts""",
    "binary_auc": _curve("fine"),
    "binary_auc_ties": _curve("coarse"),
    "multiclass_confusion": f"WITH {CLASSES} SELECT label, prediction, count(*) AS n FROM classes GROUP BY ALL",
    "multiclass_metrics": f"""
WITH {CLASSES},
names AS (SELECT label AS cls FROM classes UNION SELECT prediction FROM classes),
rates AS (
  SELECT cls, count(*) FILTER (label = cls) AS a, count(*) FILTER (prediction = cls) AS p,
         count(*) FILTER (label = cls AND prediction = cls) AS h
  FROM names, classes GROUP BY cls),
scored AS (
  SELECT a, h, CASE WHEN p > 0 THEN h::DOUBLE / p ELSE 0 END AS pr, CASE WHEN a > 0 THEN h::DOUBLE / a ELSE 0 END AS re
  FROM rates)
SELECT round(sum(h)::DOUBLE / sum(a), 9) AS accuracy,
  round(sum(CASE WHEN pr + re > 0 THEN a * 2 * pr * re / (pr + re) ELSE 0 END) / sum(a), 9) AS f1,
  round(sum(a * pr) / sum(a), 9) AS weighted_precision, round(sum(a * re) / sum(a), 9) AS weighted_recall,
  round(avg(re) FILTER (a > 0), 9) AS class_accuracy
FROM scored""",
    "regression_metrics": """
WITH e AS (SELECT l_extendedprice / 1000 AS y, l_extendedprice / 1000 - l_quantity * 2 AS r FROM lineitem),
m AS (SELECT avg(y) AS mean FROM e)
SELECT count(*) AS n, round(avg(r * r), 6) AS mse, round(sqrt(avg(r * r)), 6) AS rmse,
  round(avg(abs(r)), 6) AS mae, round(1 - sum(r * r) / sum((y - mean) * (y - mean)), 6) AS r2
FROM e, m""",
    "feature_correlation": _correlations("l_quantity", "l_discount", "l_tax", "l_linenumber"),
    "popular_lists": f"""
WITH {FACTS}, {TOP}
SELECT "user", item, total AS score, rank FROM (SELECT DISTINCT "user" FROM facts), top""",
    "label_lists": f"WITH {LISTS} SELECT * FROM labelled",
    "list_auc_stepwise": f'WITH {PER_USER} SELECT "user", hits, misses, round(stepwise, 9) AS stepwise FROM per_user',
    "list_auc_exact": f'WITH {PER_USER} SELECT "user", hits, misses, round(exact, 9) AS exact FROM per_user',
    "pooled_auc": POOLED,
    "rank_metrics_at_k": f"""
WITH {PER_USER}
SELECT "user", hits, misses, round(stepwise, 9) AS stepwise, round(exact, 9) AS exact, unlisted, round(prec, 9) AS precision,
  round(rec, 9) AS recall, round(jac, 9) AS jaccard FROM judged""",
    "popular_macro_metrics": f"""
WITH {PER_USER}
SELECT count(*) AS n_users, round(avg(stepwise), 8) AS stepwise, round(avg(exact), 8) AS exact, round(avg(prec), 8) AS precision,
  round(avg(rec), 8) AS recall, round(avg(jac), 8) AS jaccard
FROM judged WHERE hits > 0 AND misses > 0""",
    "popular_macro_auc": f"""
WITH {PER_USER}
SELECT count(*) AS n_users, round(avg(stepwise), 8) AS stepwise, round(avg(exact), 8) AS exact
FROM per_user WHERE hits > 0 AND misses > 0""",
    "tree_stump": _best_split(ANSWER, "{s} * ({n} - {s})::DOUBLE / {n}") + """
SELECT CASE WHEN m > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(m, 9) AS share, n::BIGINT AS n
FROM leaves""",
    "forest_stump": _best_split("l_extendedprice / 1000", "- {s} * {s} / {n}") + """
SELECT round(m, 6) AS prediction, n::BIGINT AS n FROM leaves""",
    "ols_holdout": f"""
WITH r AS (
  SELECT year(o_orderdate) AS yr, l_extendedprice / 1000 AS y, l_quantity AS a, l_discount AS b FROM {LINES}),
m AS (
  SELECT avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb,
         covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS byy
  FROM r WHERE yr BETWEEN 1995 AND 1999),
line AS (
  SELECT my, ma, mb, (ay * vb - byy * ab) / (va * vb - ab * ab) AS ka,
         (byy * va - ay * ab) / (va * vb - ab * ab) AS kb FROM m),
e AS (
  SELECT CASE yr WHEN 2000 THEN 'valid' ELSE 'test' END AS split, y,
         y - (my + ka * (a - ma) + kb * (b - mb)) AS d
  FROM r, line WHERE yr IN (2000, 2001))
SELECT split, count(*) AS n, round(avg(d * d), 6) AS mse, round(sqrt(avg(d * d)), 6) AS rmse,
  round(avg(abs(d)), 6) AS mae, round(1 - avg(d * d) / var_pop(y), 6) AS r2
FROM e GROUP BY split""",
    "ols_one_feature": """
SELECT round(regr_slope(l_extendedprice / 1000, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice / 1000, l_quantity), 4) AS intercept
FROM lineitem""",
}
JUDGED_FOLDS = f"""judged AS (
  SELECT l_quantity AS q, {ANSWER} AS y, {_hash('fold', ROW_TEXT)} % 5 AS fold
  FROM lineitem)"""
ORACLES |= {
    "category_levels": ORACLES["string_index_keep"],
    "tree_depth_points": ORACLES["tree_stump"],
    "binary_auc_points": " UNION ALL ".join(f"SELECT '{p}' AS point, * FROM ({_curve(p)})" for p in ("coarse", "fine")),
    "dense_ids": """
WITH ids AS (SELECT o_custkey * 10000000000 - 5 AS "user", o_orderpriority || '/' || o_custkey AS item FROM orders),
users AS (SELECT "user", row_number() OVER (ORDER BY "user") - 1 AS user_number FROM (SELECT DISTINCT "user" FROM ids)),
items AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS item_number FROM (SELECT DISTINCT item FROM ids))
SELECT DISTINCT "user", item, user_number, item_number FROM ids JOIN users USING ("user") JOIN items USING (item)""",
    "rule_search": f"""
WITH {JUDGED_FOLDS},
per_fold AS (
  SELECT t, fold, round(avg(CASE WHEN y = CASE WHEN q > t THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END), 9) AS metric
  FROM judged, (VALUES (10.0), (20.0), (30.0), (30.5), (40.0)) AS rules(t) GROUP BY ALL),
means AS (SELECT t::DOUBLE AS threshold, round(avg(metric), 8) AS mean_metric FROM per_fold GROUP BY t)
SELECT threshold, mean_metric, (row_number() OVER (ORDER BY threshold) - 1)::INTEGER AS point,
  row_number() OVER (ORDER BY mean_metric DESC, threshold)::INTEGER AS place FROM means""",
    "dense_als_check": f"""
WITH {SPLIT} SELECT DISTINCT "user" + 1099511627776 AS "user", 50::BIGINT AS n_items FROM split WHERE split = 'test'""",
    "topk_check": f"""
WITH {SPLIT} SELECT DISTINCT "user", 50::BIGINT AS n_items, 50::BIGINT AS n_same FROM split WHERE split = 'test'""",
}
