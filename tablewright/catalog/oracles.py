"""The same results in plain SQL, for the queries that SQL can say."""

from __future__ import annotations

CUT = "TIMESTAMP '2024-01-16'"
LATE_CUT = "TIMESTAMP '2024-01-24'"

EVENTS = """
events_v AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS g,
         CASE WHEN event_id % 10 < 7 THEN user_id % 2 END AS label,
         CASE WHEN event_id % 5 = 0 THEN event_type ELSE regexp_extract(props, '([0-9]+)', 1) END AS raw_text
  FROM events
)"""

RAW_EVENTS = f"""{EVENTS},
raw AS (
  SELECT event_id, ts,
         CASE WHEN ts < {CUT} AND event_id % 10 < 7 THEN CAST(user_id % 2 AS DOUBLE) END AS label,
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 11 = 0 THEN event_type
              ELSE concat('Name, ', event_type, '. Given') END AS name,
         TRY_CAST(raw_text AS DOUBLE) AS amount,
         v AS fare,
         CAST(user_id % 3 AS DOUBLE) AS siblings,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 2 AS DOUBLE) END AS parents,
         g AS port
  FROM events_v
),
titled AS (
  SELECT *, CASE WHEN name IS NULL THEN NULL WHEN regexp_extract(name, ' ([A-Za-z]+)\\.', 1) = '' THEN 'Other'
                 ELSE regexp_extract(name, ' ([A-Za-z]+)\\.', 1) END AS title
  FROM raw
)"""


WIDE_ORDERS = """
wide_orders AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('Customer ', o_custkey) END AS customer,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS price
  FROM orders
),
ranked AS (
  SELECT customer, row_number() OVER (ORDER BY count(*) DESC, customer) - 1 AS idx
  FROM wide_orders WHERE o_orderkey % 5 <> 0 AND customer IS NOT NULL GROUP BY customer
),
wide AS (
  SELECT o_orderkey, w.customer, price, CAST(coalesce(idx, (SELECT count(*) FROM ranked)) AS DOUBLE) AS customer_index
  FROM wide_orders w LEFT JOIN ranked r ON w.customer = r.customer
)"""


ACCOUNTED = """
WITH o AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders)
SELECT o_orderkey,
       CASE WHEN price NOT BETWEEN 2000 AND 400000 THEN 'rejected' WHEN price IS NULL THEN 'skipped' ELSE 'scored' END AS outcome,
       CASE WHEN price NOT BETWEEN 2000 AND 400000 THEN 'price_range' ELSE '' END AS violations,
       CASE WHEN price BETWEEN 2000 AND 400000 THEN CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) END AS prediction
FROM o
"""


def _feature_table(scope: str, label: str = "t.label, ", rows: str = "") -> str:
    return f"""
WITH {RAW_EVENTS},
fitted AS (SELECT * FROM titled {scope}),
means AS (SELECT title, avg(amount) AS mean_amount FROM fitted GROUP BY title),
one AS (
  SELECT (SELECT avg(fare) FROM fitted) AS mean_fare,
         (SELECT port FROM fitted WHERE port IS NOT NULL GROUP BY port ORDER BY count(*) DESC, port LIMIT 1) AS mode_port
)
SELECT t.event_id, {label}t.title, t.siblings, t.parents,
       round(coalesce(t.fare, one.mean_fare), 6) AS fare,
       coalesce(t.port, one.mode_port) AS port,
       t.siblings + t.parents + 1 AS family_size,
       CASE WHEN t.siblings + t.parents + 1 = 1 THEN 1 ELSE 0 END AS is_alone,
       round(coalesce(t.amount, means.mean_amount), 6) AS amount_filled
FROM titled t LEFT JOIN means ON t.title = means.title CROSS JOIN one {rows}
"""


ORDER_RULES = """
checked AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
         o_orderkey % 13 = 0 AS b1,
         NOT (o_totalprice BETWEEN 2000 AND 400000) AS b2,
         o_orderstatus NOT IN ('F', 'O') AS b3,
         o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') AS b4
  FROM orders
)"""

def _hash(seed: int, key: str = "o_orderkey") -> str:
    """The multiplicative hash: the key moved by the seed, multiplied, folded, multiplied."""
    product = f"((({key} % 2147483648 + {seed * 668265263 % 2147483648}) % 2147483648) * 2654435761 % 4294967296)"
    return f"((xor({product}, {product} >> 15) % 2147483648) * 2654435761 % 4294967296)"


HASH, SPLIT_HASH, FOLD_HASH = _hash(42), _hash(43), _hash(44)

PRICES = """
SELECT 'l_extendedprice' AS feature, l_extendedprice AS value, count(*) AS n,
       CAST(sum(count(*)) OVER (ORDER BY l_extendedprice) AS BIGINT) AS n_upto,
       CAST(sum(count(*)) OVER () AS BIGINT) AS n_total
FROM lineitem GROUP BY l_extendedprice
"""

# Kolmogorov limit law at lam, and the chi-squared tail at x for even degrees of freedom.
def _ks_p(lam: str) -> str:
    return (
        f"CASE WHEN {lam} < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, list_sum(list_transform(range(1, 101), "
        f"lambda j: (CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * j * j * {lam} * {lam}))))) END"
    )


def _chi2_even_p(x: str, dof: str) -> str:
    return f"CASE {dof} WHEN 0 THEN 1.0 WHEN 2 THEN exp(-{x} / 2) WHEN 4 THEN exp(-{x} / 2) * (1 + {x} / 2) END"


# The tail for one degree of freedom, by the series of the error function.
CHI2_ONE_P = "1 - exp(-x / 2) * list_sum(list_transform(range(0, 120), lambda j: pow(x / 2, j + 0.5) / gamma(j + 1.5)))"


def _ks(long: str) -> str:
    """KS statistics per feature of the table ``long(feature, value, is_new)``."""
    return f"""
ks_counts AS (
  SELECT feature, value, sum(is_new) AS a, sum(1 - is_new) AS b
  FROM {long} WHERE value IS NOT NULL GROUP BY feature, value
),
ks_upto AS (
  SELECT feature, sum(a) OVER w AS a_upto, sum(b) OVER w AS b_upto,
         sum(a) OVER (PARTITION BY feature) AS a_total, sum(b) OVER (PARTITION BY feature) AS b_total
  FROM ks_counts WINDOW w AS (PARTITION BY feature ORDER BY value)
),
ks AS (
  SELECT feature, max(abs(CAST(a_upto AS DOUBLE) / a_total - CAST(b_upto AS DOUBLE) / b_total)) AS d,
         CAST(max(a_total) AS BIGINT) AS n_new, CAST(max(b_total) AS BIGINT) AS n_base
  FROM ks_upto GROUP BY feature
),
ks_p AS (
  SELECT *, {_ks_p("d * (sqrt(CAST(n_new AS DOUBLE) * n_base / (n_new + n_base)) + 0.12 + 0.11 / nullif(sqrt(CAST(n_new AS DOUBLE) * n_base / (n_new + n_base)), 0))")} AS p FROM ks
)"""


def _chi2(long: str) -> str:
    """Chi-squared statistics per feature of the table ``long(feature, category, is_new)``."""
    return f"""
cells AS (
  SELECT feature, category, CAST(sum(is_new) AS DOUBLE) AS a, CAST(sum(1 - is_new) AS DOUBLE) AS b
  FROM {long} GROUP BY feature, category
),
expected AS (
  SELECT feature, a, b, count(*) OVER f - 1 AS dof,
         sum(a) OVER f AS a_total, sum(b) OVER f AS b_total,
         (a + b) * sum(a) OVER f / (sum(a) OVER f + sum(b) OVER f) AS ea,
         (a + b) * sum(b) OVER f / (sum(a) OVER f + sum(b) OVER f) AS eb
  FROM cells WINDOW f AS (PARTITION BY feature)
),
chi2 AS (
  SELECT feature, dof,
         CASE WHEN dof = 0 THEN 0.0
              WHEN dof = 1 THEN sum((abs(a - ea) - least(0.5, abs(a - ea))) ** 2 / ea
                                  + (abs(b - eb) - least(0.5, abs(b - eb))) ** 2 / eb)
              ELSE sum((a - ea) ** 2 / ea + (b - eb) ** 2 / eb) END AS x,
         CAST(max(a_total) AS BIGINT) AS n_new, CAST(max(b_total) AS BIGINT) AS n_base
  FROM expected GROUP BY feature, dof
)"""


KS_LONG = f"""
ks_long AS (
  SELECT 'v' AS feature, v AS value, CAST(ts >= {CUT} AS INTEGER) AS is_new FROM events_v
  UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE), CAST(ts >= {CUT} AS INTEGER) FROM events_v
  UNION ALL SELECT 'tripled', CASE WHEN ts >= {CUT} THEN value * 3 ELSE value END, CAST(ts >= {CUT} AS INTEGER) FROM events_v
)"""

KS_QUERY = f"""
WITH {EVENTS}, {KS_LONG}, {_ks("ks_long")}
SELECT feature, round(d, 9) AS statistic, n_new, n_base, round(p, 6) AS p_value, p < 0.05 AS drifted FROM ks_p
"""

ORDER_LONG = """
order_long AS (
  SELECT feature, category, is_new FROM (
    SELECT CAST(o_orderkey % 5 = 0 AS INTEGER) AS is_new, o_orderpriority, o_orderstatus,
           CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS price_class,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS gappy_priority
    FROM orders
  ) CROSS JOIN LATERAL (VALUES ('o_orderpriority', o_orderpriority), ('o_orderstatus', o_orderstatus),
                               ('price_class', price_class), ('gappy_priority', gappy_priority),
                               ('constant', 'same')) AS f(feature, category)
)"""

REPORT = f"""
{EVENTS}, {KS_LONG}, {_ks("ks_long")},
type_long AS (
  SELECT 'event_type' AS feature, event_type AS category, CAST(ts >= {CUT} AS INTEGER) AS is_new FROM events_v
  UNION ALL SELECT 'one_type', CASE WHEN ts >= {CUT} THEN 'click' ELSE event_type END, CAST(ts >= {CUT} AS INTEGER)
  FROM events_v
),
{_chi2("type_long")},
report AS (
  SELECT feature, 'ks' AS kind, d AS statistic, CAST(NULL AS BIGINT) AS dof, p AS p_value FROM ks_p
  UNION ALL SELECT feature, 'chi2', x, dof, {_chi2_even_p("x", "dof")} FROM chi2
)"""

SCORED = """
scored AS (
  SELECT CAST(quality AS DOUBLE) AS label, CAST(n_chars > 1000 AS DOUBLE) AS prediction, CAST(n_chars AS DOUBLE) AS score
  FROM documents JOIN labels USING (doc_id)
)"""

RATES = f"""{SCORED},
pairs AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction),
classes AS (SELECT label AS cls, sum(n) AS actual FROM pairs GROUP BY label),
parts AS (
  SELECT cls, CAST(actual AS DOUBLE) AS actual,
         CAST((SELECT coalesce(sum(n), 0) FROM pairs WHERE label = cls AND prediction = cls) AS DOUBLE) AS tp,
         CAST((SELECT coalesce(sum(n), 0) FROM pairs WHERE prediction = cls) AS DOUBLE) AS predicted,
         CAST((SELECT sum(n) FROM pairs) AS DOUBLE) AS total
  FROM classes
),
rates0 AS (
  SELECT cls, tp, actual, total, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p, tp / actual AS r,
         (predicted - tp) / (total - actual) AS fpr, actual / total AS w
  FROM parts
),
rates AS (
  SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1,
         CASE WHEN 4 * p + r = 0 THEN 0.0 ELSE 5 * p * r / (4 * p + r) END AS f2
  FROM rates0
),
headline AS (
  SELECT round(sum(tp) / max(total), 6) AS accuracy, round(sum(f1 * w), 6) AS f1_score,
         round(sum(p * w), 6) AS "precision", round(sum(r * w), 6) AS recall
  FROM rates
)"""

HEADLINE_LONG = """
  SELECT 'accuracy' AS name, accuracy AS value FROM headline UNION ALL SELECT 'f1_score', f1_score FROM headline
  UNION ALL SELECT 'precision', "precision" FROM headline UNION ALL SELECT 'recall', recall FROM headline
"""


def _curve(source: str) -> str:
    return f"""
curve_counts AS (
  SELECT score, sum(CAST(label = 1 AS INTEGER)) AS pos, sum(CAST(label = 0 AS INTEGER)) AS neg
  FROM {source} GROUP BY score
),
curve AS (
  SELECT score, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
         CAST(sum(pos) OVER () AS DOUBLE) AS positives, CAST(sum(neg) OVER () AS DOUBLE) AS negatives
  FROM curve_counts WINDOW w AS (ORDER BY score DESC)
),
points AS (
  SELECT score, fp / negatives AS fpr, tp / positives AS tpr, tp / (tp + fp) AS prec FROM curve
),
steps AS (
  SELECT fpr - lag(fpr, 1, 0.0) OVER w AS d_fpr, tpr - lag(tpr, 1, 0.0) OVER w AS d_tpr,
         tpr + lag(tpr, 1, 0.0) OVER w AS s_tpr, prec + lag(prec, 1, 1.0) OVER w AS s_prec
  FROM points WINDOW w AS (ORDER BY score DESC)
),
area AS (SELECT sum(d_fpr * s_tpr) / 2 AS auc_roc, sum(d_tpr * s_prec) / 2 AS auc_pr FROM steps)"""


PRIORITY_RANK = """
ranked AS (
  SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS idx
  FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority
),
indexed AS (
  SELECT o_orderkey, o.o_orderpriority, coalesce(idx, CAST((SELECT count(*) FROM ranked) AS DOUBLE)) AS idx
  FROM orders o LEFT JOIN ranked r ON o.o_orderpriority = r.o_orderpriority
)"""

MODEL_ORDERS = """
model_orders AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice + (o_orderkey * 7919) % 200000 END AS noisy_price,
         CAST(month(o_orderdate) AS DOUBLE) AS order_month, CAST(o_custkey % 100 AS DOUBLE) AS cust_mod,
         o_orderpriority, o_orderstatus
  FROM orders
)"""

RULE_SCORED = """
SELECT o_orderkey, CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS prediction,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'urgent' ELSE 'other' END AS prediction_label
FROM orders WHERE o_orderkey % 17 <> 0
"""

# A fit that finds the rule has no wrong prediction on the held-out rows.
RULE_MATRIX = f"""
WITH held_out AS (
  SELECT CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS DOUBLE) AS label
  FROM orders WHERE o_orderkey % 17 <> 0 AND {SPLIT_HASH} >= 0.8 * 4294967296
),
grid AS (SELECT CAST(a AS DOUBLE) AS label, CAST(b AS DOUBLE) AS prediction FROM range(2) x(a), range(2) y(b))
SELECT g.label, g.prediction, count(h.label) AS n
FROM grid g LEFT JOIN held_out h ON g.label = h.label AND g.prediction = h.label GROUP BY g.label, g.prediction
"""

STREAMED = f"""
streamed AS (
  SELECT CASE WHEN ts < {CUT} THEN -1 WHEN ts < {LATE_CUT} THEN 0 ELSE 1 END AS batch,
         CASE WHEN ts < {LATE_CUT} THEN v ELSE v * 3 END AS v, user_id, event_type
  FROM events_v
),
paired AS (
  SELECT b.batch_id, s.v, s.user_id, s.event_type, CAST(s.batch = b.batch_id AS INTEGER) AS is_new
  FROM streamed s JOIN (VALUES (0), (1)) AS b(batch_id) ON s.batch = -1 OR s.batch = b.batch_id
),
number_long AS (
  SELECT concat(batch_id, '|v') AS feature, v AS value, is_new FROM paired
  UNION ALL SELECT concat(batch_id, '|user_id'), CAST(user_id AS DOUBLE), is_new FROM paired
),
type_long AS (SELECT concat(batch_id, '|event_type') AS feature, event_type AS category, is_new FROM paired)"""

GIVEN_SCORES = """(SELECT o_orderpriority AS family, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS family_rank, CAST(o_orderkey % 5 AS INTEGER) AS point,
  '{"maxDepth": ' || (o_orderkey % 5) || '}' AS params, round(avg(CASE WHEN o_totalprice > 200000 THEN 1.0 ELSE 0.0 END), 6) AS f1
  FROM orders GROUP BY ALL)"""

ORACLES: dict[str, str] = {
    "csv_roundtrip": "SELECT * FROM part",
    "append_batch": f"""
SELECT event_id, CASE WHEN ts < {CUT} THEN user_id END AS user_id, event_type, value FROM events
""",
    "append_batch_replayed": f"""
SELECT event_id, CASE WHEN ts < {CUT} THEN user_id END AS user_id, event_type, value FROM events
""",
    "tolerant_cast": f"WITH {EVENTS} SELECT event_id, TRY_CAST(raw_text AS DOUBLE) AS raw_text FROM events_v",
    "title_extract": r"""
SELECT doc_id, CASE WHEN regexp_extract(text, ' ([A-Za-z]+)\.', 1) = '' THEN 'Other'
                    ELSE regexp_extract(text, ' ([A-Za-z]+)\.', 1) END AS title
FROM documents
""",
    "family_features": """
WITH l AS (
  SELECT l_orderkey, l_linenumber - 1 AS siblings, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_partkey % 3 END AS parents
  FROM lineitem
)
SELECT *, siblings + parents + 1 AS family_size,
       CASE WHEN siblings + parents + 1 = 1 THEN 1 ELSE 0 END AS is_alone
FROM l
""",
    "union_by_name": f"""
WITH {EVENTS}
SELECT event_id, g, CASE WHEN ts < {CUT} THEN label END AS label, CASE WHEN ts >= {CUT} THEN v END AS v FROM events_v
""",
    "split_labelled": f"WITH {EVENTS} SELECT event_id, label FROM events_v WHERE label IS NOT NULL",
    "split_unlabelled": f"WITH {EVENTS} SELECT event_id, label FROM events_v WHERE label IS NULL",
    "feature_table": _feature_table(""),
    "feature_table_train_scope": _feature_table("WHERE label IS NOT NULL"),
    "group_mean": f"WITH {EVENTS} SELECT g, round(avg(v), 6) AS mean_v, count(*) AS n_rows FROM events_v GROUP BY g",
    "category_counts": f"WITH {EVENTS} SELECT g, count(*) AS n FROM events_v GROUP BY g",
    "mode_top1": f"""
WITH {EVENTS} SELECT g, count(*) AS n FROM events_v WHERE g IS NOT NULL GROUP BY g ORDER BY n DESC, g LIMIT 1
""",
    "impute_group_mean": f"""
WITH {EVENTS}, m AS (SELECT g, avg(v) AS mean_v FROM events_v GROUP BY g)
SELECT event_id, e.g, round(coalesce(v, mean_v), 6) AS filled FROM events_v e LEFT JOIN m ON e.g = m.g
""",
    "impute_group_mean_shuffled": """
WITH l AS (
  SELECT l_orderkey, l_extendedprice,
         CASE WHEN l_orderkey % 3 = 0 THEN -1 WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_partkey END AS part,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS quantity
  FROM lineitem
),
m AS (SELECT part, avg(quantity) AS mean_quantity FROM l GROUP BY part)
SELECT l_orderkey, l_extendedprice, l.part, round(coalesce(quantity, mean_quantity), 6) AS quantity
FROM l LEFT JOIN m ON l.part = m.part
""",
    "impute_mode": f"""
WITH {EVENTS}
SELECT event_id, coalesce(g, (SELECT g FROM events_v WHERE g IS NOT NULL GROUP BY g ORDER BY count(*) DESC, g LIMIT 1)) AS g
FROM events_v
""",
    "impute_mean": f"""
WITH {EVENTS} SELECT event_id, round(coalesce(v, (SELECT avg(v) FROM events_v)), 6) AS v FROM events_v
""",
    "numeric_profile": """
WITH l AS (
  SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS q, l_extendedprice AS e, l_discount AS d
  FROM lineitem
),
k AS (SELECT * FROM l WHERE q IS NOT NULL)
SELECT 'l_quantity' AS feature, round(avg(q), 4) AS mean, round(stddev_samp(q), 4) AS stddev, round(min(q), 4) AS min, round(max(q), 4) AS max FROM k
UNION ALL
SELECT 'l_extendedprice', round(avg(e), 4), round(stddev_samp(e), 4), round(min(e), 4), round(max(e), 4) FROM k
UNION ALL
SELECT 'l_discount', round(avg(d), 4), round(stddev_samp(d), 4), round(min(d), 4), round(max(d), 4) FROM k
""",
    "quality_violations": f"""
WITH {ORDER_RULES}
SELECT o_orderkey, concat_ws(',', CASE WHEN b1 THEN 'o_custkey_required' END, CASE WHEN b2 THEN 'o_totalprice_range' END,
       CASE WHEN b3 THEN 'o_orderstatus_domain' END, CASE WHEN b4 THEN 'o_orderpriority_domain' END) AS violations
FROM checked WHERE b1 OR b2 OR b3 OR b4
""",
    "quality_valid": f"""
WITH {ORDER_RULES} SELECT o_orderkey, o_custkey FROM checked WHERE NOT (b1 OR b2 OR b3 OR b4)
""",
    "quality_summary": f"""
WITH {ORDER_RULES}
SELECT 'o_custkey_required' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE b1) AS n_failed FROM checked
UNION ALL SELECT 'o_totalprice_range', count(*), count(*) FILTER (WHERE b2) FROM checked
UNION ALL SELECT 'o_orderstatus_domain', count(*), count(*) FILTER (WHERE b3) FROM checked
UNION ALL SELECT 'o_orderpriority_domain', count(*), count(*) FILTER (WHERE b4) FROM checked
""",
    "hash_sample": f"SELECT o_orderkey, o_totalprice FROM orders WHERE {HASH} < 0.2 * 4294967296",
    "hash_split": f"""
SELECT o_orderkey, CASE WHEN {SPLIT_HASH} < 0.8 * 4294967296 THEN 'train' ELSE 'test' END AS part FROM orders
""",
    "sample_n": f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {HASH}, o_orderkey LIMIT 150",
    "sample_n_large": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
ORDER BY {_hash(42, "l_orderkey")}, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
LIMIT (SELECT count(*) // 2 FROM lineitem)
""",
    "csv_rejects": """
WITH lines AS (
  SELECT p_partkey, p_name, p_size, CASE WHEN p_partkey % 7 = 0 THEN concat(p_partkey, ',', p_name)
    WHEN p_partkey % 11 = 0 THEN concat(p_partkey, ',', p_name, ',', p_size, ',more')
    WHEN p_partkey % 13 = 0 THEN concat(p_partkey, ',', p_name, ',', p_name) END AS record
  FROM part
)
SELECT CASE WHEN record IS NULL THEN 'row' ELSE 'reject' END AS kind, CASE WHEN record IS NULL THEN p_partkey END AS p_partkey,
       CASE WHEN record IS NULL THEN p_name END AS p_name, CASE WHEN record IS NULL THEN p_size END AS p_size, record
FROM lines
""",
    "kfold_counts": f"""
SELECT CAST(floor({FOLD_HASH} / 4294967296.0 * 3) AS INTEGER) AS fold, count(*) AS n FROM orders GROUP BY 1
""",
    "prefix_counts": PRICES,
    "prefix_counts_bucketed": PRICES,
    "contingency": f"""
WITH {ORDER_LONG}
SELECT feature, category, CAST(sum(is_new) AS BIGINT) AS n_new, CAST(sum(1 - is_new) AS BIGINT) AS n_base
FROM order_long WHERE feature IN ('gappy_priority', 'o_orderstatus') GROUP BY feature, category
""",
    "drift_chi2": f"""
WITH {ORDER_LONG}, {_chi2("order_long")}
SELECT feature, dof, n_new, n_base, round(x, 6) AS statistic, round({_chi2_even_p("x", "dof")}, 6) AS p_value,
       {_chi2_even_p("x", "dof")} < 0.05 AS drifted
FROM chi2 WHERE feature IN ('o_orderpriority', 'o_orderstatus', 'constant')
""",
    "drift_chi2_yates": f"""
WITH {ORDER_LONG}, {_chi2("order_long")}
SELECT feature, dof, n_new, n_base, round(x, 6) AS statistic, round({CHI2_ONE_P}, 6) AS p_value, x > 3.841458820694124 AS drifted
FROM chi2 WHERE feature = 'price_class'
""",
    "drift_ks": KS_QUERY,
    "drift_ks_bucketed": KS_QUERY,
    "drift_report": f"""
WITH {REPORT}
SELECT feature, kind, round(statistic, 6) AS statistic, dof, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM report
""",
    "drift_verdict": f"""
WITH {REPORT}
SELECT bool_or(p_value < 0.05) AS drift_detected, count(*) FILTER (WHERE p_value < 0.05) AS n_drifted,
       count(*) AS n_features FROM report
""",
    "retrain_gate": f"""
WITH {REPORT}, verdict AS (SELECT bool_or(p_value < 0.05) AS drift_detected FROM report)
SELECT drift_detected, FALSE AS model_exists, 'train' AS action,
       CASE WHEN drift_detected THEN 'drift and no model' ELSE 'no model' END AS reason FROM verdict
""",
    # A table against itself has the statistic 0 for every feature.
    "retrain_gate_skip": """
SELECT count(*) = 0 AS drift_detected, TRUE AS model_exists, 'skip' AS action, 'no drift and a model exists' AS reason FROM events
""",
    "confusion_matrix": f"""
WITH {SCORED}, classes AS (SELECT DISTINCT label FROM scored),
grid AS (SELECT a.label, b.label AS prediction FROM classes a CROSS JOIN classes b)
SELECT g.label, g.prediction, count(s.label) AS n
FROM grid g LEFT JOIN scored s ON g.label = s.label AND g.prediction = s.prediction GROUP BY g.label, g.prediction
""",
    "classification_metrics": f'WITH {RATES} SELECT * FROM headline',
    "classification_report": f"""
WITH {RATES}
SELECT round(sum(tp) / max(total), 6) AS accuracy, round(sum(p * w), 6) AS "weightedPrecision",
       round(sum(r * w), 6) AS "weightedRecall", round(sum(f1 * w), 6) AS "weightedFMeasure",
       round(sum(f2 * w), 6) AS "weightedFMeasure_beta",
       round(max(CASE WHEN cls = 0 THEN fpr END), 6) AS "falsePositiveRate_0",
       round(max(CASE WHEN cls = 1 THEN fpr END), 6) AS "falsePositiveRate_1",
       round(max(CASE WHEN cls = 0 THEN r END), 6) AS "truePositiveRate_0",
       round(max(CASE WHEN cls = 1 THEN r END), 6) AS "truePositiveRate_1"
FROM rates
""",
    "metrics_long": f"WITH {RATES} {HEADLINE_LONG}",
    "roc_curve": f"""
WITH {SCORED}, {_curve("scored")}
SELECT score AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM points
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0
""",
    "pr_curve": f"""
WITH {SCORED}, {_curve("scored")}
SELECT score AS threshold, round(tpr, 6) AS recall, round(prec, 6) AS "precision" FROM points
UNION ALL SELECT NULL, 0.0, 1.0
""",
    "auc_roc": f"WITH {SCORED}, {_curve('scored')} SELECT round(auc_roc, 6) AS auc_roc FROM area",
    "auc_pr": f"WITH {SCORED}, {_curve('scored')} SELECT round(auc_pr, 6) AS auc_pr FROM area",
    "auc_lineitem_bucketed": f"""
WITH scored AS (SELECT l_extendedprice AS score, CAST(l_quantity > 25 AS INTEGER) AS label FROM lineitem),
{_curve("scored")}
SELECT round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr FROM area
""",
    "string_index": f"WITH {PRIORITY_RANK} SELECT o_orderkey, o_orderpriority, idx AS o_orderpriority_index FROM indexed",
    "one_hot": f"""
WITH {PRIORITY_RANK}
SELECT o_orderkey, array_to_string(list_transform(range((SELECT count(*) FROM ranked)),
       lambda i: CASE WHEN i = idx THEN '1' ELSE '0' END), ',') AS slots
FROM indexed
""",
    "string_index_wide": f"WITH {WIDE_ORDERS} SELECT o_orderkey, customer, customer_index FROM wide",
    "string_index_wide_shuffled": f"WITH {WIDE_ORDERS} SELECT o_orderkey, customer, customer_index FROM wide",
    "sparse_vectors": f"""
WITH {WIDE_ORDERS}, known AS (SELECT count(*) AS n FROM ranked)
SELECT o_orderkey, CAST(1 + n AS INTEGER) AS n_slots,
       concat('0', CASE WHEN customer_index < n THEN concat(',', CAST(customer_index AS INTEGER) + 1) ELSE '' END) AS slots,
       round(price + CASE WHEN customer_index < n THEN 1 ELSE 0 END, 2) AS total
FROM wide, known WHERE price IS NOT NULL
""",
    "assembled_rows": f"""
WITH {MODEL_ORDERS}
SELECT o_orderkey,
       CAST(3 + (SELECT count(DISTINCT o_orderpriority) + count(DISTINCT o_orderstatus) FROM model_orders) AS INTEGER) AS n_slots,
       round(noisy_price + order_month + cust_mod + 2, 2) AS total
FROM model_orders WHERE noisy_price IS NOT NULL
""",
    "feature_info": f"""
WITH {MODEL_ORDERS}
SELECT CAST(0 AS INTEGER) AS position, 'noisy_price' AS feature, 'numerical' AS kind, CAST(1 AS INTEGER) AS slots
UNION ALL SELECT 1, 'order_month', 'numerical', 1
UNION ALL SELECT 2, 'cust_mod', 'numerical', 1
UNION ALL SELECT 3, 'o_orderpriority_vec', 'categorical', CAST(count(DISTINCT o_orderpriority) AS INTEGER) FROM model_orders
UNION ALL SELECT 4, 'o_orderstatus_vec', 'categorical', CAST(count(DISTINCT o_orderstatus) AS INTEGER) FROM model_orders
""",
    "model_signature": """
WITH base(position, name, type) AS (VALUES
  (0, 'o_orderkey', 'bigint'), (1, 'label', 'double'), (2, 'noisy_price', 'double'), (3, 'order_month', 'double'),
  (4, 'cust_mod', 'double'), (5, 'o_orderpriority', 'string'), (6, 'o_orderstatus', 'string')),
added(position, name, type) AS (VALUES
  (7, 'o_orderpriority_index', 'double'), (8, 'o_orderstatus_index', 'double'), (9, 'o_orderpriority_vec', 'vector'),
  (10, 'o_orderstatus_vec', 'vector'), (11, 'features', 'vector'))
SELECT 'input' AS io, CAST(position AS INTEGER) AS position, name, type FROM base
UNION ALL SELECT 'output', CAST(position AS INTEGER), name, type FROM base
UNION ALL SELECT 'output', CAST(position AS INTEGER), name, type FROM added
""",
    "tuning_table_rule": f"""
WITH points(family, family_rank, point, params) AS (VALUES
  ('GBTClassifier', 0, 0, '{{"maxDepth": 3, "maxIter": 10}}'), ('GBTClassifier', 0, 1, '{{"maxDepth": 3, "maxIter": 20}}'),
  ('GBTClassifier', 0, 2, '{{"maxDepth": 5, "maxIter": 10}}'), ('GBTClassifier', 0, 3, '{{"maxDepth": 5, "maxIter": 20}}'),
  ('RandomForest', 1, 0, '{{"numTrees": 20, "maxDepth": 5}}'), ('RandomForest', 1, 1, '{{"numTrees": 20, "maxDepth": 7}}'),
  ('RandomForest', 1, 2, '{{"numTrees": 20, "maxDepth": 10}}'), ('RandomForest', 1, 3, '{{"numTrees": 50, "maxDepth": 5}}'),
  ('RandomForest', 1, 4, '{{"numTrees": 50, "maxDepth": 7}}'), ('RandomForest', 1, 5, '{{"numTrees": 50, "maxDepth": 10}}'),
  ('DecisionTree', 2, 0, '{{"maxDepth": 5}}'), ('DecisionTree', 2, 1, '{{"maxDepth": 7}}'), ('DecisionTree', 2, 2, '{{"maxDepth": 10}}'),
  ('LogisticRegression', 3, 0, '{{"regParam": 0.01}}'), ('LogisticRegression', 3, 1, '{{"regParam": 0.1}}')),
-- What the rule itself gets on the training rows that have a price: each class's F1, weighted by its rows.
rows AS (
  SELECT o_orderpriority IN ('1-URGENT', '2-HIGH') AS y, o_orderpriority < '3' AS found FROM orders
  WHERE {SPLIT_HASH} < 0.8 * 4294967296 AND o_orderkey % 17 <> 0
),
classes AS (
  SELECT c, count(*) FILTER (WHERE y = c AND found = c) AS tp, count(*) FILTER (WHERE found = c) AS told, count(*) FILTER (WHERE y = c) AS n
  FROM rows CROSS JOIN (VALUES (TRUE), (FALSE)) AS k(c) GROUP BY c
),
rule AS (SELECT round(sum(2.0 * tp / (told + n) * n) / sum(n), 6) AS f1 FROM classes)
SELECT family, CAST(family_rank AS INTEGER) AS family_rank, CAST(point AS INTEGER) AS point, params, f1 FROM points CROSS JOIN rule
""",
    "feature_importance_rule": f"""
-- A tree splits off the positive priority with the larger gain, then the other one; both parts are pure then.
WITH rows AS (
  SELECT o_orderpriority FROM orders WHERE {SPLIT_HASH} < 0.8 * 4294967296 AND o_orderkey % 17 <> 0
),
counts AS (
  SELECT o_orderpriority, count(*) AS n, o_orderpriority IN ('1-URGENT', '2-HIGH') AS y, sum(count(*)) OVER () AS total FROM rows GROUP BY 1
),
whole AS (SELECT max(total) AS total, sum(n) FILTER (WHERE y) AS positive, max(n) FILTER (WHERE y) AS first FROM counts),
gains AS (
  SELECT total * 2.0 * (positive / total) * (1 - positive / total) AS all_gain,
         (total - first) * 2.0 * ((positive - first) / (total - first)) * (1 - (positive - first) / (total - first)) AS second, first
  FROM whole
)
SELECT concat('o_orderpriority_vec_', o_orderpriority) AS feature,
       round(CASE WHEN NOT y THEN 0.0 WHEN n = first THEN 1 - second / all_gain ELSE second / all_gain END, 6) AS importance
FROM counts, gains UNION ALL SELECT 'price', 0.0
""",
    "probability_given": """
WITH o AS (
  SELECT o_orderkey, -1.5 + 0.00001 * CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END
         + CASE o_orderpriority WHEN '1-URGENT' THEN 1.25 WHEN '2-HIGH' THEN 0.5 WHEN '5-LOW' THEN -2.0 ELSE 0 END AS z
  FROM orders
)
SELECT o_orderkey, round(1 / (1 + exp(-z)), 9) AS probability, CAST(1 / (1 + exp(-z)) > 0.5 AS INTEGER) AS prediction FROM o
""",
    "score_skipped": f"WITH {MODEL_ORDERS} SELECT o_orderkey FROM model_orders WHERE noisy_price IS NULL",
    "run_log": f"""
WITH {RATES}, {_curve("scored")}
SELECT FALSE AS nested, 'param' AS kind, 'threshold' AS key, '1000' AS text, CAST(NULL AS DOUBLE) AS number
UNION ALL SELECT FALSE, 'tag', 'status', 'finished', NULL
UNION ALL SELECT FALSE, 'tag', 'run_name', 'evaluation', NULL
UNION ALL SELECT TRUE, 'tag', 'status', 'finished', NULL
UNION ALL SELECT TRUE, 'tag', 'run_name', 'areas', NULL
UNION ALL SELECT TRUE, 'metric', 'auc_roc', NULL, round(auc_roc, 6) FROM area
UNION ALL SELECT TRUE, 'metric', 'auc_pr', NULL, round(auc_pr, 6) FROM area
UNION ALL SELECT FALSE, 'metric', name, NULL, value FROM ({HEADLINE_LONG})
""",
    "fit_dt_rule": RULE_MATRIX,
    "fit_rf_rule": RULE_MATRIX,
    "fit_lr_rule": RULE_MATRIX,
    "fit_gbt_rule": RULE_MATRIX,
    "score_batch_rule": RULE_SCORED,
    "stream_score_rule": RULE_SCORED,
    "stream_features": _feature_table("", "", f"WHERE t.ts >= {CUT}"),
    "stream_drift": f"""
WITH {EVENTS}, {STREAMED}, {_ks("number_long")}, {_chi2("type_long")},
report AS (
  SELECT feature, 'ks' AS kind, d AS statistic, CAST(NULL AS BIGINT) AS dof, p AS p_value FROM ks_p
  UNION ALL SELECT feature, 'chi2', x, dof, {_chi2_even_p("x", "dof")} FROM chi2
)
SELECT CAST(split_part(feature, '|', 1) AS BIGINT) AS batch_id, split_part(feature, '|', 2) AS feature, kind,
       round(statistic, 6) AS statistic, dof, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted
FROM report
""",
    "append_rejects": """
SELECT event_id, concat_ws(',', CASE WHEN TRY_CAST(event_type AS INTEGER) IS NULL THEN 'event_type' END,
                           CASE WHEN TRY_CAST(event_id * 1000003 AS INTEGER) IS NULL THEN 'amount' END) AS misfits
FROM events WHERE TRY_CAST(event_type AS INTEGER) IS NULL AND event_type IS NOT NULL OR TRY_CAST(event_id * 1000003 AS INTEGER) IS NULL
""",
    "score_accounted": ACCOUNTED,
    "stream_score_accounted": ACCOUNTED,
    "best_model_given": f"SELECT family, params, f1 FROM {GIVEN_SCORES} ORDER BY f1 DESC, family_rank, point LIMIT 1",
    "best_params_given": f"""
SELECT 'maxDepth' AS param, CAST(point AS DOUBLE) AS value FROM {GIVEN_SCORES} ORDER BY f1 DESC, family_rank, point LIMIT 1
""",
    "best_per_family_given": f"""
SELECT * FROM {GIVEN_SCORES} QUALIFY row_number() OVER (PARTITION BY family ORDER BY f1 DESC, point) = 1
""",
}
