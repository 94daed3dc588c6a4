"""The same queries as plain SQL over the same tables, for a second engine to check."""

from __future__ import annotations

from basketspark.operators.clean import NON_PRODUCT_CODES, STEP_LABELS
from basketspark.operators.features import FEATURE_COLUMNS, RFM_COLUMNS
from basketspark.operators.segment import GUIDANCE, SCORE_RANGE
from verification.queries import EFFECT_CENTRES, EFFECT_SCALES, FIXED_BUYING, FIXED_CENTROIDS, FIXED_NAMES, FIXED_SPENDING

CODES = ", ".join(f"'{c}'" for c in NON_PRODUCT_CODES)
NOT_ADMIN = f"NOT coalesce(upper(stock_code) IN ({CODES}), false)"
WELL_FORMED = r"coalesce(regexp_matches(stock_code, '^\d{5}\w*$'), false)"
IS_RETURN = "(upper(invoice) LIKE 'C%' OR quantity <= 0)"

# name -> (text, names it reads)
CTES: dict[str, tuple[str, list[str]]] = {}
COSTLY = ("w_test", "vec", "cvec", "retrieved", "cand")  # read several times by what follows them, computed once
ORACLES: dict[str, str] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTES[name] = (text, list(needs))


def sql(name: str, body: str, *needs: str) -> None:
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in order:
            for d in CTES[n][1]:
                visit(d)
            order.append(n)

    for n in needs:
        visit(n)
    head = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in COSTLY else ''}({CTES[n][0]})" for n in order)
    ORACLES[name] = f"WITH {head}\n{body}" if order else body


cte("ledger", """
  SELECT (CASE WHEN l_returnflag = 'R' AND l_partkey % 4 = 0 THEN 'C' ELSE '' END) || o_orderkey AS invoice,
         CASE WHEN l_partkey % 40 = 0 THEN 'POST' WHEN l_partkey % 41 = 0 THEN 'X' || l_partkey
              ELSE lpad(CAST(l_partkey AS VARCHAR), 5, '0') || (CASE WHEN l_partkey % 7 = 0 THEN 'A' ELSE '' END) END AS stock_code,
         p_name AS description,
         CAST(CASE WHEN l_returnflag = 'R' AND l_partkey % 4 = 0 THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
         o_orderdate + to_hours(o_orderkey % 24) AS invoice_date,
         CAST(CAST(CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE p_retailprice END AS DECIMAL(12,2)) AS DECIMAL(12,4)) AS price,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS customer_id, n_name AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN (VALUES (1), (2)) copies(copy) ON copy <= (CASE WHEN o_orderkey % 50 = 1 THEN 2 ELSE 1 END)""")
cte("lines", f"""
  SELECT DISTINCT *, {IS_RETURN} AS is_return, CAST(quantity * price AS DECIMAL(18,4)) AS line_total FROM ledger
  WHERE invoice_date IS NOT NULL AND quantity IS NOT NULL AND price IS NOT NULL AND {NOT_ADMIN} AND {WELL_FORMED}
    AND customer_id IS NOT NULL""", "ledger")
cte("purchases", "SELECT * EXCLUDE (is_return) FROM lines WHERE NOT is_return AND price > 0", "lines")
cte("returned", "SELECT * EXCLUDE (is_return) FROM lines WHERE is_return", "lines")
cte("cuts", """
  SELECT max(invoice_date) AS last_date, CAST(CAST(max(invoice_date) AS DATE) AS TIMESTAMP) - INTERVAL 180 DAY AS train_cutoff,
         CAST(CAST(max(invoice_date) AS DATE) AS TIMESTAMP) - INTERVAL 90 DAY AS test_cutoff FROM purchases""", "purchases")
for s in ("train", "test"):
    cte(f"obs_{s}", f"SELECT p.*, {s}_cutoff AS cutoff FROM purchases p, cuts WHERE invoice_date < {s}_cutoff", "purchases", "cuts")
    cte(f"fut_{s}", f"""SELECT p.* FROM purchases p, cuts WHERE invoice_date >= {s}_cutoff
        AND invoice_date < {s}_cutoff + INTERVAL 90 DAY""", "purchases", "cuts")
    cte(f"labels_{s}", f"""
      SELECT e.customer_id, CAST(coalesce(f.spend, 0) > 0 AS INTEGER) AS repurchased, CAST(coalesce(f.spend, 0) AS DOUBLE) AS future_spend
      FROM (SELECT DISTINCT customer_id FROM obs_{s}) e
      LEFT JOIN (SELECT customer_id, sum(line_total) AS spend FROM fut_{s} GROUP BY 1) f USING (customer_id)""", f"obs_{s}", f"fut_{s}")
    cte(f"rollup_{s}", f"""
      SELECT customer_id, count(DISTINCT invoice) AS frequency, CAST(sum(line_total) AS DOUBLE) AS monetary,
             count(DISTINCT stock_code) AS n_products, CAST(sum(quantity) AS BIGINT) AS n_items, min(invoice_date) AS first_purchase,
             max(invoice_date) AS last_purchase, datesub('day', max(invoice_date), max(cutoff)) AS recency,
             datesub('day', min(invoice_date), max(cutoff)) AS tenure,
             CAST(coalesce(sum(line_total) FILTER (WHERE invoice_date >= cutoff - INTERVAL 90 DAY), 0) AS DOUBLE) AS spend_last_90d,
             count(DISTINCT invoice) FILTER (WHERE invoice_date >= cutoff - INTERVAL 90 DAY) AS orders_last_90d
      FROM obs_{s} GROUP BY customer_id""", f"obs_{s}")
    cte(f"rfeat_{s}", f"""SELECT customer_id, count(DISTINCT invoice) AS n_returns, -CAST(sum(line_total) AS DOUBLE) AS returned_value
      FROM returned, cuts WHERE invoice_date < {s}_cutoff GROUP BY 1""", "returned", "cuts")
    cte(f"feat_{s}", f"""
      SELECT customer_id, recency, frequency, monetary, monetary / frequency AS avg_order_value, tenure, n_products, n_items,
             n_items / frequency AS avg_basket_value, CASE WHEN frequency > 1 THEN tenure / (frequency - 1) END AS avg_days_between_orders,
             spend_last_90d, orders_last_90d, coalesce(n_returns, 0) AS n_returns, coalesce(returned_value, 0.0) AS returned_value,
             first_purchase, repurchased, future_spend
      FROM rollup_{s} LEFT JOIN rfeat_{s} USING (customer_id) JOIN labels_{s} USING (customer_id)""", f"rollup_{s}", f"rfeat_{s}", f"labels_{s}")

LEDGER_OUT = ("invoice, stock_code, description, CAST(quantity AS DOUBLE) AS quantity, CAST(invoice_date AS VARCHAR) AS invoice_date, "
              "CAST(price AS DOUBLE) AS price, CAST(customer_id AS DOUBLE) AS customer_id, country")
LINES_OUT = LEDGER_OUT + ", CAST(line_total AS DOUBLE) AS line_total"
FEATURES_OUT = ", ".join(
    f"round({c}, 6) AS {c}" if c in ("monetary", "avg_order_value", "avg_basket_value", "avg_days_between_orders", "spend_last_90d", "returned_value") else c
    for c in FEATURE_COLUMNS
)

# --- sources and sinks ---
sql("ledger_read", f"SELECT {LEDGER_OUT} FROM ledger", "ledger")
sql("ledger_union", "SELECT country, CAST(year(invoice_date) AS INTEGER) AS year, count(*) AS n_rows, CAST(sum(quantity) AS BIGINT) AS units FROM ledger GROUP BY 1, 2", "ledger")
sql("ledger_normalise", """
  SELECT invoice, stock_code, description, CASE WHEN quantity % 11 <> 0 THEN CAST(quantity AS DOUBLE) END AS quantity, CAST(invoice_date AS VARCHAR) AS invoice_date,
         CASE WHEN quantity % 13 <> 0 THEN CAST(price AS DOUBLE) END AS price, CASE WHEN customer_id % 7 <> 0 THEN CAST(customer_id AS DOUBLE) END AS customer_id, country
  FROM ledger""", "ledger")
sql("ledger_cached", """SELECT invoice, count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(price) AS DOUBLE) AS price_sum
  FROM ledger GROUP BY 1""", "ledger")
sql("clean_tables_write", """
  SELECT side, customer_id, count(*) AS n_rows, CAST(sum(line_total) AS DOUBLE) AS total
  FROM (SELECT 'purchases' AS side, * FROM purchases UNION ALL SELECT 'returns', * FROM returned) GROUP BY 1, 2""", "purchases", "returned")
sql("returns_read", f"SELECT {LINES_OUT} FROM returned", "returned")
sql("customer_serving_table", f"SELECT customer_id, {FEATURES_OUT}, CAST(CAST((SELECT test_cutoff FROM cuts) AS DATE) AS VARCHAR) AS as_of FROM feat_test", "feat_test", "cuts")

# --- cleaning ---
sql("clean_dedup", f"SELECT DISTINCT {LEDGER_OUT} FROM ledger", "ledger")
sql("clean_required", f"SELECT {LEDGER_OUT} FROM ledger WHERE quantity % 11 <> 0 AND quantity % 13 <> 0", "ledger")
sql("clean_non_product", f"SELECT {LEDGER_OUT} FROM ledger WHERE {NOT_ADMIN}", "ledger")
sql("clean_code_format", f"SELECT {LEDGER_OUT} FROM ledger WHERE {WELL_FORMED}", "ledger")
sql("clean_has_customer", f"SELECT {LEDGER_OUT} FROM ledger WHERE customer_id IS NOT NULL", "ledger")
sql("returns_split", f"SELECT invoice, {IS_RETURN} AS is_return, count(*) AS n_rows, CAST(sum(quantity) AS BIGINT) AS units FROM ledger GROUP BY 1, 2", "ledger")
sql("clean_price", f"SELECT {LEDGER_OUT} FROM ledger WHERE NOT {IS_RETURN} AND price > 0", "ledger")
sql("line_total", "SELECT invoice, stock_code, quantity, CAST(price AS DOUBLE) AS price, CAST(quantity * price AS DOUBLE) AS line_total FROM ledger", "ledger")
sql("purchases_sorted", f"SELECT {LINES_OUT} FROM purchases ORDER BY invoice_date, invoice, stock_code", "purchases")
cte("tagged", f"""
  SELECT CASE WHEN invoice_date IS NULL OR quantity IS NULL OR price IS NULL THEN 3 WHEN NOT ({NOT_ADMIN}) THEN 4 WHEN NOT {WELL_FORMED} THEN 5
              WHEN customer_id IS NULL THEN 6 WHEN coalesce({IS_RETURN}, true) THEN 7 WHEN price <= 0 THEN 8 ELSE 99 END AS step
  FROM (SELECT DISTINCT * FROM ledger)""", "ledger")
STEPS = ", ".join(f"({i + 1}, '{t}')" for i, t in enumerate(STEP_LABELS))
cte("removals", f"""
  SELECT step_no, step, CASE WHEN step_no = 1 THEN 0 WHEN step_no = 2 THEN (SELECT count(*) FROM ledger) - (SELECT count(*) FROM tagged)
         ELSE (SELECT count(*) FROM tagged t WHERE t.step = step_no) END AS removed
  FROM (VALUES {STEPS}) v(step_no, step)""", "ledger", "tagged")
sql("cleaning_report", """
  SELECT step_no, step, rows_after + removed AS rows_before, rows_after, removed
  FROM (SELECT *, CAST((SELECT count(*) FROM ledger) - sum(removed) OVER (ORDER BY step_no) AS BIGINT) AS rows_after FROM removals)""", "removals", "ledger")
sql("return_features", "SELECT customer_id, n_returns, round(returned_value, 6) AS returned_value FROM rfeat_test", "rfeat_test")
sql("clean_summary", """SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, count(DISTINCT stock_code) AS n_products,
  CAST(min(invoice_date) AS VARCHAR) AS first_date, CAST(max(invoice_date) AS VARCHAR) AS last_date FROM purchases""", "purchases")

# --- temporal ---
sql("cutoffs", "SELECT CAST(last_date AS VARCHAR) AS last_date, CAST(train_cutoff AS VARCHAR) AS train_cutoff, CAST(test_cutoff AS VARCHAR) AS test_cutoff FROM cuts", "cuts")
sql("snapshot_observation", f"SELECT {LINES_OUT} FROM obs_train", "obs_train")
sql("snapshot_future", f"SELECT {LINES_OUT} FROM fut_train", "fut_train")
sql("eligible_customers", "SELECT DISTINCT customer_id FROM obs_train", "obs_train")
sql("snapshot_labels", "SELECT customer_id, repurchased, round(future_spend, 6) AS future_spend FROM labels_train", "labels_train")
for s in ("train", "test"):
    cte(f"summary_{s}", f"""SELECT '{s}' AS snapshot, CAST((SELECT {s}_cutoff FROM cuts) AS VARCHAR) AS cutoff, (SELECT count(*) FROM obs_{s}) AS n_rows,
      count(*) AS n_customers, round(avg(repurchased), 6) AS repurchase_rate FROM labels_{s}""", "cuts", f"obs_{s}", f"labels_{s}")
sql("snapshot_summary", "SELECT * FROM summary_train", "summary_train")
sql("train_test_snapshots", """SELECT 'train' AS snapshot, customer_id, repurchased, round(future_spend, 6) AS future_spend FROM labels_train
  UNION ALL SELECT 'test', customer_id, repurchased, round(future_spend, 6) FROM labels_test""", "labels_train", "labels_test")
sql("population_overlap", """
  SELECT count(*) FILTER (WHERE f < train_cutoff) AS in_both, count(*) FILTER (WHERE f >= train_cutoff AND f < test_cutoff) AS joined_between,
         count(*) FILTER (WHERE f >= test_cutoff) AS first_bought_after
  FROM (SELECT customer_id, min(invoice_date) AS f FROM purchases GROUP BY 1), cuts""", "purchases", "cuts")
cte("timeline", """
  SELECT *, row_number() OVER (PARTITION BY customer_id, period ORDER BY order_date DESC, invoice DESC) AS rn,
         count(*) FILTER (WHERE period = 'past') OVER (PARTITION BY customer_id) AS n_past
  FROM (SELECT customer_id, CAST(invoice_date AS DATE) AS order_date, invoice, CAST(sum(line_total) AS DOUBLE) AS order_value,
               CASE WHEN CAST(invoice_date AS DATE) < train_cutoff THEN 'past' WHEN CAST(invoice_date AS DATE) < train_cutoff + INTERVAL 90 DAY THEN 'label' ELSE 'beyond' END AS period
        FROM purchases, cuts GROUP BY 1, 2, 3, 5)""", "purchases", "cuts")
sql("customer_timeline", """SELECT customer_id, CAST(order_date AS VARCHAR) AS order_date, invoice, round(order_value, 6) AS order_value, period, n_past FROM timeline
  WHERE period <> 'past' OR rn <= 8""", "timeline")
sql("timeline_candidates", """SELECT customer_id, frequency AS n_orders, repurchased, round(future_spend, 6) AS future_spend FROM feat_train
  WHERE frequency BETWEEN 4 AND 12 AND repurchased = 1""", "feat_train")
sql("base_rate_shift", """SELECT snapshot, n_customers, repurchase_rate FROM summary_train
  UNION ALL SELECT snapshot, n_customers, repurchase_rate FROM summary_test""", "summary_train", "summary_test")

# --- features ---
sql("feat_core", "SELECT customer_id, frequency, round(monetary, 6) AS monetary, n_products, n_items, CAST(first_purchase AS VARCHAR) AS first_purchase, CAST(last_purchase AS VARCHAR) AS last_purchase FROM rollup_train", "rollup_train")
sql("feat_recency_tenure", "SELECT customer_id, recency, tenure FROM rollup_train", "rollup_train")
sql("feat_ratios", "SELECT customer_id, round(avg_order_value, 6) AS avg_order_value, round(avg_basket_value, 6) AS avg_basket_value FROM feat_train", "feat_train")
sql("feat_gap", "SELECT customer_id, round(avg_days_between_orders, 6) AS avg_days_between_orders FROM feat_train", "feat_train")
sql("feat_recent", "SELECT customer_id, round(spend_last_90d, 6) AS spend_last_90d, orders_last_90d FROM feat_train", "feat_train")
sql("feat_returns", "SELECT customer_id, n_returns, round(returned_value, 6) AS returned_value FROM feat_train", "feat_train")
sql("customer_features", f"SELECT customer_id, {FEATURES_OUT} FROM feat_train", "feat_train")
sql("feature_label_table", f"SELECT customer_id, {FEATURES_OUT}, repurchased, round(future_spend, 6) AS future_spend FROM feat_train", "feat_train")
sql("feature_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS median, round(CAST(min({c}) AS DOUBLE), 6) AS min,
        round(CAST(max({c}) AS DOUBLE), 6) AS max, count(*) - count({c}) AS n_missing FROM feat_train""" for c in FEATURE_COLUMNS), "feat_train")
sql("target_profile", " UNION ALL ".join(
    f"""SELECT '{s}' AS snapshot, count(*) AS n, round(avg(CAST(future_spend = 0 AS INTEGER)), 6) AS zero_share, round(avg(future_spend), 6) AS mean,
        round(median(future_spend), 6) AS median, round(max(future_spend), 6) AS max, round(skewness(future_spend), 6) AS skew FROM feat_{s}"""
    for s in ("train", "test")), "feat_train", "feat_test")

# --- segmentation ---
cte("scaler", "SELECT " + ", ".join(f"avg(ln(1 + {c})) AS m_{c}, stddev_pop(ln(1 + {c})) AS s_{c}" for c in RFM_COLUMNS) + " FROM feat_train", "feat_train")
for s in ("train", "test"):
    cte(f"z_{s}", "SELECT customer_id, " + ", ".join(f"{c}" for c in RFM_COLUMNS) + ", " + ", ".join(f"(ln(1 + {c}) - m_{c}) / s_{c} AS z_{c}" for c in RFM_COLUMNS)
        + f" FROM feat_{s}, scaler", f"feat_{s}", "scaler")
    dist = [" + ".join(f"(z_{c} - ({v})) * (z_{c} - ({v}))" for c, v in zip(RFM_COLUMNS, cen)) for cen in FIXED_CENTROIDS]
    cte(f"seg_{s}", f"""SELECT *, list_position(d, list_min(d)) - 1 AS segment, sqrt(list_min(d)) AS distance
      FROM (SELECT *, [{", ".join(dist)}] AS d FROM z_{s})""", f"z_{s}")
sql("rfm_prepared", "SELECT customer_id, " + ", ".join(f"round(z_{c}, 6) AS z_{c}" for c in RFM_COLUMNS) + " FROM z_train", "z_train")
sql("scaler_params", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(m_{c}, 6) AS mean, round(s_{c}, 6) AS scale FROM scaler" for c in RFM_COLUMNS), "scaler")
cte("pair_dist", """
  SELECT a.customer_id, a.segment, b.segment AS other,
         sum(sqrt((a.z_recency - b.z_recency) ** 2 + (a.z_frequency - b.z_frequency) ** 2 + (a.z_monetary - b.z_monetary) ** 2)) AS d, count(*) AS n
  FROM seg_train a, seg_train b GROUP BY 1, 2, 3""", "seg_train")
sql("silhouette", """
  SELECT 'euclidean' AS metric, round(avg(CASE WHEN own_n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM (
    SELECT customer_id, max(CASE WHEN segment = other THEN n END) AS own_n, max(CASE WHEN segment = other AND n > 1 THEN d / (n - 1) END) AS a,
           min(CASE WHEN segment <> other THEN d / n END) AS b FROM pair_dist GROUP BY 1)""", "pair_dist")
cte("profile", """
  SELECT CAST(segment AS INTEGER) AS segment, count(*) AS customers, CAST(median(recency) AS DOUBLE) AS median_recency, CAST(median(frequency) AS DOUBLE) AS median_frequency,
         median(monetary) AS median_monetary, sum(monetary) AS total_revenue FROM seg_train GROUP BY 1""", "seg_train")
sql("segment_profile", """
  SELECT segment, customers, round(median_recency, 2) AS median_recency, round(median_frequency, 2) AS median_frequency,
         round(median_monetary, 2) AS median_monetary, round(total_revenue, 2) AS total_revenue,
         round_even(100.0 * customers / sum(customers) OVER (), 1) AS pct_customers, round_even(100 * total_revenue / sum(total_revenue) OVER (), 1) AS pct_revenue
  FROM profile""", "profile")


def tied(column: str, direction: str) -> str:
    return f"rank() OVER (ORDER BY {column} {direction}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0"


cte("named", f"""
  SELECT segment, CASE WHEN recent AND valuable AND frequent THEN 'Champions' WHEN recent AND NOT valuable THEN 'New / Low-value'
                       WHEN NOT recent AND valuable THEN 'At-risk high-value' ELSE 'Lapsed / One-off' END AS segment_name
  FROM (SELECT segment, {tied("median_recency", "ASC")} <= count(*) OVER () / 2.0 AS recent, {tied("median_monetary", "DESC")} <= count(*) OVER () / 2.0 AS valuable,
               {tied("median_frequency", "DESC")} <= count(*) OVER () / 2.0 AS frequent FROM profile)""", "profile")
sql("segment_names", "SELECT segment, segment_name FROM named", "named")


def bucket(rn: str, n: str, k: int) -> str:
    return f"greatest(1, (({rn} - 1) * {k} + {n} - 2) // greatest({n} - 1, 1))"


def value_score(c: str) -> str:
    return f"CASE WHEN {c} <= e_{c}[2] THEN 1 WHEN {c} <= e_{c}[3] THEN 2 WHEN {c} <= e_{c}[4] THEN 3 WHEN {c} <= e_{c}[5] THEN 4 ELSE 5 END"


cte("quint", f"""
  SELECT customer_id, CAST(6 - ({value_score("recency")}) AS INTEGER) AS r_score,
         CAST({bucket("row_number() OVER (ORDER BY frequency, first_purchase, customer_id)", "count(*) OVER ()", 5)} AS INTEGER) AS f_score,
         CAST({value_score("monetary")} AS INTEGER) AS m_score
  FROM feat_train, (SELECT quantile_cont(CAST(recency AS DOUBLE), [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e_recency,
                           quantile_cont(monetary, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e_monetary FROM feat_train)""", "feat_train")
sql("rfm_quintiles", "SELECT *, r_score + f_score + m_score AS rfm_score FROM quint", "quint")
cte("named_customers", """SELECT customer_id, CAST(s.segment AS INTEGER) AS segment, segment_name, r_score + f_score + m_score AS rfm_score
  FROM seg_train s JOIN named n ON n.segment = s.segment JOIN quint USING (customer_id)""", "seg_train", "named", "quint")
sql("segment_crosstab", "SELECT segment_name, " + ", ".join(f"count(*) FILTER (WHERE rfm_score = {s}) AS score_{s}" for s in SCORE_RANGE)
    + " FROM named_customers GROUP BY 1", "named_customers")
sql("segment_score_summary", """SELECT segment_name, count(*) AS customers, round(avg(rfm_score), 6) AS mean_score, min(rfm_score) AS min_score,
  max(rfm_score) AS max_score FROM named_customers GROUP BY 1""", "named_customers")
sql("ambiguous_middle", """
  SELECT rfm_score, customers, n_segments, round(sum(CASE WHEN rfm_score BETWEEN 9 AND 13 THEN customers ELSE 0 END) OVER () / sum(customers) OVER (), 6) AS middle_share
  FROM (SELECT rfm_score, count(*) AS customers, count(DISTINCT segment) AS n_segments FROM named_customers GROUP BY 1)""", "named_customers")
NAME_LIST = "[" + ", ".join(f"'{n}'" for n in FIXED_NAMES) + "]"
GUIDE = "CASE segment_name " + " ".join(f"WHEN '{n}' THEN '{t}'" for n, t in GUIDANCE.items()) + " END"
cte("assigned", f"""
  SELECT customer_id, segment_id, segment_name, distance_to_centroid, {GUIDE} AS interpretation, recency, frequency, monetary FROM (
    SELECT customer_id, CAST(segment AS INTEGER) AS segment_id, {NAME_LIST}[CAST(segment AS INTEGER) + 1] AS segment_name, round(distance, 4) AS distance_to_centroid,
           CAST(recency AS DOUBLE) AS recency, CAST(frequency AS DOUBLE) AS frequency, round(monetary, 2) AS monetary FROM seg_test)""", "seg_test")
sql("segment_assign", "SELECT * REPLACE (CAST(segment_id AS DOUBLE) AS segment_id) FROM assigned", "assigned")
sql("segment_known", "SELECT c_custkey AS customer_id, a.* EXCLUDE (customer_id) REPLACE (CAST(a.segment_id AS DOUBLE) AS segment_id), a.segment_id IS NOT NULL AS found FROM customer LEFT JOIN assigned a ON a.customer_id = c_custkey", "assigned")
cte("requests", """
  SELECT customer_id, CASE WHEN customer_id % 10 = 1 THEN NULL WHEN customer_id % 10 = 2 THEN -5.0 ELSE CAST(recency AS DOUBLE) END AS recency,
         CASE WHEN customer_id % 10 = 3 THEN 0.0 ELSE CAST(frequency AS DOUBLE) END AS frequency,
         CASE WHEN customer_id % 10 <> 4 THEN CAST(n_items AS DOUBLE) END AS monetary FROM feat_test""", "feat_test")
REASON = """CASE WHEN recency IS NULL THEN 'recency is not a number' WHEN frequency IS NULL THEN 'frequency is not a number'
  WHEN monetary IS NULL THEN 'monetary is not a number' WHEN recency < 0 THEN 'recency must be >= 0' WHEN frequency <= 0 THEN 'frequency must be > 0'
  WHEN monetary <= 0 THEN 'monetary must be > 0' END"""
sql("rfm_validate", f"SELECT *, {REASON} AS rejected_because FROM requests", "requests")
rdist = [" + ".join(f"((ln(1 + {c}) - m_{c}) / s_{c} - ({v})) ** 2" for c, v in zip(RFM_COLUMNS, cen)) for cen in FIXED_CENTROIDS]
sql("segment_requests", f"""
  SELECT customer_id, recency, frequency, monetary, rejected_because, CAST(sid AS DOUBLE) AS segment_id, {NAME_LIST}[sid + 1] AS segment_name,
         distance_to_centroid, CASE WHEN sid IS NOT NULL THEN {GUIDE.replace("segment_name", NAME_LIST + "[sid + 1]")} END AS interpretation
  FROM (SELECT *, CASE WHEN rejected_because IS NULL THEN CAST(list_position(d, list_min(d)) - 1 AS INTEGER) END AS sid,
               CASE WHEN rejected_because IS NULL THEN round(sqrt(list_min(d)), 4) END AS distance_to_centroid
        FROM (SELECT r.*, {REASON} AS rejected_because, CASE WHEN recency >= 0 AND frequency > 0 AND monetary > 0 THEN [{", ".join(rdist)}] END AS d FROM requests r, scaler))""",
    "requests", "scaler")

# --- repurchase ---
cte("scored_p", "SELECT customer_id, y, CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + recency / CAST(90.0 AS DOUBLE)) AS p FROM (SELECT customer_id, repurchased AS y, recency FROM feat_test)", "feat_test")
cte("feat_rule", "SELECT customer_id, repurchased AS y, -CAST(recency AS DOUBLE) AS p FROM feat_test", "feat_test")
for tag, src in (("p", "scored_p"), ("r", "feat_rule")):
    cte(f"thr_{tag}", f"""
      SELECT p, sum(y) AS pos, count(*) AS ties, sum(sum(y)) OVER (ORDER BY p DESC) AS tp, sum(count(*)) OVER (ORDER BY p DESC) AS flagged,
             sum(sum(y)) OVER () AS n_pos, sum(count(*)) OVER () AS n FROM {src} GROUP BY p""", src)
    cte(f"cls_{tag}", f"""
      SELECT (SELECT sum(CAST(pos AS DOUBLE) / n_pos * (CAST(tp AS DOUBLE) / flagged)) FROM thr_{tag}) AS pr_auc,
             (SELECT sum(CAST(pos AS DOUBLE) * ((n - flagged) - (n_pos - tp) + (ties - pos) / 2.0)) / max(CAST(n_pos AS DOUBLE) * (n - n_pos)) FROM thr_{tag}) AS roc_auc,
             CASE WHEN min(p) >= 0 AND max(p) <= 1 THEN avg((p - y) ** 2) END AS brier, avg(y) AS base_rate,
             CASE WHEN min(p) >= 0 AND max(p) <= 1 THEN avg(p) END AS mean_predicted FROM {src}""", f"thr_{tag}", src)
sql("average_precision", "SELECT round(pr_auc, 6) AS average_precision FROM cls_p", "cls_p")
sql("roc_auc", "SELECT round(roc_auc, 6) AS roc_auc FROM cls_p", "cls_p")
sql("brier", "SELECT round(brier, 6) AS brier FROM cls_p", "cls_p")
sql("base_and_mean", "SELECT round(base_rate, 6) AS base_rate, round(mean_predicted, 6) AS mean_predicted FROM cls_p", "cls_p")
CLS = "round_even(pr_auc / base_rate, 2) AS vs_base, round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc, round(brier, 6) AS brier, round(base_rate, 6) AS base_rate, round(mean_predicted, 6) AS mean_predicted"
sql("classification_metrics", f"SELECT 'inverse recency' AS contender, {CLS} FROM cls_p UNION ALL SELECT 'recency rule', {CLS} FROM cls_r", "cls_p", "cls_r")
cte("lift_rows", f"""SELECT y, p, CAST({bucket("row_number() OVER (ORDER BY p DESC, customer_id)", "count(*) OVER ()", 10)} AS INTEGER) AS decile FROM scored_p""", "scored_p")
sql("lift_table", """
  SELECT decile, customers, round(actual_rate, 6) AS actual_rate, round(mean_predicted, 6) AS mean_predicted, repurchasers,
         round(actual_rate / (sum(repurchasers) OVER () / sum(customers) OVER ()), 6) AS lift,
         round(sum(repurchasers) OVER (ORDER BY decile) / sum(repurchasers) OVER (), 6) AS cumulative_capture
  FROM (SELECT decile, count(*) AS customers, avg(y) AS actual_rate, avg(p) AS mean_predicted, CAST(sum(y) AS BIGINT) AS repurchasers FROM lift_rows GROUP BY 1)""", "lift_rows")
sql("baseline_recency", "SELECT customer_id, p FROM feat_rule", "feat_rule")


def hashed(buckets: int, seed: int = 42) -> str:
    return f"CAST(('0x' || substr(md5(customer_id || ':{seed}'), 1, 8))::BIGINT % {buckets} AS INTEGER)"


sql("holdout_split", f"""SELECT repurchased, {hashed(100)} < 20 AS is_val, count(*) AS customers, min(customer_id) AS first_id, CAST(sum(customer_id) AS BIGINT) AS id_sum
  FROM feat_train GROUP BY 1, 2""", "feat_train")
sql("calibration_halves", f"SELECT customer_id, {hashed(2)} = 0 AS is_reference FROM feat_test", "feat_test")
EFFECTS = " UNION ALL ".join(
    f"""SELECT customer_id, {i} AS position, '{c}' AS feature, CAST(round(CAST({c} AS DECIMAL(18,6)), 2) AS DOUBLE) AS value,
        (coalesce(CAST({c} AS DOUBLE), CAST({m} AS DOUBLE)) - CAST({m} AS DOUBLE)) / CAST({s} AS DOUBLE) AS effect FROM feat_test"""
    for i, (c, m, s) in enumerate(zip(FEATURE_COLUMNS, EFFECT_CENTRES, EFFECT_SCALES)))
cte("effects", EFFECTS, "feat_test")
sql("top_drivers", """
  SELECT customer_id, CAST(rank AS INTEGER) AS rank, feature, value, round(effect, 4) AS effect_log_odds, CASE WHEN effect > 0 THEN 'raises' ELSE 'lowers' END AS direction
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(effect) DESC, position) AS rank FROM effects) WHERE rank <= 5""", "effects")
sql("score_decile", """SELECT customer_id, round(p, 6) AS p, CAST(least(10, 1 + ((rank() OVER (ORDER BY p DESC) - 1) * 10) // count(*) OVER ()) AS INTEGER) AS decile
  FROM scored_p""", "scored_p")

# --- value ---
for s in ("train", "test"):
    cte(f"bg_{s}", f"SELECT customer_id, CAST(frequency - 1 AS DOUBLE) AS x, CAST(tenure - recency AS DOUBLE) AS t_x, CAST(tenure AS DOUBLE) AS t_total FROM rollup_{s}", f"rollup_{s}")
    cte(f"repeat_{s}", f"""
      SELECT customer_id, CAST(sum(value) FILTER (WHERE seq > 1) AS DOUBLE) / (count(*) - 1) AS repeat_value
      FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY placed, invoice) AS seq
            FROM (SELECT customer_id, invoice, sum(line_total) AS value, min(invoice_date) AS placed FROM obs_{s} GROUP BY 1, 2))
      GROUP BY 1 HAVING count(*) > 1""", f"obs_{s}")
sql("bgnbd_input", "SELECT * FROM bg_train", "bg_train")
sql("bgnbd_input_violations", "SELECT count(*) AS customers, count(*) FILTER (WHERE t_x > t_total) AS recency_after_end, count(*) FILTER (WHERE x < 0) AS negative_frequency FROM bg_train", "bg_train")
sql("repeat_order_value", "SELECT customer_id, round(repeat_value, 6) AS repeat_value FROM repeat_train", "repeat_train")
B, G = FIXED_BUYING, FIXED_SPENDING
cte("hyp", f"""
  SELECT x, t_total, 1 + sum(term) AS hyp FROM (
    SELECT x, t_total, product(({B.r} + x + n) * ({B.b} + x + n) / (({B.a + B.b - 1} + x + n) * (n + 1)) * (90.0 / ({B.alpha} + t_total + 90.0)))
             OVER (PARTITION BY x, t_total ORDER BY n) AS term
    FROM (SELECT DISTINCT x, t_total FROM bg_test), (SELECT CAST(range AS DOUBLE) AS n FROM range(400))) GROUP BY 1, 2""", "bg_test")
GONE = f"(CASE WHEN x > 0 THEN {B.a} / ({B.b - 1} + x) * pow(({B.alpha} + t_total) / ({B.alpha} + t_x), {B.r} + x) ELSE 0 END)"
cte("expected", f"""
  SELECT customer_id, x, t_x, t_total, direct, CASE WHEN hyp > 0 THEN direct END AS expected FROM (
    SELECT *, ({B.a + B.b - 1} + x) / {B.a - 1} * (1 - hyp * pow(({B.alpha} + t_total) / ({B.alpha} + t_total + 90.0), {B.r} + x)) / (1 + {GONE}) AS direct
    FROM bg_test JOIN hyp USING (x, t_total))""", "bg_test", "hyp")
sql("expected_purchases", "SELECT customer_id, round(direct, 6) AS direct_purchases, round(expected, 6) AS expected_purchases FROM expected", "expected")
cte("filled", """SELECT *, coalesce(expected, (SELECT coalesce(median(expected) FILTER (WHERE x = 0), median(expected)) FROM expected)) AS filled FROM expected""", "expected")
sql("undefined_fill", "SELECT customer_id, round(filled, 6) AS expected_purchases, expected IS NULL AS was_undefined FROM filled", "filled")
WEIGHT = f"({G.p} * x / ({G.p} * x + {G.q - 1}))"
cte("order_value", f"""SELECT customer_id, (1 - {WEIGHT}) * {G.population_mean} + {WEIGHT} * coalesce(repeat_value, 0) AS expected_value
  FROM bg_test LEFT JOIN repeat_test USING (customer_id)""", "bg_test", "repeat_test")
sql("expected_order_value", "SELECT customer_id, round(expected_value, 6) AS expected_value FROM order_value", "order_value")
sql("clv_prediction_fixed", "SELECT customer_id, round(filled * expected_value, 4) AS p FROM filled JOIN order_value USING (customer_id)", "filled", "order_value")
cte("alive", f"SELECT customer_id, CASE WHEN x = 0 THEN 1.0 ELSE 1 / (1 + {GONE}) END AS p_alive FROM bg_test", "bg_test")
sql("p_alive", "SELECT customer_id, round(p_alive, 6) AS p_alive FROM alive", "alive")
sql("p_alive_summary", "SELECT round(avg(p_alive), 6) AS mean_p_alive, count(*) FILTER (WHERE p_alive < 0.2) AS below_0_2 FROM alive", "alive")
sql("bgnbd_coverage", """SELECT count(*) AS n, count(*) - count(expected) AS undefined, round_even(100.0 * (count(*) - count(expected)) / count(*), 1) AS pct_undefined,
  coalesce(bool_and(x = 0) FILTER (WHERE expected IS NULL), true) AS all_undefined_are_never_repeated FROM expected""", "expected")
sql("baseline_mean", "SELECT customer_id, round((SELECT avg(future_spend) FROM feat_train), 6) AS p FROM feat_test", "feat_test", "feat_train")
sql("baseline_last90", "SELECT customer_id, round(spend_last_90d, 6) AS p FROM feat_test", "feat_test")
cte("valued", "SELECT customer_id, future_spend AS y, spend_last_90d * 0.5 + avg_order_value * 0.25 AS p FROM feat_test", "feat_test")


def average_rank(c: str) -> str:
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


sql("regression_metrics", f"""
  SELECT round(avg(abs(y - p)), 5) AS mae, round(sqrt(avg((y - p) ** 2)), 5) AS rmse, round(1 - avg((y - p) ** 2) / var_pop(y), 5) AS r2,
         round(CASE WHEN max(p) > min(p) THEN corr(ry, rp) END, 5) AS spearman, round(avg(p), 5) AS mean_pred, round(avg(y), 5) AS mean_actual
  FROM (SELECT *, {average_rank("y")} AS ry, {average_rank("p")} AS rp FROM valued)""", "valued")
sql("value_decile_table", f"""
  SELECT decile, customers, round(predicted, 4) AS predicted, round(actual, 4) AS actual, round(actual_total, 4) AS actual_total,
         round_even(100 * actual_total / sum(actual_total) OVER (), 1) AS share_of_revenue
  FROM (SELECT decile, count(*) AS customers, avg(p) AS predicted, avg(y) AS actual, sum(y) AS actual_total
        FROM (SELECT y, p, CAST({bucket("row_number() OVER (ORDER BY p DESC, customer_id)", "count(*) OVER ()", 10)} AS INTEGER) AS decile FROM valued) GROUP BY 1)""", "valued")
sql("value_decile", """SELECT customer_id, CAST(least(10, greatest(1, 1 + ((count(*) OVER () - rank() OVER (ORDER BY p)) * 10) // count(*) OVER ())) AS INTEGER) AS value_decile
  FROM valued""", "valued")
sql("independence_check", f"""SELECT round(s, 6) AS spearman, abs(s) < 0.3 AS is_small FROM (SELECT corr(a, b) AS s FROM (
  SELECT {average_rank("frequency")} AS a, {average_rank("avg_order_value")} AS b FROM feat_train WHERE frequency > 1))""", "feat_train")
sql("gg_population_mean", f"SELECT round({G.population_mean}, 6) AS model_mean, round(avg(repeat_value), 6) AS empirical_mean FROM repeat_train", "repeat_train")

# --- recommender ---
cte("items", """SELECT CAST(row_number() OVER (ORDER BY n_lines DESC, stock_code) - 1 AS INTEGER) AS item_idx, stock_code, n_lines
  FROM (SELECT stock_code, count(*) AS n_lines FROM obs_train GROUP BY 1 HAVING count(*) >= 5)""", "obs_train")
for s in ("train", "test"):
    cte(f"w_{s}", f"""SELECT customer_id, item_idx, sum(pow(0.5, datesub('day', invoice_date, cutoff) / CAST(90.0 AS DOUBLE))) AS weight, count(*) AS lines_bought
      FROM obs_{s} JOIN items USING (stock_code) GROUP BY 1, 2""", f"obs_{s}", "items")
    cte(f"stats_{s}", f"""
      SELECT item_idx, i.stock_code, coalesce(CAST(sum(quantity) AS BIGINT), 0) AS units, count(DISTINCT customer_id) AS buyers, count(DISTINCT invoice) AS baskets,
             coalesce(median(CAST(price AS DOUBLE)), 0.0) AS price, ln(1 + coalesce(sum(quantity), 0)) AS log_units, ln(1 + count(DISTINCT customer_id)) AS log_buyers
      FROM items i LEFT JOIN obs_{s} o ON o.stock_code = i.stock_code GROUP BY 1, 2""", "items", f"obs_{s}")
    cte(f"truth_{s}", f"SELECT DISTINCT customer_id, item_idx FROM fut_{s} JOIN items USING (stock_code)", f"fut_{s}", "items")
cte("pop", "SELECT item_idx, row_number() OVER (ORDER BY units DESC, item_idx) AS rank FROM stats_test", "stats_test")
cte("vec", """SELECT item_idx, list_transform(v, lambda x: x / CASE WHEN n = 0 THEN 1 ELSE n END) AS v FROM (
  SELECT item_idx, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
  FROM items JOIN embeddings ON vec_id = item_idx % (SELECT count(*) FROM embeddings))""", "items")
cte("cvec", """
  SELECT customer_id, list_transform(v, lambda x: x / CASE WHEN n = 0 THEN 1 ELSE n END) AS v FROM (
    SELECT customer_id, v, sqrt(list_inner_product(v, v)) AS n FROM (
      SELECT customer_id, list(s ORDER BY pos) AS v FROM (
        SELECT customer_id, pos, sum(weight * v[pos]) AS s FROM w_test JOIN vec USING (item_idx), (SELECT CAST(range AS INTEGER) AS pos FROM range(1, 65)) GROUP BY 1, 2) GROUP BY 1))""", "w_test", "vec")
cte("retrieved", """
  SELECT customer_id, item_idx, similarity, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY similarity DESC, item_idx) AS rank FROM (
      SELECT customer_id, item_idx, round(list_inner_product(cvec.v, vec.v), 9) AS similarity FROM cvec, vec)) WHERE rank <= 200""", "cvec", "vec")
cte("cop", """
  SELECT a.item_idx AS item_i, b.item_idx AS item_j, count(*) AS n_baskets
  FROM (SELECT DISTINCT invoice, item_idx FROM obs_train JOIN items USING (stock_code)) a
  JOIN (SELECT DISTINCT invoice, item_idx FROM obs_train JOIN items USING (stock_code)) b ON a.invoice = b.invoice AND a.item_idx < b.item_idx GROUP BY 1, 2""", "obs_train", "items")
cte("cand", """
  SELECT customer_id, item_idx, max(r) AS from_retrieval, max(o) AS from_history, max(t) AS from_popular, coalesce(max(weight), 0.0) AS weight_before, coalesce(max(n), 0) AS lines_bought_before
  FROM (SELECT customer_id, item_idx, 1 AS r, 0 AS o, 0 AS t, CAST(NULL AS DOUBLE) AS weight, CAST(NULL AS BIGINT) AS n FROM retrieved
        UNION ALL SELECT customer_id, item_idx, 0, 1, 0, weight, lines_bought FROM w_test
        UNION ALL SELECT customer_id, item_idx, 0, 0, 1, NULL, NULL FROM (SELECT DISTINCT customer_id FROM w_test), pop WHERE rank <= 50) GROUP BY 1, 2""", "retrieved", "w_test", "pop")
cte("co_score", """
  SELECT customer_id, j AS item_idx, CAST(sum(n_baskets) AS BIGINT) AS score
  FROM w_test JOIN (SELECT item_i AS i, item_j AS j, n_baskets FROM cop UNION ALL SELECT item_j, item_i, n_baskets FROM cop) ON i = item_idx GROUP BY 1, 2""", "w_test", "cop")
cte("cand_sim", """
  SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY emb_similarity DESC, item_idx) AS INTEGER) AS emb_rank FROM (
    SELECT cand.*, round(list_inner_product(cvec.v, vec.v), 9) AS emb_similarity FROM cand JOIN cvec USING (customer_id) JOIN vec USING (item_idx))""", "cand", "cvec", "vec")
cte("cand_co", """
  SELECT cand.*, ln(1 + coalesce(score, 0)) AS copurchase, CAST(row_number() OVER (PARTITION BY cand.customer_id ORDER BY coalesce(score, 0) DESC, cand.item_idx) AS INTEGER) AS copurchase_rank
  FROM cand LEFT JOIN co_score USING (customer_id, item_idx)""", "cand", "co_score")
cte("cust_price", "SELECT customer_id, greatest(sum(weight * price) / greatest(sum(weight), 1e-9), 1e-9) AS avg_price FROM w_test JOIN stats_test USING (item_idx) GROUP BY 1", "w_test", "stats_test")

sql("baskets", "SELECT invoice, stock_code, count(*) AS times_in_basket FROM obs_train GROUP BY 1, 2", "obs_train")
sql("corpus_stats", """
  SELECT count(*) AS n_baskets, (SELECT count(DISTINCT stock_code) FROM obs_train) AS n_products, (SELECT count(*) FROM items) AS n_with_vector, round(avg(n), 6) AS mean_size,
         max(n) AS max_size, round(avg(CAST(n >= 2 AS INTEGER)), 6) AS share_two_plus,
         round((SELECT sum(u) FROM (SELECT sum(quantity) AS u FROM obs_train GROUP BY stock_code ORDER BY u DESC, stock_code LIMIT 100)) / (SELECT sum(quantity) FROM obs_train), 6) AS top_100_unit_share,
         round(100.0 * (SELECT count(*) FROM items) / (SELECT count(DISTINCT stock_code) FROM obs_train), 6) AS coverage_pct
  FROM (SELECT invoice, count(*) AS n FROM obs_train GROUP BY 1)""", "obs_train", "items")
sql("item_vectors", """SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(v[pos] / n, 6) AS value
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings), range(1, 65) r(pos)""")
sql("item_index", "SELECT item_idx, stock_code, n_lines FROM items", "items")
sql("purchase_weights", "SELECT customer_id, item_idx, CASE WHEN weight > 0 THEN round(log10(weight), 8) ELSE 0.0 END AS weight, lines_bought FROM w_test", "w_test")
sql("customer_vectors", "SELECT customer_id, CAST(pos - 1 AS INTEGER) AS pos, round(v[pos], 6) AS value FROM cvec, range(1, 65) r(pos)", "cvec")
sql("retrieve_top_n", "SELECT customer_id, item_idx, similarity, CAST(rank AS INTEGER) AS rank FROM retrieved", "retrieved")
sql("item_stats", "SELECT item_idx, stock_code, units, buyers, baskets, round(price, 6) AS price, round(log_units, 6) AS log_units, round(log_buyers, 6) AS log_buyers FROM stats_test", "stats_test")
sql("popularity_order", "SELECT item_idx, rank FROM pop", "pop")
sql("copurchase", "SELECT item_i, item_j, n_baskets FROM cop", "cop")
sql("owned_copurchase", """SELECT customer_id, count(*) AS n_items, CAST(sum(score) AS BIGINT) AS score_sum, max(score) AS score_max,
  CAST(sum(score * item_idx) AS BIGINT) AS weighted_sum FROM co_score GROUP BY 1""", "co_score")
sql("candidates", "SELECT customer_id, item_idx, from_retrieval, from_history, from_popular FROM cand", "cand")
sql("cand_emb_similarity", "SELECT customer_id, item_idx, emb_similarity FROM cand_sim", "cand_sim")
sql("cand_emb_rank", "SELECT customer_id, item_idx, emb_rank FROM cand_sim", "cand_sim")
sql("cand_popularity", "SELECT customer_id, item_idx, round(log_units, 6) AS log_units, round(log_buyers, 6) AS log_buyers, round(price, 6) AS price FROM cand JOIN stats_test USING (item_idx)", "cand", "stats_test")
HIST = "CAST(lines_bought_before > 0 AS INTEGER) AS bought_before, CAST(lines_bought_before > 0 AS INTEGER) AS times_bought_before"
sql("cand_history", f"SELECT customer_id, item_idx, CASE WHEN weight_before > 0 THEN round(log10(weight_before), 8) ELSE 0.0 END AS weight_before, {HIST}, lines_bought_before FROM cand", "cand")
sql("cand_copurchase", "SELECT customer_id, item_idx, round(copurchase, 6) AS copurchase FROM cand_co", "cand_co")
sql("cand_copurchase_rank", "SELECT customer_id, item_idx, copurchase_rank FROM cand_co", "cand_co")
sql("cand_price_fit", "SELECT customer_id, item_idx, round(price / avg_price, 6) AS price_vs_customer_avg FROM cand JOIN stats_test USING (item_idx) JOIN cust_price USING (customer_id)", "cand", "stats_test", "cust_price")
sql("cand_customer_context", "SELECT customer_id, item_idx, frequency AS cust_frequency, recency AS cust_recency FROM cand JOIN feat_test USING (customer_id)", "cand", "feat_test")
sql("candidate_features", f"""
  SELECT customer_id, item_idx, emb_similarity, emb_rank, round(log_units, 9) AS log_units, round(log_buyers, 9) AS log_buyers, round(price, 9) AS price,
         {HIST.replace("lines_bought_before", "s.lines_bought_before")}, CASE WHEN s.weight_before > 0 THEN round(log10(s.weight_before), 8) ELSE 0.0 END AS weight_before, round(copurchase, 9) AS copurchase, copurchase_rank,
         round(price / avg_price, 9) AS price_vs_customer_avg, frequency AS cust_frequency, recency AS cust_recency
  FROM cand_sim s JOIN cand_co c USING (customer_id, item_idx) JOIN stats_test USING (item_idx) JOIN cust_price USING (customer_id) JOIN feat_test USING (customer_id)""",
    "cand_sim", "cand_co", "stats_test", "cust_price", "feat_test")
cte("labelled", """SELECT c.customer_id, c.item_idx, CAST(t.customer_id IS NOT NULL AS INTEGER) AS label
  FROM cand c LEFT JOIN truth_test t ON t.customer_id = c.customer_id AND t.item_idx = c.item_idx""", "cand", "truth_test")
sql("candidate_labels", "SELECT customer_id, item_idx, label FROM labelled", "labelled")
sql("candidate_balance", """SELECT 'test' AS snapshot, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, CAST(sum(label) AS BIGINT) AS positives,
  round(100.0 * sum(label) / count(*), 6) AS positive_pct FROM labelled""", "labelled")
sql("group_split", f"SELECT customer_id, {hashed(100)} < 20 AS is_val FROM (SELECT DISTINCT customer_id FROM w_train)", "w_train")
sql("group_sizes", "SELECT customer_id, count(*) AS n_candidates FROM cand GROUP BY 1", "cand")
cte("fixed_top", """
  SELECT customer_id, item_idx, rank FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, item_idx) AS rank FROM (
    SELECT customer_id, item_idx, weight_before * 2 + from_popular * CAST(0.3 AS DOUBLE) + from_retrieval * CAST(0.2 AS DOUBLE) + CAST(1.0 AS DOUBLE) / (1 + item_idx) AS score FROM cand)) WHERE rank <= 12""", "cand")
sql("top_k", "SELECT customer_id, item_idx, CAST(rank AS INTEGER) AS rank FROM fixed_top", "fixed_top")
sql("truth_pairs", "SELECT customer_id, item_idx FROM truth_test", "truth_test")
sql("owned_pairs", "SELECT customer_id, item_idx FROM w_test", "w_test")
cte("r_repeat", """SELECT customer_id, item_idx, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY round(log10(weight), 10) DESC, item_idx) AS rank FROM w_test) WHERE rank <= 12""", "w_test")
cte("r_stage1", "SELECT customer_id, item_idx, CAST(rank AS INTEGER) AS rank FROM retrieved WHERE rank <= 12", "retrieved")
cte("pop_all", "SELECT customer_id, item_idx, rank FROM (SELECT DISTINCT customer_id FROM w_test), pop WHERE rank <= 200", "w_test", "pop")
cte("r_popular", "SELECT customer_id, item_idx, CAST(rank AS INTEGER) AS rank FROM pop_all WHERE rank <= 12", "pop_all")
for name, source in (("popular_new", "pop_all"), ("stage1_new", "retrieved")):
    cte(f"r_{name}", f"""
      SELECT customer_id, item_idx, CAST(rn AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY rank) AS rn FROM (
          SELECT s.customer_id, s.item_idx, s.rank FROM {source} s ANTI JOIN w_test w ON w.customer_id = s.customer_id AND w.item_idx = s.item_idx)) WHERE rn <= 12""", source, "w_test")
for name, extra in (("cop", ""), ("cop_new", "ANTI JOIN w_test w ON w.customer_id = c.customer_id AND w.item_idx = i.item_idx")):
    cte(f"r_{name}", f"""
      SELECT customer_id, item_idx, CAST(rank AS INTEGER) AS rank FROM (
        SELECT customer_id, item_idx, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, item_idx) AS rank FROM (
          SELECT a.customer_id, a.item_idx, coalesce(s.score, 0) AS score
          FROM (SELECT c.customer_id, i.item_idx FROM (SELECT DISTINCT customer_id FROM w_test) c CROSS JOIN items i {extra}) a
          LEFT JOIN co_score s ON s.customer_id = a.customer_id AND s.item_idx = a.item_idx)) WHERE rank <= 12""", "w_test", "items", "co_score")
cte("truth_fresh", "SELECT t.customer_id, t.item_idx FROM truth_test t ANTI JOIN w_test w ON w.customer_id = t.customer_id AND w.item_idx = t.item_idx", "truth_test", "w_test")
cte("r_none", "SELECT customer_id, item_idx, rank FROM r_repeat WHERE false", "r_repeat")


def rank_sql(recs: str, truth: str) -> str:
    return f"""
      SELECT round(avg(hits / n_truth), 6) AS recall, round(avg(hits / CAST(12.0 AS DOUBLE)), 6) AS precision, round(avg(ap / least(n_truth, 12)), 6) AS map,
             round(avg(dcg / ideal), 6) AS ndcg, count(*) AS customers_scored
      FROM (SELECT t.customer_id, n_truth, coalesce(hits, 0) AS hits, coalesce(ap, 0.0) AS ap, coalesce(dcg, 0.0) AS dcg,
                   list_sum(list_transform(range(1, CAST(least(n_truth, 12) AS BIGINT) + 1), lambda i: 1 / log2(i + 1))) AS ideal
            FROM (SELECT customer_id, count(*) AS n_truth FROM {truth} GROUP BY 1) t
            LEFT JOIN (SELECT customer_id, count(*) AS hits, sum(nth / rank) AS ap, sum(1 / log2(rank + 1)) AS dcg
                       FROM (SELECT r.customer_id, r.rank, row_number() OVER (PARTITION BY r.customer_id ORDER BY r.rank) AS nth
                             FROM {recs} r JOIN {truth} x ON x.customer_id = r.customer_id AND x.item_idx = r.item_idx) GROUP BY 1) h ON h.customer_id = t.customer_id)"""


sql("rank_metrics", rank_sql("r_repeat", "truth_test"), "r_repeat", "truth_test")
METHODS = [("all items", "most popular", "r_popular", "truth_test"), ("all items", "co-purchase", "r_cop", "truth_test"),
           ("all items", "repeat what they bought", "r_repeat", "truth_test"), ("all items", "stage 1 only", "r_stage1", "truth_test"),
           ("new items", "most popular", "r_popular_new", "truth_fresh"), ("new items", "co-purchase", "r_cop_new", "truth_fresh"),
           ("new items", "repeat what they bought", "r_none", "truth_fresh"), ("new items", "stage 1 only", "r_stage1_new", "truth_fresh")]
sql("reco_baselines", " UNION ALL ".join(f"SELECT '{a}' AS scope, '{b}' AS contender, * FROM ({rank_sql(r, t)})" for a, b, r, t in METHODS),
    *{m[2] for m in METHODS}, "truth_test", "truth_fresh")
COVER = """SELECT round(avg(share), 6) AS recall, count(*) AS customers_scored FROM (
  SELECT t.customer_id, avg(CAST(f.customer_id IS NOT NULL AS INTEGER)) AS share FROM truth_test t {known} LEFT JOIN {found} f ON f.customer_id = t.customer_id AND f.item_idx = t.item_idx GROUP BY 1)"""
sql("retrieval_recall", COVER.format(known="SEMI JOIN w_test w ON w.customer_id = t.customer_id", found="retrieved"), "truth_test", "w_test", "retrieved")
sql("candidate_ceiling", COVER.format(known="", found="cand"), "truth_test", "cand")
sql("baseline_popular", "SELECT * FROM r_popular", "r_popular")
sql("baseline_repeat", "SELECT * FROM r_repeat", "r_repeat")
sql("baseline_copurchase", "SELECT *, false AS excludes_own FROM r_cop UNION ALL SELECT *, true FROM r_cop_new", "r_cop", "r_cop_new")
sql("baseline_stage1", "SELECT * FROM r_stage1", "r_stage1")
sql("truth_new", "SELECT * FROM truth_fresh", "truth_fresh")
sql("recs_new_only", "SELECT * FROM r_popular_new", "r_popular_new")
sql("candidates_fresh", "SELECT customer_id, item_idx FROM cand WHERE weight_before = 0", "cand")
sql("repeat_share", """
  SELECT count(*) AS future_pairs, round(avg(CAST(p.customer_id IS NOT NULL AS INTEGER)), 6) AS repeat_share,
         round((SELECT avg(CAST(k.stock_code IS NULL AS INTEGER)) FROM (SELECT DISTINCT stock_code FROM fut_train) f LEFT JOIN (SELECT DISTINCT stock_code FROM obs_train) k ON k.stock_code = f.stock_code), 6) AS unseen_product_share
  FROM (SELECT DISTINCT customer_id, stock_code FROM fut_train) f
  LEFT JOIN (SELECT DISTINCT customer_id, stock_code FROM obs_train) p ON p.customer_id = f.customer_id AND p.stock_code = f.stock_code""", "fut_train", "obs_train")
cte("descr", """SELECT stock_code, description FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY c DESC, description) AS rn
  FROM (SELECT stock_code, description, count(*) AS c FROM obs_train WHERE description IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1""", "obs_train")
sql("item_description", "SELECT stock_code, description FROM descr", "descr")
cte("evec", """SELECT vec_id, list_transform(v, lambda x: x / n) AS v FROM (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings)""")
sql("similar_items", """
  SELECT vec_id, similar_vec_id, round(similarity, 4) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, similar_vec_id) AS rank FROM (
      SELECT a.vec_id, b.vec_id AS similar_vec_id, round(list_inner_product(a.v, b.v), 9) AS similarity FROM evec a, evec b WHERE a.vec_id <> b.vec_id)) WHERE rank <= 8""", "evec")
sql("recommendation_lists", """
  SELECT customer_id, CAST(rank AS INTEGER) AS rank, stock_code, coalesce(description, '') AS description, bought_before,
         count(*) FILTER (WHERE NOT bought_before) OVER (PARTITION BY customer_id) AS n_new_to_customer
  FROM (SELECT t.customer_id, t.rank, i.stock_code, d.description, w.customer_id IS NOT NULL AS bought_before FROM fixed_top t JOIN items i ON i.item_idx = t.item_idx
        LEFT JOIN descr d ON d.stock_code = i.stock_code LEFT JOIN w_test w ON w.customer_id = t.customer_id AND w.item_idx = t.item_idx)""", "fixed_top", "items", "descr", "w_test")
sql("customer_page", """SELECT customer_id, recency, frequency, round(monetary, 2) AS monetary, (SELECT count(*) FROM feat_test) AS total
  FROM feat_test ORDER BY customer_id LIMIT 100 OFFSET 10""", "feat_test")
