"""Independent SQL of the registered queries, for DuckDB over the same tables.

Written against the meaning of each query, not against its Spark plan: the shared steps below are
plain SQL common table expressions. Doubles are summed exactly, as whole numbers of a power of two
that is small enough for all their bits, and rounded once.
"""

from __future__ import annotations


def exact_sum(c: str, bits: int = 84) -> str:
    unit = f"CAST({2**bits} AS DOUBLE)"
    return f"(CAST(sum(CAST({c} * {unit} AS HUGEINT)) AS DOUBLE) / {unit})"


STEPS = {
    "raw_lines": """
      SELECT CAST(o.o_orderkey AS VARCHAR) AS invoice_no,
        CASE WHEN l.l_partkey % 79 = 0 THEN '  ' ELSE CAST(l.l_partkey AS VARCHAR) END AS stock_code,
        CASE WHEN l.l_partkey % 67 = 0 THEN NULL ELSE p.p_name END AS description,
        CASE WHEN l.l_orderkey % 97 = 0 THEN 'n/a'
             WHEN l.l_returnflag = 'R' THEN CAST(CAST(-l.l_quantity AS INT) AS VARCHAR)
             ELSE CAST(CAST(l.l_quantity AS INT) AS VARCHAR) END AS quantity,
        CASE WHEN l.l_orderkey % 71 = 0 THEN 'not-a-date'
             ELSE strftime(o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INT)), '%Y-%m-%d %H:%M:%S')
        END AS invoice_date,
        CASE WHEN l.l_partkey % 89 = 0 THEN 0.0 ELSE p.p_retailprice END AS unit_price,
        CASE WHEN o.o_custkey % 83 = 0 THEN NULL ELSE o.o_custkey END AS customer_id,
        CASE WHEN l.l_orderkey % 73 = 0 THEN NULL ELSE n.n_name END AS country
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "norm": """
      SELECT trim(invoice_no) AS invoice_no, trim(stock_code) AS stock_code,
        coalesce(description, 'unknown') AS description,
        coalesce(try_cast(quantity AS BIGINT), 0) AS quantity,
        CASE WHEN try_cast(invoice_date AS TIMESTAMP) IS NOT NULL THEN invoice_date END AS invoice_date,
        try_cast(invoice_date AS TIMESTAMP) AS invoice_ts,
        CAST(coalesce(unit_price, 0.0) AS DOUBLE) AS unit_price,
        coalesce(CAST(customer_id AS VARCHAR), '-1') AS customer_id,
        trim(coalesce(country, 'unknown')) AS country,
        coalesce(try_cast(quantity AS BIGINT), 0) * CAST(coalesce(unit_price, 0.0) AS DOUBLE) AS line_total,
        CASE WHEN coalesce(try_cast(quantity AS BIGINT), 0) < 0 THEN 1 ELSE 0 END AS is_return,
        '2024-01-01T00:00:00Z' AS ingested_at_utc
      FROM raw_lines""",
    "judged": """
      SELECT *, CASE WHEN invoice_ts IS NULL THEN 'invoice_date_invalid'
          WHEN quantity = 0 THEN 'quantity_zero'
          WHEN unit_price <= 0 THEN 'unit_price_invalid'
          WHEN customer_id = '-1' THEN 'missing_customer_id'
          WHEN length(trim(invoice_no)) = 0 OR length(trim(stock_code)) = 0 OR length(trim(country)) = 0
            THEN 'missing_required_field'
          ELSE 'valid' END AS reason
      FROM norm""",
    "valid": """
      SELECT * EXCLUDE (reason), sha256(concat_ws('||', invoice_no, stock_code, invoice_date, customer_id))
          AS transaction_id,
        CAST(year(invoice_ts) AS INT) AS invoice_year, CAST(month(invoice_ts) AS INT) AS invoice_month
      FROM judged WHERE reason = 'valid'""",
    "kept": """
      SELECT * EXCLUDE (place) FROM (
        SELECT *, count(*) OVER (PARTITION BY transaction_id) AS copies,
          row_number() OVER (PARTITION BY transaction_id
            ORDER BY country, quantity, unit_price, description) AS place
        FROM valid) WHERE place = 1""",
    "dim": """
      SELECT n.n_name AS country, lower(r.r_name) AS region,
        CAST(1 + n.n_regionkey % 3 AS BIGINT) AS shipping_risk_score
      FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "enriched": """
      SELECT k.*, coalesce(d.region, 'unknown') AS region,
        coalesce(d.shipping_risk_score, 3) AS shipping_risk_score
      FROM kept k LEFT JOIN dim d ON k.country = d.country""",
    "baskets": f"""
      SELECT invoice_no, customer_id, country, region, shipping_risk_score, invoice_ts,
        {exact_sum("line_total")} AS invoice_total,
        CAST(sum(abs(quantity)) AS BIGINT) AS total_units,
        count(DISTINCT stock_code) AS unique_items,
        {exact_sum("unit_price")} / count(*) AS avg_unit_price,
        max(is_return) AS has_return_line,
        CASE WHEN dayofweek(invoice_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
        CAST(hour(invoice_ts) AS INT) AS invoice_hour,
        CAST(year(invoice_ts) AS INT) AS invoice_year,
        CAST(month(invoice_ts) AS INT) AS invoice_month
      FROM enriched
      GROUP BY invoice_no, customer_id, country, region, shipping_risk_score, invoice_ts""",
    "gaps": """
      SELECT *, CAST(date_diff('day', invoice_ts, lead(invoice_ts) OVER (PARTITION BY customer_id
          ORDER BY invoice_ts, invoice_no, country, region, shipping_risk_score)) AS INT)
          AS days_to_next_order
      FROM baskets""",
    "sales": f"""
      SELECT country, region, count(DISTINCT invoice_no) AS invoice_count,
        count(DISTINCT customer_id) AS customer_count,
        {exact_sum("line_total")} AS gross_revenue,
        {exact_sum("line_total")} / count(*) AS avg_line_total,
        CAST(sum(is_return) AS BIGINT) AS return_line_count,
        CAST(sum(is_return) AS DOUBLE) / greatest(count(DISTINCT invoice_no), 1) AS return_line_ratio,
        CAST(sum(is_return) AS DOUBLE) / count(*) AS return_line_share
      FROM enriched GROUP BY country, region""",
    "dq": f"""
      SELECT country, CAST(sum(copies) AS BIGINT) AS rows_before_dedupe, count(*) AS rows_after_cleaning,
        count(*) AS unique_transactions,
        {exact_sum("unit_price")} / count(*) AS avg_unit_price,
        CAST(sum(quantity) AS DOUBLE) / count(*) AS avg_quantity,
        1 - CAST(count(*) AS DOUBLE) / CAST(sum(copies) AS DOUBLE) AS duplicate_ratio
      FROM kept GROUP BY country""",
    "times": "SELECT invoice_no, customer_id, country, invoice_ts FROM baskets",
    "cuts": """
      SELECT quantile_disc(CAST(epoch(invoice_ts) AS BIGINT), 0.7) AS q70,
        quantile_disc(CAST(epoch(invoice_ts) AS BIGINT), 0.85) AS q85 FROM times""",
    "by_time": """
      SELECT t.*, CAST(epoch(invoice_ts) AS BIGINT) AS event_ts,
        CASE WHEN epoch(invoice_ts) <= q70 THEN 'train' WHEN epoch(invoice_ts) <= q85 THEN 'valid'
             ELSE 'test' END AS split
      FROM times t, cuts""",
    "scored": """
      SELECT l.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score,
        CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS pred
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "cells": """
      SELECT CAST(count(*) FILTER (label = 1 AND pred = 1) AS DOUBLE) AS tp,
        CAST(count(*) FILTER (label = 0 AND pred = 1) AS DOUBLE) AS fp,
        CAST(count(*) FILTER (label = 1 AND pred = 0) AS DOUBLE) AS fn,
        CAST(count(*) FILTER (label = 0 AND pred = 0) AS DOUBLE) AS tn
      FROM scored""",
    "f1": """
      SELECT 2 * tp / (2 * tp + fp + fn) AS f1_positive,
        (2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fn + fp) * (tn + fp))
          / (tp + fp + fn + tn) AS f1_weighted
      FROM cells""",
    "reps": """
      SELECT s.doc_id, s.label, s.score, r.rep,
        CAST('0x' || substr(md5(concat_ws('|', s.doc_id, r.rep)), 1, 8) AS BIGINT) / 4294967296.0 AS u
      FROM scored s, (SELECT unnest(range(0, 60)) AS rep) r""",
    # a draw counts k for every k whose cumulative probability, e^-1 * (1/0! + ... + 1/k!), it reaches
    "poisson": """
      SELECT k, exp(-1) * sum(1.0::DOUBLE / factorial(k)::DOUBLE) OVER (ORDER BY k) AS upto
      FROM (SELECT CAST(unnest(range(0, 16)) AS INT) AS k)""",
    "weighted": """
      SELECT rep, label, score, (SELECT count(*) FROM poisson WHERE poisson.upto <= reps.u) AS w FROM reps""",
    "rep_scores": """
      SELECT rep, score, sum(w * label) AS pos, sum(w * (1 - label)) AS neg
      FROM weighted WHERE w > 0 GROUP BY rep, score""",
    "rep_auc": """
      SELECT rep, CAST(sum(pos * (2 * (upto - neg) + neg)) AS DOUBLE)
          / (2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
      FROM (SELECT *, sum(neg) OVER (PARTITION BY rep ORDER BY score) AS upto FROM rep_scores)
      GROUP BY rep""",
    "ci": """
      SELECT quantile_disc(auc, 0.025) AS auc_ci_low_95, quantile_disc(auc, 0.5) AS auc_ci_median,
        quantile_disc(auc, 0.975) AS auc_ci_high_95 FROM rep_auc""",
    "order_scores": """
      SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100
            < least(floor(o_totalprice / 5000), 95) THEN 1 ELSE 0 END AS label,
        o_totalprice AS score, CASE WHEN o_totalprice >= 200000 THEN 1 ELSE 0 END AS pred
      FROM orders""",
    "runs": """
      SELECT event_id AS run_id, CASE WHEN event_id % 2 = 0 THEN 'strong' ELSE 'weak' END AS mode,
        'E' || CAST(4 + 4 * (event_id % 3) AS VARCHAR) || '_C4_M16' AS resource_profile,
        value AS runtime_sec, user_id + 1 AS result_rows
      FROM events""",
    "priced": """
      SELECT *, (CAST(0.03 AS DOUBLE) * executors * cores + CAST(0.004 AS DOUBLE) * executors * memory_gb)
          * (runtime_sec / 3600) AS estimated_cost_usd
      FROM (SELECT *,
          CAST(regexp_extract(resource_profile, '^E([0-9]+)_C([0-9]+)_M([0-9]+)$', 1) AS INT) AS executors,
          CAST(regexp_extract(resource_profile, '^E([0-9]+)_C([0-9]+)_M([0-9]+)$', 2) AS INT) AS cores,
          CAST(regexp_extract(resource_profile, '^E([0-9]+)_C([0-9]+)_M([0-9]+)$', 3) AS INT) AS memory_gb
        FROM runs)""",
    "costs": """
      SELECT *, result_rows / greatest(runtime_sec, CAST(0.001 AS DOUBLE)) AS throughput_rows_per_sec,
        estimated_cost_usd / greatest(result_rows, 1) * CAST(1000.0 AS DOUBLE) AS cost_per_1000_rows,
        CASE WHEN mode = 'strong' THEN (SELECT min(runtime_sec) FROM runs WHERE mode = 'strong') / runtime_sec
        END AS strong_efficiency
      FROM priced""",
    "profiles": f"""
      SELECT resource_profile,
        {exact_sum("runtime_sec")} / count(*) AS runtime_sec,
        {exact_sum("cost_per_1000_rows", 100)} / count(*) AS cost_per_1000_rows
      FROM costs GROUP BY resource_profile""",
    "balance": """
      SELECT *, runtime_sec > 0 AS measured, runtime_sec / (SELECT min(runtime_sec) FROM profiles WHERE runtime_sec > 0)
          + cost_per_1000_rows / (SELECT min(cost_per_1000_rows) FROM profiles WHERE runtime_sec > 0) AS balance_score
      FROM profiles""",
}

STEPS["run_log"] = """
      SELECT event_type AS run_name, event_type || CASE WHEN value < 10 THEN '_failed' ELSE '' END AS pipeline_name,
        value < 10 AS failed, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp_utc, 'in' AS input_path,
        'out/' || event_id AS output_path, event_id AS row_count, value,
        CASE WHEN user_id % 2 = 0 THEN 'broadcast' ELSE 'merge' END AS join_mode
      FROM events"""

LINES = ["raw_lines", "norm"]
VALID = [*LINES, "judged", "valid"]
KEPT = [*VALID, "kept"]
ENRICHED = [*KEPT, "dim", "enriched"]
BASKETS = [*ENRICHED, "baskets"]
TIMES = [*BASKETS, "times"]
SPLIT = [*TIMES, "cuts", "by_time"]
BOOTSTRAP = ["scored", "reps", "poisson", "weighted", "rep_scores", "rep_auc"]
COSTS = ["runs", "priced", "costs"]
PROFILES = [*COSTS, "profiles"]

BUCKET = "CAST('0x' || substr(md5(concat_ws('|', {})), 1, 8) AS BIGINT)"


def _labelled(days: int) -> str:
    return (
        f"SELECT *, CASE WHEN days_to_next_order BETWEEN 0 AND {days} THEN 1 ELSE 0 END "
        f"AS target_repeat_{days}d FROM gaps"
    )


def _auc(table: str) -> str:
    return f"""
      SELECT CAST(sum(pos * (2 * before + neg)) AS DOUBLE)
          / (2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
      FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS before
        FROM (SELECT score, CAST(sum(label) AS HUGEINT) AS pos, CAST(sum(1 - label) AS HUGEINT) AS neg
          FROM {table} GROUP BY score))"""


def _index(column: str) -> str:
    return f"""(SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE)
        AS {column}_idx FROM baskets GROUP BY {column})"""


def _pick(name: str, by: str) -> str:
    return f"""(SELECT '{name}' AS recommendation, resource_profile, runtime_sec, cost_per_1000_rows
        FROM balance ORDER BY measured DESC, {by}, resource_profile LIMIT 1)"""


PROFIT = "30 * tp - 5 * fp - 20 * fn + 2 * tn"
RULES: dict[str, tuple[list[str], str]] = {
    "normalize_lines": (LINES, "SELECT * FROM norm"),
    "source_columns": (["raw_lines"], "SELECT * FROM raw_lines"),
    "month_first_dates": (
        [],
        """SELECT o_orderkey, strftime(moment, '%Y-%m-%d %H:%M:%S') AS text, moment AS time
          FROM (SELECT o_orderkey, CAST(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS TIMESTAMP) AS moment
            FROM orders)""",
    ),
    "date_formats": (
        [],
        """SELECT 'M/d/yyyy[ H:mm[:ss]]' AS date_format, count(*) FILTER (day(o_orderdate) <= 12) AS cells FROM orders
          UNION ALL SELECT 'd/M/yyyy[ H:mm[:ss]]', count(*) FROM orders
          UNION ALL SELECT unnest(['d.M.yyyy[ H:mm[:ss]]', 'yyyy/M/d[ H:mm[:ss]]', 'd-MMM-yyyy[ H:mm[:ss]]',
            'yyyyMMdd[ HHmmss]']), 0""",
    ),
    "record_cap": (
        LINES,
        """SELECT * FROM norm ORDER BY invoice_no, stock_code, description, quantity,
          invoice_date NULLS FIRST, unit_price, customer_id, country LIMIT 1000""",
    ),
    "valid_lines": (VALID, "SELECT * FROM valid"),
    "quarantine_reasons": (
        VALID,
        "SELECT * EXCLUDE (reason), reason AS validation_reason FROM judged WHERE reason <> 'valid'",
    ),
    "reason_counts": (VALID, "SELECT reason, count(*) AS row_count FROM judged GROUP BY reason"),
    "table_counts": (
        KEPT,
        """SELECT 'valid_rows' AS table_name, count(*) AS row_count FROM valid
          UNION ALL SELECT 'curated_rows', count(*) FROM kept
          UNION ALL SELECT 'rejected_rows', count(*) FROM judged WHERE reason <> 'valid'""",
    ),
    "dedupe_transactions": (KEPT, "SELECT * FROM kept"),
    "duplicate_counts": (
        VALID,
        """SELECT count(*) AS rows_in, count(DISTINCT transaction_id) AS rows_kept,
          count(*) - count(DISTINCT transaction_id) AS rows_dropped FROM valid""",
    ),
    "country_repair": (
        LINES,
        """SELECT coalesce(country, 'unknown') AS country, count(*) AS row_count
          FROM raw_lines GROUP BY 1""",
    ),
    "enrich_auto": (ENRICHED, "SELECT * EXCLUDE (copies) FROM enriched"),
    "enrich_broadcast": (ENRICHED, "SELECT * EXCLUDE (copies) FROM enriched"),
    "enrich_merge": (ENRICHED, "SELECT * EXCLUDE (copies) FROM enriched"),
    "invoice_features": (BASKETS, "SELECT * FROM baskets"),
    "invoice_features_distinct": (BASKETS, "SELECT * FROM baskets"),
    "repeat_label": ([*BASKETS, "gaps"], _labelled(30)),
    "repeat_label_180": ([*BASKETS, "gaps"], _labelled(180)),
    "repeat_label_window": ([*BASKETS, "gaps"], _labelled(30)),
    "repeat_label_censored": (
        [*BASKETS, "gaps"],
        """SELECT *, CASE WHEN days_to_next_order BETWEEN 0 AND 30 THEN 1
          WHEN CAST(invoice_ts AS DATE) + 30 <= (SELECT max(CAST(invoice_ts AS DATE)) FROM baskets) THEN 0
          END AS target_repeat_30d FROM gaps""",
    ),
    "basket_signals": (
        BASKETS,
        """SELECT invoice_no, customer_id, country, invoice_ts,
          invoice_total / greatest(total_units, 1) AS avg_item_value,
          unique_items / greatest(avg_unit_price, CAST(0.01 AS DOUBLE)) AS items_per_unit_price,
          round(ln(1 + abs(invoice_total)), 9) AS log_invoice_total FROM baskets""",
    ),
    "sales_metrics": ([*ENRICHED, "sales"], "SELECT * FROM sales"),
    "sales_metrics_from_baskets": ([*ENRICHED, "sales"], "SELECT * FROM sales"),
    "return_ratio": (
        [*ENRICHED, "sales"],
        "SELECT country, return_line_count, return_line_ratio, return_line_share FROM sales",
    ),
    "top_return_countries": (
        [*ENRICHED, "sales"],
        """SELECT country, region, return_line_ratio, gross_revenue FROM sales
          ORDER BY return_line_ratio DESC, gross_revenue DESC, country LIMIT 10""",
    ),
    "dq_metrics_exact": ([*KEPT, "dq"], "SELECT * FROM dq"),
    "dq_metrics_from_baskets": ([*KEPT, "dq"], "SELECT * FROM dq"),
    "dq_kpis": (
        [*KEPT, "dq"],
        f"""SELECT CAST(sum(rows_after_cleaning) AS BIGINT) AS rows_after_cleaning,
          {exact_sum("duplicate_ratio", 100)} / count(*) AS avg_duplicate_ratio,
          {exact_sum("avg_unit_price", 100)} / count(*) AS avg_unit_price
          FROM dq""",
    ),
    "distinct_sketch_flags": (
        VALID,
        """SELECT country, count(*) AS row_count, true AS within_error, true AS equals_one_pass
          FROM valid GROUP BY country""",
    ),
    "dq_approx_flags": (
        VALID,
        f"""SELECT country, count(*) AS rows_after_cleaning, {exact_sum("unit_price")} / count(*) AS avg_unit_price,
          true AS within_error FROM valid GROUP BY country""",
    ),
    "dup_anomalies": ([*KEPT, "dq"], "SELECT country, rows_after_cleaning, duplicate_ratio FROM dq"),
    "country_quality": ([*KEPT, "dq"], "SELECT country, rows_after_cleaning FROM dq"),
    "weekly_returns": (
        ENRICHED,
        """SELECT country, CAST(date_trunc('week', invoice_ts) AS DATE) AS week_start,
          count(*) AS line_count, CAST(sum(is_return) AS BIGINT) AS return_line_count,
          CAST(sum(is_return) AS DOUBLE) / count(*) AS return_ratio
          FROM enriched GROUP BY 1, 2""",
    ),
    "region_ranking": (
        ENRICHED,
        f"""SELECT region, count(DISTINCT invoice_no) AS invoice_count,
          count(DISTINCT customer_id) AS customer_count,
          {exact_sum("line_total")} / count(*) AS avg_line_total,
          {exact_sum("line_total")} AS gross_revenue
          FROM enriched GROUP BY region""",
    ),
    "country_rollup_sorted": (
        BASKETS,
        f"""SELECT region, country, count(*) AS invoice_rows,
          {exact_sum("invoice_total")} / count(*) AS avg_invoice_total,
          CAST(sum(total_units) AS DOUBLE) / count(*) AS avg_total_units,
          CAST(sum(shipping_risk_score) AS DOUBLE) / count(*) AS risk
          FROM baskets GROUP BY region, country""",
    ),
    "temporal_cuts": ([*TIMES, "cuts"], "SELECT * FROM cuts"),
    "temporal_split_exact": (SPLIT, "SELECT * FROM by_time"),
    "split_counts": (SPLIT, "SELECT split, count(*) AS row_count FROM by_time GROUP BY split"),
    "union_train_valid": (SPLIT, "SELECT * EXCLUDE (split) FROM by_time WHERE split IN ('train', 'valid')"),
    "approx_cut_flags": (
        [],
        """SELECT mode, cut_name, true AS within_error FROM (SELECT unnest(['one pass', 'stored sketches']) AS mode),
          (SELECT unnest(['q70', 'q85']) AS cut_name)""",
    ),
    "draw_flags": (
        [*BASKETS, "scored"],
        """SELECT draw, n AS table_rows, true AS fair_size, true AS rows_of_table
          FROM (SELECT unnest(['bernoulli', 'stratified', 'hash train', 'hash test']) AS draw,
              (SELECT count(*) FROM baskets) AS n
            UNION ALL SELECT 'poisson', (SELECT count(*) FROM scored))""",
    ),
    "hash_split_md5": (
        TIMES,
        f"""SELECT *, CASE WHEN split_id < 70 THEN 'train' WHEN split_id < 85 THEN 'valid' ELSE 'test' END
          AS split
          FROM (SELECT *, {BUCKET.format("invoice_no, customer_id")} % 100 AS split_id FROM times)""",
    ),
    "md5_sample": (
        TIMES,
        f"""SELECT * FROM times
          WHERE {BUCKET.format("invoice_no, customer_id, country, CAST(invoice_ts AS VARCHAR)")}
            / 4294967296.0 < CAST(0.2 AS DOUBLE)""",
    ),
    "confusion": (["scored"], "SELECT label, pred, count(*) AS row_count FROM scored GROUP BY label, pred"),
    "f1_weighted": (["scored", "cells", "f1"], "SELECT f1_weighted FROM f1"),
    "f1_positive": (["scored", "cells", "f1"], "SELECT f1_positive FROM f1"),
    "auc_rank": (["scored"], _auc("scored")),
    "auc_rank_orders": (["order_scores"], _auc("order_scores")),
    "auc_bootstrap": (BOOTSTRAP, "SELECT rep, auc FROM rep_auc"),
    "auc_bootstrap_ci": ([*BOOTSTRAP, "ci"], "SELECT * FROM ci"),
    "business_value": (["scored", "cells"], f"SELECT {PROFIT} AS expected_profit FROM cells"),
    "profit_per_1000": (
        ["order_scores"],
        """SELECT expected_profit, test_count, expected_profit / test_count * 1000 AS profit_per_1000
          FROM (SELECT count(*) AS test_count, CAST(sum(CASE WHEN label = 1 AND pred = 1 THEN 30
            WHEN label = 0 AND pred = 1 THEN -5 WHEN label = 1 AND pred = 0 THEN -20 ELSE 2 END) AS DOUBLE)
            AS expected_profit FROM order_scores)""",
    ),
    "evaluation_long": (
        [*BOOTSTRAP, "ci", "cells", "f1"],
        f"""SELECT 'test_auc' AS metric, auc AS value FROM ({_auc("scored")})
          UNION ALL SELECT 'test_f1_weighted', f1_weighted FROM f1
          UNION ALL SELECT 'test_f1_positive', f1_positive FROM f1
          UNION ALL SELECT 'auc_ci_low_95', auc_ci_low_95 FROM ci
          UNION ALL SELECT 'auc_ci_median', auc_ci_median FROM ci
          UNION ALL SELECT 'auc_ci_high_95', auc_ci_high_95 FROM ci
          UNION ALL SELECT 'expected_profit', {PROFIT} FROM cells
          UNION ALL SELECT 'test_count', CAST(count(*) AS DOUBLE) FROM scored""",
    ),
    "feature_vectors": (
        BASKETS,
        """SELECT invoice_no, customer_id, invoice_ts, invoice_total, CAST(total_units AS DOUBLE) AS total_units,
          CAST(unique_items AS DOUBLE) AS unique_items, avg_unit_price,
          CAST(has_return_line AS DOUBLE) AS has_return_line, CAST(is_weekend AS DOUBLE) AS is_weekend,
          CAST(invoice_hour AS DOUBLE) AS invoice_hour, CAST(shipping_risk_score AS DOUBLE) AS shipping_risk_score,
          CAST(2 AS DOUBLE) AS slots_set FROM baskets""",
    ),
    "reloaded_scores_flags": (
        SPLIT,
        """SELECT count(*) AS test_rows, true AS same_scores, true AS sound FROM by_time WHERE split = 'test'""",
    ),
    "run_log_health": (
        ["run_log"],
        "SELECT run_name, count(*) AS runs, count(*) FILTER (failed) AS failures FROM run_log GROUP BY run_name",
    ),
    "run_log_latest": (
        ["run_log"],
        """SELECT * EXCLUDE (value, join_mode, place) FROM (SELECT *, row_number() OVER (PARTITION BY run_name
            ORDER BY timestamp_utc DESC, pipeline_name DESC) AS place FROM run_log) WHERE place = 1""",
    ),
    "run_log_join_modes": (
        ["run_log"],
        f"""SELECT join_mode, count(*) AS runs, {exact_sum("value")} / count(*) AS avg_runtime_sec,
          min(value) AS min_runtime_sec FROM run_log GROUP BY join_mode""",
    ),
    "run_cost": (COSTS, "SELECT * FROM costs"),
    "profile_costs": (PROFILES, "SELECT * FROM profiles"),
    "run_recommendation": (
        [*PROFILES, "balance"],
        " UNION ALL ".join(
            _pick(name, by)
            for name, by in (
                ("Fastest", "runtime_sec"),
                ("Cheapest", "cost_per_1000_rows"),
                ("Balanced", "balance_score"),
            )
        ),
    ),
    "category_index": (
        BASKETS,
        f"""SELECT DISTINCT b.region, b.country, r.region_idx, c.country_idx FROM baskets b
          JOIN {_index("region")} r ON b.region = r.region
          JOIN {_index("country")} c ON b.country = c.country""",
    ),
}


def sql(name: str) -> str:
    steps, final = RULES[name]
    ctes = ", ".join(f"{step} AS ({STEPS[step]})" for step in dict.fromkeys(steps))
    return f"WITH {ctes} {final}" if steps else final


ORACLE_SQL = {name: sql(name) for name in RULES}
