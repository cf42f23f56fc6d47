"""SQL twins of the registered queries, for another engine to check them with."""

from __future__ import annotations

from txnguard.schema import MODEL_INPUTS

_RAW = """
base AS (
  SELECT o_orderkey AS k, o_custkey, o_totalprice AS p, c_acctbal AS bal,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
              WHEN '3-MEDIUM' THEN 'PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'DEBIT'
              WHEN '5-LOW' THEN 'CASH_IN' END AS base_type,
         CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice
              ELSE o_totalprice + c_acctbal + CAST(1000 AS DOUBLE) END AS old_orig
  FROM orders JOIN customer ON o_custkey = c_custkey
),
raw AS (
  SELECT k AS txn_id,
         CAST(k % 743 + 1 AS INTEGER) AS step,
         CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'UNKNOWN'
              WHEN k % 7 = 0 THEN '  ' || lower(replace(base_type, '_', ' ')) || ' '
              ELSE base_type END AS type,
         CASE WHEN k % 83 = 0 THEN NULL ELSE p END AS amount,
         ' c' || CAST(o_custkey AS VARCHAR) || ' ' AS nameOrig,
         old_orig AS oldbalanceOrg,
         old_orig - p AS newbalanceOrig,
         CASE WHEN k % 79 = 0 THEN ' '
              WHEN base_type IN ('TRANSFER', 'CASH_OUT') THEN 'C' || CAST(k % 50 AS VARCHAR)
              ELSE 'M' || CAST(k % 50 AS VARCHAR) END AS nameDest,
         abs(bal) AS oldbalanceDest,
         abs(bal) + p AS newbalanceDest,
         CAST(CASE WHEN (p > 200000 AND k % 5 = 0 AND base_type IN ('TRANSFER', 'CASH_OUT'))
                     OR k % 101 = 0 THEN 1 ELSE 0 END AS INTEGER) AS isFraud,
         CAST(CASE WHEN k % 3 = 0 THEN NULL WHEN p > 400000 THEN 1 ELSE 0 END AS INTEGER) AS isFlaggedFraud
  FROM base
)"""

_TYPED = (
    _RAW
    + """,
typed AS (
  SELECT txn_id, step,
         upper(regexp_replace(trim(coalesce(type, '')), '\\s+', '_', 'g')) AS type,
         amount, upper(trim(coalesce(nameOrig, ''))) AS nameOrig,
         oldbalanceOrg, newbalanceOrig, upper(trim(coalesce(nameDest, ''))) AS nameDest,
         oldbalanceDest, newbalanceDest,
         CAST(isFraud AS DOUBLE) AS isFraud,
         coalesce(isFlaggedFraud, 0) AS isFlaggedFraud
  FROM raw
),
checked AS (
  SELECT *, CASE
    WHEN step IS NULL THEN 'missing_step'
    WHEN amount IS NULL OR isnan(amount) THEN 'missing_amount'
    WHEN oldbalanceOrg IS NULL OR isnan(oldbalanceOrg) THEN 'missing_oldbalanceOrg'
    WHEN newbalanceOrig IS NULL OR isnan(newbalanceOrig) THEN 'missing_newbalanceOrig'
    WHEN oldbalanceDest IS NULL OR isnan(oldbalanceDest) THEN 'missing_oldbalanceDest'
    WHEN newbalanceDest IS NULL OR isnan(newbalanceDest) THEN 'missing_newbalanceDest'
    WHEN isFraud IS NULL OR isnan(isFraud) THEN 'missing_isFraud'
    WHEN length(type) = 0 THEN 'blank_type'
    WHEN length(nameOrig) = 0 THEN 'blank_nameOrig'
    WHEN length(nameDest) = 0 THEN 'blank_nameDest'
    WHEN type NOT IN ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER') THEN 'unknown_type'
    ELSE 'kept' END AS reason
  FROM typed
),
clean AS (SELECT * EXCLUDE (reason) FROM checked WHERE reason = 'kept')"""
)

_FEATURES = (
    _TYPED
    + """,
featured AS (
  SELECT *,
         oldbalanceOrg - newbalanceOrig AS balance_diff_orig,
         newbalanceDest - oldbalanceDest AS balance_diff_dest,
         CASE WHEN oldbalanceOrg + 1 = 0 THEN NULL
              ELSE amount / (oldbalanceOrg + CAST(1 AS DOUBLE)) END AS amount_ratio,
         CAST(CASE WHEN newbalanceOrig = 0 THEN 1 ELSE 0 END AS DOUBLE) AS is_zero_balance_orig,
         CAST(CASE WHEN amount > 200000 THEN 1 ELSE 0 END AS DOUBLE) AS is_large_amount
  FROM clean
),
prepared AS (SELECT * EXCLUDE (isFraud), isFraud AS label FROM featured),
modelled AS (
  SELECT *, isFraud AS label, fraud_probability > 0.5 AS guess
  FROM (SELECT *, ((txn_id * 37) % 1000) / CAST(999 AS DOUBLE) AS fraud_probability FROM featured)
),
flagged AS (
  SELECT *, CAST(guess AS DOUBLE) AS prediction,
         CAST(guess AS DOUBLE) AS is_ml_alert,
         CAST(nameDest IN ('C7', 'C31') AS DOUBLE) AS is_rule_blacklist,
         CAST(nameDest IN ('C7', 'C31') AS DOUBLE) AS is_blacklist_destination,
         CAST(is_zero_balance_orig = 1 AND type IN ('TRANSFER', 'CASH_OUT') AS DOUBLE) AS is_rule_drain,
         is_large_amount AS is_rule_large_txn
  FROM modelled
),
ruled AS (
  SELECT *,
         greatest(is_rule_blacklist, is_rule_drain, is_rule_large_txn) AS is_rule_alert,
         least(is_rule_blacklist + is_rule_drain * CAST(0.5 AS DOUBLE)
               + is_rule_large_txn * CAST(0.5 AS DOUBLE), CAST(1 AS DOUBLE)) AS rule_score
  FROM flagged
),
blended AS (
  SELECT *, fraud_probability * CAST(0.7 AS DOUBLE) + rule_score * CAST(0.3 AS DOUBLE) AS hybrid_score
  FROM ruled
),
decided AS (
  SELECT *, CAST(hybrid_score >= CAST(0.75 AS DOUBLE) OR is_rule_blacklist = 1 AS DOUBLE) AS is_alert,
         concat_ws('+', CASE WHEN is_ml_alert = 1 THEN 'ML' END,
                        CASE WHEN is_rule_blacklist = 1 THEN 'BLACKLIST_RULE' END,
                        CASE WHEN is_rule_drain = 1 THEN 'DRAIN' END,
                        CASE WHEN is_rule_large_txn = 1 THEN 'LARGE_TXN' END) AS raised
  FROM blended
),
scored AS (
  SELECT *, CASE WHEN is_alert = 0 THEN 'NONE' WHEN raised = '' THEN 'HYBRID_SCORE'
                 WHEN raised = 'ML' THEN 'ML_MODEL' ELSE raised END AS alert_source
  FROM decided
),
payload AS (
  SELECT step, type, amount, nameOrig, nameDest,
         round(fraud_probability, 4) AS fraud_probability,
         round(rule_score, 4) AS rule_score, round(hybrid_score, 4) AS hybrid_score,
         oldbalanceOrg, newbalanceOrig,
         CAST(is_ml_alert AS INTEGER) AS is_ml_alert,
         CAST(is_blacklist_destination AS INTEGER) AS is_blacklist_destination,
         CAST(is_rule_blacklist AS INTEGER) AS is_rule_blacklist,
         CAST(is_rule_drain AS INTEGER) AS is_rule_drain,
         CAST(is_rule_large_txn AS INTEGER) AS is_rule_large_txn,
         CAST(is_rule_alert AS INTEGER) AS is_rule_alert,
         alert_source, txn_id
  FROM scored WHERE is_alert = 1
),
counters AS (
  SELECT count(*) AS total_transactions,
         count(*) FILTER (is_alert = 1) AS total_fraud,
         count(*) FILTER (is_ml_alert = 1) AS total_ml_alerts,
         count(*) FILTER (is_rule_alert = 1) AS total_rule_alerts
  FROM scored
)"""
)


def _with(steps: str, body: str) -> str:
    return f"WITH {steps.strip()}\n{body.strip()}"


_GOLD = _with(
    _FEATURES,
    """SELECT txn_id, step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest,
       oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud, prediction, fraud_probability,
       rule_score, hybrid_score, is_ml_alert, is_blacklist_destination, is_rule_blacklist,
       is_rule_drain, is_rule_large_txn, is_rule_alert, is_alert, alert_source
FROM scored""",
)
_KPIS = _with(
    _FEATURES,
    """SELECT *, CASE WHEN total_transactions > 0
       THEN round(CAST(total_fraud AS DOUBLE) / total_transactions * 100, 4) ELSE CAST(0 AS DOUBLE) END AS fraud_rate
FROM counters""",
)
_HASH = "CAST('0x' || substr(md5(CAST(txn_id AS VARCHAR)), 1, 8) AS BIGINT)"
_SPLIT = f"""CASE WHEN {_HASH} % 10000 < 7000 THEN 'train'
                   WHEN {_HASH} % 10000 < 8500 THEN 'validation' ELSE 'test' END"""
_CONFUSION = """confusion AS (
  SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM flagged
)"""
_LISTED_CUSTOMERS = "SELECT 'C' || CAST(c_custkey AS VARCHAR) AS account FROM customer WHERE c_acctbal < 0"


def _auc(source: str, score: str) -> str:
    """Rank-sum AUC with average ranks for ties."""
    return f"""SELECT round((sum(CASE WHEN label = 1 THEN avg_rank END)
                 - CAST(count(*) FILTER (label = 1) AS DOUBLE) * (count(*) FILTER (label = 1) + 1) / 2)
                / (CAST(count(*) FILTER (label = 1) AS DOUBLE) * count(*) FILTER (label = 0)), 9) AS auc
      FROM (SELECT label, CAST(rank() OVER (ORDER BY {score}) AS DOUBLE)
                          + (count(*) OVER (PARTITION BY {score}) - 1) / CAST(2 AS DOUBLE) AS avg_rank
            FROM {source})"""


def _std_rows() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS feature, round(stddev_samp({name}), 4) AS std FROM indexed" for name in MODEL_INPUTS
    )


_METRIC_NAMES = "(VALUES ('accuracy'), ('precision'), ('recall'), ('f1'), ('auc')) AS m(metric)"
_MODELS = "(VALUES ('rf', 'RandomForest'), ('gbt', 'GradientBoostedTrees')) AS k(model_key, model_name)"


def _compared(profile: str) -> str:
    counts = ", ".join(f"count(*) FILTER (split = '{s}') AS {s}_rows" for s in ("train", "validation", "test"))
    return _with(
        _FEATURES + f", parts AS (SELECT {counts} FROM (SELECT {_SPLIT} AS split FROM prepared))",
        f"SELECT model_key, model_name, '{profile}' AS profile, parts.*, true AS in_range FROM {_MODELS}, parts",
    )


_INDEXED = (
    _FEATURES
    + """,
ranks AS (
  SELECT type AS ranked_type, CAST(row_number() OVER (ORDER BY n DESC, type) - 1 AS DOUBLE) AS type_index, n
  FROM (SELECT type, count(*) AS n FROM clean GROUP BY type)
),
indexed AS (SELECT prepared.*, ranks.type_index FROM prepared JOIN ranks ON type = ranked_type)"""
)

ORACLES: dict[str, str] = {
    "clean_transactions": _with(_TYPED, "SELECT * FROM clean"),
    "csv_clean_transactions": _with(_TYPED, "SELECT * EXCLUDE (txn_id) FROM clean"),
    "drop_reasons": _with(_TYPED, "SELECT reason, count(*) AS row_count FROM checked GROUP BY reason"),
    "clean_reconciliation": _with(
        _TYPED,
        """SELECT count(*) AS raw_rows, count(*) FILTER (reason = 'kept') AS clean_rows,
                  count(*) FILTER (reason <> 'kept') AS dropped_rows FROM checked""",
    ),
    "dataset_summary": _with(
        _TYPED,
        """SELECT count(*) AS raw_rows, count(*) FILTER (reason = 'kept') AS clean_rows,
                  count(*) FILTER (reason <> 'kept') AS dropped_rows,
                  round(avg(isFraud) FILTER (reason = 'kept') * 100, 6) AS fraud_rate_percent FROM checked""",
    ),
    "engineered_features": _with(
        _FEATURES,
        """SELECT txn_id, balance_diff_orig, balance_diff_dest, amount_ratio,
                  is_zero_balance_orig, is_large_amount FROM featured""",
    ),
    "labelled_transactions": _with(_TYPED, "SELECT txn_id, isFraud, isFraud AS label FROM clean"),
    "prepared_features": _with(_FEATURES, "SELECT * FROM prepared"),
    "row_count": _with(_RAW, "SELECT count(*) AS row_count FROM raw"),
    "null_counts": _with(
        _RAW,
        """SELECT count(*) FILTER (step IS NULL) AS step, count(*) FILTER (type IS NULL) AS type,
                  count(*) FILTER (amount IS NULL) AS amount, count(*) FILTER (nameOrig IS NULL) AS nameOrig,
                  count(*) FILTER (oldbalanceOrg IS NULL) AS oldbalanceOrg,
                  count(*) FILTER (newbalanceOrig IS NULL) AS newbalanceOrig,
                  count(*) FILTER (nameDest IS NULL) AS nameDest,
                  count(*) FILTER (oldbalanceDest IS NULL) AS oldbalanceDest,
                  count(*) FILTER (newbalanceDest IS NULL) AS newbalanceDest,
                  count(*) FILTER (isFraud IS NULL) AS isFraud,
                  count(*) FILTER (isFlaggedFraud IS NULL) AS isFlaggedFraud FROM raw""",
    ),
    "blank_counts": _with(
        _RAW,
        """SELECT count(*) FILTER (trim(coalesce(type, '')) = '') AS type,
                  count(*) FILTER (trim(coalesce(nameOrig, '')) = '') AS nameOrig,
                  count(*) FILTER (trim(coalesce(nameDest, '')) = '') AS nameDest FROM raw""",
    ),
    "fraud_rate": _with(_RAW, "SELECT round(avg(CAST(isFraud AS DOUBLE)) * 100, 6) AS fraud_rate_percent FROM raw"),
    "counts_by_type": _with(_RAW, "SELECT type, count(*) AS row_count FROM raw GROUP BY type ORDER BY type"),
    "fraud_by_type": _with(
        _RAW,
        """SELECT type, CAST(sum(isFraud) AS BIGINT) AS fraud_count, round(avg(amount), 4) AS avg_amount
           FROM raw GROUP BY type ORDER BY type""",
    ),
    "amount_quantiles_exact": _with(
        _RAW,
        """SELECT round(quantile_cont(amount, 0.5), 4) AS p50, round(quantile_cont(amount, 0.9), 4) AS p90,
                  round(quantile_cont(amount, 0.99), 4) AS p99, round(quantile_cont(amount, 0.999), 4) AS p999
           FROM raw""",
    ),
    "class_distribution": _with(
        _FEATURES,
        """SELECT label, count(*) AS class_count,
                  round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 4) AS class_percent
           FROM prepared GROUP BY label""",
    ),
    "replay_fraud_share": _with(
        _RAW,
        """SELECT sent_rows, fraud_rows, round(fraud_rows * CAST(100 AS DOUBLE) / sent_rows, 4) AS fraud_percent
           FROM (SELECT row_number() OVER (ORDER BY txn_id) AS sent_rows,
                        CAST(sum(isFraud) OVER (ORDER BY txn_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fraud_rows
                 FROM raw) WHERE sent_rows % 500 = 0""",
    ),
    "blacklist_accounts": f"""SELECT account FROM (
        {_LISTED_CUSTOMERS} UNION SELECT 'C7' UNION SELECT 'C31') ORDER BY account""",
    "blacklist_profile": _with(
        _RAW,
        """SELECT CAST(hit AS INTEGER) AS is_blacklist_transfer, count(*) AS row_count,
                  CAST(sum(isFraud) AS BIGINT) AS fraud_count, round(avg(amount), 4) AS avg_amount
           FROM (SELECT *, CASE WHEN upper(trim(nameDest)) IN ('C7', 'C31')
                                 AND upper(trim(type)) = 'TRANSFER' THEN 1 ELSE 0 END AS hit FROM raw)
           GROUP BY hit ORDER BY hit""",
    ),
    "blacklist_join_flags": _with(
        _TYPED,
        f"""SELECT txn_id, nameOrig, CAST(nameOrig IN ({_LISTED_CUSTOMERS}) AS DOUBLE) AS is_listed FROM clean""",
    ),
    "blacklist_semi": _with(
        _TYPED, f"SELECT txn_id, nameOrig, amount FROM clean WHERE nameOrig IN ({_LISTED_CUSTOMERS})"
    ),
    "blacklist_anti": _with(
        _TYPED, f"SELECT txn_id, nameOrig, amount FROM clean WHERE nameOrig NOT IN ({_LISTED_CUSTOMERS})"
    ),
    "rule_flags": _with(
        _FEATURES,
        """SELECT txn_id, is_ml_alert, is_blacklist_destination, is_rule_blacklist, is_rule_drain,
                  is_rule_large_txn, is_rule_alert FROM ruled""",
    ),
    "hybrid_scores": _with(
        _FEATURES,
        "SELECT txn_id, fraud_probability, rule_score, hybrid_score, is_alert, alert_source FROM scored",
    ),
    "gold_table": _GOLD,
    "alert_payload": _with(_FEATURES, "SELECT * FROM payload"),
    "alert_counters": _with(_FEATURES, "SELECT * FROM counters"),
    "alerts_by_source": _with(
        _FEATURES,
        """SELECT alert_source, type, count(*) AS alert_count, round(sum(amount), 2) AS total_amount,
                  round(avg(hybrid_score), 6) AS avg_hybrid_score
           FROM scored WHERE is_alert = 1 GROUP BY alert_source, type""",
    ),
    "kpis": _KPIS,
    "recent_alerts_top50": _with(_FEATURES, "SELECT * FROM payload ORDER BY step DESC, txn_id DESC LIMIT 50"),
    "alert_json_skip_bad": _with(_FEATURES, "SELECT * FROM payload WHERE txn_id % 11 <> 0"),
    "json_roundtrip": _with(
        _RAW,
        """SELECT step, trim(type) AS type, amount, trim(nameOrig) AS nameOrig, oldbalanceOrg, newbalanceOrig,
                  trim(nameDest) AS nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud, txn_id
           FROM raw""",
    ),
    "json_decode_events": "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events",
    "replay_limit": _with(_RAW, "SELECT * FROM raw ORDER BY txn_id LIMIT 1000"),
    "hash_split_counts": _with(
        _FEATURES,
        f"""SELECT split, count(*) AS row_count, CAST(sum(label) AS BIGINT) AS fraud_count
            FROM (SELECT {_SPLIT} AS split, label FROM prepared) GROUP BY split""",
    ),
    "class_weights": _with(
        _FEATURES,
        """SELECT count(*) AS total, count(*) FILTER (label = 1) AS fraud_count,
                  count(*) FILTER (label <> 1) AS non_fraud_count,
                  round(count(*) / (CAST(2 AS DOUBLE) * count(*) FILTER (label = 1)), 9) AS weight_fraud,
                  round(count(*) / (CAST(2 AS DOUBLE) * count(*) FILTER (label <> 1)), 9) AS weight_non_fraud
           FROM prepared""",
    ),
    "bounded_stratified_sample": _with(
        _FEATURES,
        f"""SELECT txn_id, fraud_probability, label
            FROM (SELECT txn_id, fraud_probability, label,
                         row_number() OVER (PARTITION BY label ORDER BY {_HASH}, txn_id) AS place FROM modelled)
            WHERE place <= 300""",
    ),
    "type_index": _with(_INDEXED, "SELECT ranked_type AS type, n AS row_count, type_index FROM ranks"),
    "fitted_type_index": _with(_INDEXED, "SELECT ranked_type AS type, type_index, n AS row_count FROM ranks"),
    "scaled_feature_std": _with(_INDEXED, _std_rows()),
    "scaled_features": _with(
        _INDEXED,
        """SELECT txn_id, round(amount / (SELECT stddev_samp(amount) FROM indexed), 6) AS amount_scaled,
                  round(amount_ratio / (SELECT stddev_samp(amount_ratio) FROM indexed), 6) AS amount_ratio_scaled,
                  round(type_index / (SELECT stddev_samp(type_index) FROM indexed), 6) AS type_index_scaled
           FROM indexed""",
    ),
    "confusion_matrix": _with(f"{_FEATURES},\n{_CONFUSION}", "SELECT * FROM confusion"),
    "classification_metrics": _with(
        f"""{_FEATURES},
{_CONFUSION},
shares AS (
  SELECT CAST(tn + fp AS DOUBLE) AS n0, CAST(fn + tp AS DOUBLE) AS n1, CAST(tn + tp AS DOUBLE) AS hits,
         coalesce(tn / CAST(nullif(tn + fn, 0) AS DOUBLE), 0) AS p0,
         coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS p1,
         coalesce(tn / CAST(nullif(tn + fp, 0) AS DOUBLE), 0) AS r0,
         coalesce(tp / CAST(nullif(fn + tp, 0) AS DOUBLE), 0) AS r1
  FROM confusion
)""",
        """SELECT round(hits / (n0 + n1), 9) AS accuracy,
                  round((p0 * n0 + p1 * n1) / (n0 + n1), 9) AS "precision",
                  round((r0 * n0 + r1 * n1) / (n0 + n1), 9) AS recall,
                  round((coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * n0
                         + coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * n1) / (n0 + n1), 9) AS f1
           FROM shares""",
    ),
    "auc": _with(_FEATURES, _auc("modelled", "fraud_probability")),
    "roc_curve": _with(
        f"""{_FEATURES},
by_score AS (
  SELECT fraud_probability AS score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg
  FROM modelled GROUP BY 1
),
points AS (
  SELECT CAST(0 AS BIGINT) AS point, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
  UNION ALL
  SELECT row_number() OVER (ORDER BY score DESC),
         sum(neg) OVER (ORDER BY score DESC) / CAST((SELECT sum(neg) FROM by_score) AS DOUBLE),
         sum(pos) OVER (ORDER BY score DESC) / CAST((SELECT sum(pos) FROM by_score) AS DOUBLE)
  FROM by_score
),
size AS (SELECT count(*) AS n, CASE WHEN count(*) <= 200 THEN 1 ELSE count(*) // 199 END AS step FROM points)""",
        """SELECT point, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM points, size
           WHERE point % step = 0 OR point = n - 1""",
    ),
    "best_model": _with(
        f"""{_FEATURES},
held AS (
  SELECT isFraud AS label, ((txn_id * 37) % 1000) / CAST(999 AS DOUBLE) AS alpha,
         ((txn_id * 91) % 1000) / CAST(999 AS DOUBLE) AS beta
  FROM featured WHERE {_SPLIT} = 'validation'
),
found AS (
  SELECT 'alpha' AS model_key, 0 AS position, (SELECT auc FROM ({_auc('held', 'alpha')})) AS validation_auc
  UNION ALL
  SELECT 'beta', 1, (SELECT auc FROM ({_auc('held', 'beta')}))
)""",
        """SELECT model_key, position, validation_auc,
                  CASE WHEN row_number() OVER (ORDER BY validation_auc DESC, position) = 1
                       THEN 'best' ELSE 'alternate' END AS role
           FROM found""",
    ),
    "stream_gold": _GOLD,
    "stream_silver": _with(_FEATURES, "SELECT *, isFraud AS label FROM featured"),
    "stream_batch_kpis": f"""SELECT kpi.*, n AS raw_rows, n - total_transactions AS dropped_rows, true AS several_batches
        FROM ({_KPIS}) AS kpi, (SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "stream_alerts": _with(_FEATURES, "SELECT * FROM payload"),
    "stream_kpi_counters": _with(_FEATURES, "SELECT * FROM counters"),
    "stream_fraud_share": _with(
        _RAW,
        """SELECT count(*) AS sent_rows, count(*) FILTER (isFraud = 1) AS fraud_rows,
                  round(count(*) FILTER (isFraud = 1) * CAST(100 AS DOUBLE) / count(*), 4) AS fraud_percent
           FROM raw""",
    ),
    "stream_window_kpis": """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type,
               count(*) AS event_count, round(sum(value), 2) AS total_value
        FROM (SELECT date_trunc('hour', ts) AS window_start, event_type, value FROM events)
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
        GROUP BY window_start, event_type""",
    "stream_window_counters": _with(
        _FEATURES,
        """SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, type,
                  count(*) AS total_transactions,
                  count(*) FILTER (is_alert = 1) AS total_fraud,
                  count(*) FILTER (is_ml_alert = 1) AS total_ml_alerts,
                  count(*) FILTER (is_rule_alert = 1) AS total_rule_alerts
           FROM (SELECT date_trunc('day', o_orderdate) AS window_start, scored.*
                 FROM scored JOIN orders ON o_orderkey = txn_id)
           WHERE window_start + INTERVAL 1 DAY
                 <= (SELECT max(o_orderdate) - INTERVAL 10 MINUTE FROM clean JOIN orders ON o_orderkey = txn_id)
           GROUP BY window_start, type""",
    ),
    "paced_replay_gold": _GOLD,
    "alert_sink_feed": _with(_FEATURES, "SELECT * FROM payload"),
    "newest_alerts": _with(
        _FEATURES,
        """SELECT payload.*, date_trunc('month', o_orderdate) + to_hours(txn_id % 3) AS processed_at
           FROM payload JOIN orders ON o_orderkey = txn_id
           ORDER BY processed_at DESC, step DESC, txn_id DESC LIMIT 50""",
    ),
    "stream_dedup_hot": """SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE event_id END AS key, 1 AS copies, true AS by_trigger
        FROM events GROUP BY 1""",
    "stream_dedup": "SELECT event_id, user_id, event_type, value FROM events",
    "csv_extra_columns": _with(_TYPED, "SELECT * EXCLUDE (txn_id), 'file' AS source FROM clean"),
    "amount_quantiles_approx": """SELECT level, true AS within_error
        FROM (VALUES ('p50'), ('p90'), ('p99'), ('p999')) AS l(level)""",
    "table_file_check": """SELECT true AS has_files, 0 AS empty_files, count(*) AS row_count,
        'o_comment_text' AS missing_columns FROM orders""",
    "replay_share_text_key": _with(
        _RAW,
        """SELECT sent_rows, fraud_rows, round(fraud_rows * CAST(100 AS DOUBLE) / sent_rows, 4) AS fraud_percent
           FROM (SELECT row_number() OVER by_key AS sent_rows, CAST(sum(isFraud) OVER by_key AS BIGINT) AS fraud_rows
                 FROM raw WINDOW by_key AS (ORDER BY md5(CAST(txn_id AS VARCHAR)) ROWS UNBOUNDED PRECEDING))
           WHERE sent_rows % 500 = 0""",
    ),
    "blacklist_forms": _with(
        _TYPED,
        """SELECT txn_id, hit AS by_name, hit AS by_rows, hit AS by_join
           FROM (SELECT txn_id, CAST(nameDest IN ('C7', 'C31') AS DOUBLE) AS hit FROM clean)""",
    ),
    "alert_json_off_type": _with(_FEATURES, "SELECT * FROM payload"),
    "gold_table_full": f"""SELECT gold.*, o_orderdate AS processed_at, strftime(o_orderdate, '%Y-%m-%d') AS dt,
        strftime(o_orderdate, '%H') AS hour FROM ({_GOLD}) AS gold JOIN orders ON o_orderkey = txn_id""",
    "random_split": _with(
        _FEATURES,
        """SELECT split, (SELECT count(*) FROM prepared) AS total_rows, true AS near_share
           FROM (VALUES ('train'), ('validation'), ('test')) AS s(split)""",
    ),
    "stratified_sample": _with(
        _FEATURES,
        """SELECT label, count(*) AS row_count FROM prepared
           WHERE CAST('0x' || substr(md5('42|' || CAST(txn_id AS VARCHAR)), 1, 8) AS BIGINT)
                 < CAST(round(0.2 * 4294967296) AS BIGINT)
           GROUP BY label""",
    ),
    "train_compare": _compared("interactive"),
    "train_full": _compared("full"),
    "saved_model_eval": """SELECT model, true AS same_as_trained, true AS in_range
        FROM (VALUES ('best'), ('alternate')) AS m(model)""",
    "training_runs": _with(
        _FEATURES,
        f"""SELECT 'run-1' AS run_id, model_key, split, metric, 'orders' AS data, 'interactive' AS profile,
                   CAST(1 AS DOUBLE) AS sample_fraction, 42 AS seed, CAST(0.7 AS DOUBLE) AS train_share,
                   CAST(0.15 AS DOUBLE) AS validation_share, CAST(0.15 AS DOUBLE) AS test_share,
                   split_rows, true AS in_range
            FROM (SELECT split, count(*) AS split_rows FROM (SELECT {_SPLIT} AS split FROM prepared)
                  WHERE split <> 'train' GROUP BY split), {_MODELS}, {_METRIC_NAMES}""",
    ),
    "deployed_metrics": f"""SELECT metric, true AS in_range, CAST(0 AS DOUBLE) AS difference FROM {_METRIC_NAMES}
        UNION ALL SELECT 'validation_' || metric, true, CAST(0 AS DOUBLE) FROM {_METRIC_NAMES}
        UNION ALL SELECT 'training_time_seconds', true, CAST(0 AS DOUBLE)""",
    "train_notebook": _compared("notebook"),
    "amount_quantiles_sketched": _with(
        _RAW,
        """SELECT 'all' AS days, count(amount) AS row_count, true AS within_error FROM raw
           UNION ALL
           SELECT 'year', count(amount), true FROM raw JOIN orders ON o_orderkey = txn_id WHERE year(o_orderdate) = 1995""",
    ),
    "stream_state_counters": _with(_FEATURES, "SELECT * FROM counters"),
    "stream_late_rows": "SELECT count(*) AS accounted, true AS some_late, true AS some_in_time FROM events",
    "stream_trigger_report": """SELECT count(*) AS input_rows, true AS one_row_per_batch, 2 AS ended, 0 AS failed
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "model_scored_kpis": _with(
        _FEATURES, "SELECT total_transactions, total_rule_alerts, true AS ml_alerts_bounded FROM counters"
    ),
    "stream_bronze": _with(
        _RAW,
        """SELECT step, trim(type) AS type, amount, trim(nameOrig) AS nameOrig, oldbalanceOrg, newbalanceOrig,
                  trim(nameDest) AS nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud, txn_id,
                  '007' AS run_id
           FROM raw""",
    ),
    "compacted_gold": f"SELECT *, '007' AS run_id FROM ({_GOLD})",
}
