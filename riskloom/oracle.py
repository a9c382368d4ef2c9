"""The same results as plain SQL over the test tables, for DuckDB."""

from __future__ import annotations

ACCOUNTS = """
accounts AS (
  SELECT CAST(c_custkey AS INT) AS account_id, c_name AS customer_id,
         c_acctbal AS init_balance, n_name AS country, c_mktsegment AS account_type,
         CAST(NULL AS BOOLEAN) AS is_fraud, CAST(c_custkey % 10 AS INT) AS tx_behavior_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 17 <> 0
)"""

TX = """
tx AS (
  SELECT event_id AS tx_id, CAST(user_id AS INT) AS sender_account_id,
         CAST((user_id * 7 + event_id) % 1000 AS INT) AS receiver_account_id,
         event_type AS tx_type, value AS tx_amount,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         (value > 150 OR CAST(json_extract_string(props, '$.k') AS INT) >= 98) AS is_fraud
  FROM events
)"""

JOINED = """
joined AS (
  SELECT tx.*, init_balance, country, account_type, tx_behavior_id
  FROM tx LEFT JOIN accounts ON sender_account_id = account_id
)"""

SCORED = """
scored AS (
  SELECT tx_id, sender_account_id, receiver_account_id, tx_type, tx_amount, ts,
         CAST(is_fraud AS INT) AS label,
         1/(1+exp(-(-6.0 + 1.2*ln(1+tx_amount)
                    + 0.1*sin((ts % 86400)*(2*pi()/86400))))) AS score
  FROM tx
),
decided AS (
  SELECT *, 0.52 AS threshold, score >= 0.52 AS is_fraud FROM scored
)"""

WINDOWS = """
windowed AS (
  SELECT *,
    lag(ts) OVER (PARTITION BY sender_account_id ORDER BY ts, tx_id) AS prev_ts,
    count(*) OVER (PARTITION BY sender_account_id ORDER BY ts
                   RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS cnt_last_24h,
    avg(tx_amount) OVER (PARTITION BY sender_account_id) AS sender_avg_amount,
    stddev_samp(tx_amount) OVER (PARTITION BY sender_account_id) AS sender_std_amount
  FROM {source}
),
behaviour AS (
  SELECT *, coalesce(ts - prev_ts, 999999) AS time_since_last_tx FROM windowed
)"""

BATCH = (
    WINDOWS.format(source="decided")
    + """,
batched AS (
  SELECT *,
    1/(1+exp(-(-7.0 + 1.2*ln(1+tx_amount) + 1.0*score + 0.15*cnt_last_24h
               - 0.03*ln(1+time_since_last_tx)))) AS fraud_probability
  FROM behaviour
)"""
)

FREQ = """
freq AS (
  SELECT feature, value, CAST(row_number() OVER
    (PARTITION BY feature ORDER BY count(*) DESC, value) - 1 AS DOUBLE) AS idx
  FROM (
    SELECT 'tx_type' AS feature, tx_type AS value FROM {source}
    UNION ALL SELECT 'account_type', account_type FROM {source}
    UNION ALL SELECT 'country', country FROM {source}
  ) WHERE value IS NOT NULL GROUP BY feature, value
),
vocab AS (SELECT feature, CAST(count(*) AS DOUBLE) AS size FROM freq GROUP BY feature)"""

CATEGORIES = """
categories AS (
  SELECT feature, value, CAST(row_number() OVER
    (PARTITION BY feature ORDER BY value) - 1 AS INT) AS idx
  FROM (
    SELECT DISTINCT 'tx_type' AS feature, tx_type AS value FROM joined
    UNION SELECT DISTINCT 'account_type', account_type FROM joined
    UNION SELECT DISTINCT 'country', country FROM joined
    UNION SELECT DISTINCT 'tx_behavior_id', CAST(tx_behavior_id AS VARCHAR) FROM joined
  ) WHERE value IS NOT NULL
)"""

# cumulative counts at every distinct score
CURVE = """
by_score AS (
  SELECT s AS threshold, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q
  FROM (SELECT {score} AS s, label FROM decided) GROUP BY s
),
curve AS (
  SELECT threshold,
    CAST(sum(p) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
    CAST(sum(q) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
    CAST(sum(p) OVER () AS BIGINT) AS positives
  FROM by_score
)"""

UUID = "substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||substr({h},17,4)||'-'||substr({h},21,12)"
ALERT_ID = "CASE WHEN is_fraud THEN {} END AS alert_id".format(
    UUID.format(h="md5('alert:' || CAST(tx_id AS VARCHAR))")
)
FRACTION = "CAST('0x' || substr(md5('{seed}:' || CAST(tx_id AS VARCHAR)), 1, 8) AS BIGINT)"
# adding zero turns a rounded -0.0 into 0.0, as Spark's round gives it
SIN = "round(sin((ts % 86400) * (2*pi()/86400)), 6) + 0.0::DOUBLE"
COS = "round(cos((ts % 86400) * (2*pi()/86400)), 6) + 0.0::DOUBLE"
LN1P = "CASE WHEN {x} > -1 THEN ln(1 + {x}) END"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _spline() -> str:
    """b0..b7 of the log amount between its own minimum and maximum, by the recursion of
    B-splines: each degree is a blend of two neighbours of the degree below."""
    steps = f"""n0 AS (
  SELECT tx_id, u, {", ".join(f"CAST(u >= {j - 3} AND u < {j - 2} AS DOUBLE) AS s{j}" for j in range(11))}
  FROM placed)"""
    for k in (1, 2, 3):
        blends = ", ".join(
            f"((u - ({j - 3})) * s{j} + ({j - 2 + k} - u) * s{j + 1}) / {k} AS s{j}"
            for j in range(11 - k)
        )
        steps += f", n{k} AS (SELECT tx_id, u, {blends} FROM n{k - 1})"
    columns = ", ".join(f"round(s{j}, 6) AS b{j}" for j in range(8))
    return (
        _with(TX)
        + f""", placed AS (
  SELECT tx_id, 5 * (x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) AS u
  FROM (SELECT tx_id, ln(1 + tx_amount) AS x FROM tx)), {steps}
SELECT tx_id, {columns} FROM n3"""
    )


def _subsample(rows: int) -> str:
    return (
        _with(TX)
        + f"""SELECT tx_id, label FROM (
  SELECT tx_id, label, sum(label) OVER () AS n_pos,
    row_number() OVER (PARTITION BY label ORDER BY {FRACTION.format(seed=42)}, tx_id) AS rn
  FROM (SELECT tx_id, CAST(is_fraud AS INT) AS label FROM tx))
WHERE label = 1 OR rn <= greatest({rows} - n_pos, 0)"""
    )


def _split(seed: int, cases: str) -> str:
    return (
        _with(TX)
        + f"""SELECT tx_id, CASE {cases} END AS split FROM (
  SELECT tx_id, {FRACTION.format(seed=seed)} / 4294967296.0 AS r FROM tx)"""
    )


def _history(key: str) -> str:
    return (
        _with(TX)
        + f"""SELECT {key}, tx_id, ts, rn FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, tx_id) AS INT) AS rn
  FROM tx) WHERE rn <= 5"""
    )


def _clustered(key: str) -> str:
    return (
        _with(TX)
        + f"""SELECT {key}, ts, tx_id,
  CAST(row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, tx_id) AS INT) AS nth FROM tx"""
    )


def _metrics(select: str) -> str:
    return (
        _with(TX, SCORED)
        + f""", counts AS (
  SELECT count(*) FILTER (label = 1 AND is_fraud) AS tp,
         count(*) FILTER (label = 0 AND is_fraud) AS fp,
         count(*) FILTER (label = 1 AND NOT is_fraud) AS fn,
         count(*) FILTER (label = 0 AND NOT is_fraud) AS tn
  FROM decided)
SELECT {select} FROM counts"""
    )


FACT = "sender_account_id, receiver_account_id, tx_type, tx_amount, is_fraud"
SPEED_REF = (
    "score >= threshold AS is_fraud_speed, round(score, 6) AS speed_layer_score,"
    " CAST(threshold AS DOUBLE) AS speed_layer_treshold"
)
_BATCH_FACT = (
    _with(TX, SCORED, BATCH)
    + f"""SELECT tx_id, {FACT}, {SPEED_REF}, {ALERT_ID} FROM
  (SELECT * REPLACE (fraud_probability > 0.5 AS is_fraud) FROM batched)"""
)
_FACT = _with(TX, SCORED) + f"SELECT tx_id, {FACT}, {ALERT_ID} FROM decided"
_SPEED = (
    _with(TX, ACCOUNTS, SCORED)
    + """SELECT tx_id, round(score, 6) AS score, is_fraud
FROM (SELECT d.* FROM decided d JOIN accounts ON sender_account_id = account_id)"""
)
_BEHAVIOUR = _with(TX, WINDOWS.format(source="tx"))
_USABLE = (
    """
usable_joined AS (
  SELECT b.*, init_balance, country, account_type
  FROM behaviour b JOIN accounts ON sender_account_id = account_id WHERE init_balance > -1
)"""
)


_MATCHED = """, predictions AS (
  SELECT * REPLACE (tx_amount + CASE WHEN tx_id % 11 = 0 THEN 1e-3
                                     WHEN tx_id % 2 = 0 THEN 4e-7 ELSE 0.0 END AS tx_amount)
  FROM scored),
labelled AS (
  SELECT tx.* FROM tx, range(3) r(i) WHERE i = 0 OR tx_id % 97 = 0),
matched AS (
  SELECT p.tx_id, p.score, any_value(p.sender_account_id) AS sender_account_id,
    t.is_fraud AS tx_is_fraud, count(*) AS n_matches
  FROM predictions p JOIN labelled t
    ON p.sender_account_id = t.sender_account_id AND p.receiver_account_id = t.receiver_account_id
   AND p.tx_type = t.tx_type AND p.ts = t.ts AND abs(p.tx_amount - t.tx_amount) < 1e-6
  GROUP BY p.tx_id, p.score, t.is_fraud, t.tx_amount)
"""


def oracle_sql() -> dict[str, str]:
    cnt_columns = "round(sender_avg_amount, 8) AS sender_avg_amount, round(sender_std_amount, 8) AS sender_std_amount"
    enriched = "tx.*, init_balance, country, account_type"
    safe = "CASE WHEN {b} > 0 THEN ({a}) / ({b}) ELSE 0.0 END"
    recall, specificity = safe.format(a="tp", b="tp+fn"), safe.format(a="tn", b="tn+fp")
    fraud, legit = safe.format(a="2.0*tp", b="2*tp+fp+fn"), safe.format(a="2.0*tn", b="2*tn+fp+fn")
    slot = "coalesce({f}.idx, (SELECT size FROM vocab WHERE feature = '{n}'))"

    def idx(feature: str, source: str) -> str:
        return (
            f"LEFT JOIN freq f_{feature} ON f_{feature}.feature = '{feature}'"
            f" AND f_{feature}.value = {source}.{feature}"
        )

    features = ["tx_type", "account_type", "country"]
    return {
        "accounts_scan": _with(ACCOUNTS)
        + "SELECT account_id, init_balance, country, account_type FROM accounts",
        "accounts_import": _with(ACCOUNTS) + "SELECT * FROM accounts",
        "accounts_upsert": _with(ACCOUNTS)
        + """SELECT * REPLACE (
  CASE WHEN account_id % 5 = 0 THEN init_balance + 1000 ELSE init_balance END AS init_balance)
FROM accounts""",
        "accounts_first": _with(ACCOUNTS)
        + """, doubled AS (
  SELECT * FROM accounts UNION ALL
  SELECT * REPLACE (customer_id || '-b' AS customer_id) FROM accounts WHERE account_id % 13 = 0)
SELECT account_id, customer_id, init_balance, country, account_type, tx_behavior_id FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY customer_id) AS rn FROM doubled)
WHERE rn = 1""",
        "row_count": "SELECT count(*) AS n_rows FROM events",
        "tx_flatten": _with(TX, SCORED)
        + """SELECT tx_id, round(score, 6) AS score, CAST(threshold AS DOUBLE) AS threshold,
  sender_account_id AS sender_id, receiver_account_id AS receiver_id, tx_type, tx_amount,
  ts AS timestamp FROM decided""",
        "pred_flatten": _with(TX, SCORED)
        + """SELECT tx_id, is_fraud AS fraud_prediction, round(score, 6) AS score,
  CAST(threshold AS DOUBLE) AS threshold, sender_account_id, receiver_account_id, tx_type,
  tx_amount, ts FROM decided""",
        "payload_json": _with(TX, SCORED)
        + """SELECT tx_id, sender_account_id, tx_amount, is_fraud AS fraud_prediction,
  round(score, 6) AS score FROM decided""",
        "validate_split": """SELECT CASE WHEN event_id % 90 = 0 THEN 'malformed'
  WHEN event_id % 70 = 0 THEN 'bad_type' WHEN event_id % 50 = 0 THEN 'missing_field'
  ELSE 'valid' END AS status, count(*) AS n FROM events GROUP BY 1""",
        "feature_payload": _with(TX, ACCOUNTS, SCORED)
        + """SELECT sender_account_id, receiver_account_id, tx_type, tx_amount, ts, init_balance,
  country, account_type, round(score, 6) AS score
FROM scored LEFT JOIN accounts ON sender_account_id = account_id""",
        "enrich_left": _with(TX, ACCOUNTS)
        + f"SELECT {enriched} FROM tx LEFT JOIN accounts ON sender_account_id = account_id",
        "train_join": _with(TX, ACCOUNTS, JOINED) + "SELECT * FROM joined",
        "enrich_inner": _with(TX, ACCOUNTS)
        + f"SELECT {enriched} FROM tx JOIN accounts ON sender_account_id = account_id",
        "enrich_missing": _with(TX, ACCOUNTS)
        + """SELECT tx_id, sender_account_id FROM tx
WHERE sender_account_id NOT IN (SELECT account_id FROM accounts)""",
        "match_label": _with(TX, SCORED)
        + _MATCHED
        + """SELECT tx_id, round(score, 6) AS score, tx_is_fraud, n_matches FROM matched""",
        "match_pairs": _with(TX, SCORED)
        + _MATCHED
        + """SELECT p.tx_id, round(p.score, 6) AS score, t.is_fraud AS tx_is_fraud
FROM predictions p JOIN labelled t
  ON p.sender_account_id = t.sender_account_id AND p.receiver_account_id = t.receiver_account_id
 AND p.tx_type = t.tx_type AND p.ts = t.ts AND abs(p.tx_amount - t.tx_amount) < 1e-6""",
        "batch_runs": _with(TX, ACCOUNTS, SCORED, BATCH)
        + """SELECT tx_id, strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS dt,
  fraud_probability > 0.5 AS is_fraud, round(score, 6) AS speed_layer_score
FROM batched JOIN accounts ON sender_account_id = account_id WHERE init_balance > -1""",
        "batch_quarantine": _with(TX, ACCOUNTS, JOINED)
        + """, absent AS (
  SELECT unnest(list_filter([
    CASE WHEN init_balance IS NULL OR init_balance <= -1 THEN 'init_balance_log' END,
    CASE WHEN country IS NULL THEN 'country' END,
    CASE WHEN account_type IS NULL THEN 'account_type' END], lambda x: x IS NOT NULL)) AS reason
  FROM joined)
SELECT reason, count(*) AS n FROM absent GROUP BY reason""",
        "gam_fit": _with(TX, ACCOUNTS)
        + f""", parts AS (
  SELECT tx.*, country, account_type, tx_behavior_id, CAST(tx.is_fraud AS INT) AS label, {FRACTION.format(seed=42)} / 4294967296.0 < 0.8 AS train
  FROM tx JOIN accounts ON sender_account_id = account_id WHERE init_balance > -1)
SELECT count(*) FILTER (NOT train AND label = 1) AS positives,
  count(*) FILTER (NOT train AND label = 0) AS negatives,
  count(*) FILTER (train) AS n_train,
  round(sum(10 * label) FILTER (train) / sum(CASE label WHEN 1 THEN 10 ELSE 1 END) FILTER (train), 9)
    AS train_share,
  -- two splines of 8, sine and cosine, a slot a category, the intercept
  19 + count(DISTINCT tx_type) FILTER (train) + count(DISTINCT account_type) FILTER (train)
    + count(DISTINCT tx_behavior_id) FILTER (train)
    -- the 20 most frequent countries, and one slot for the others
    + least(21, count(DISTINCT country) FILTER (train)) AS n_coefficients,
  true AS stationary, true AS calibrated
FROM parts""",
        "gbt_fit": _with(TX, ACCOUNTS, SCORED)
        + _MATCHED
        + f""", parts AS (
  SELECT tx_is_fraud AS y, {FRACTION.format(seed=1212)} / 4294967296.0 AS r
  FROM matched JOIN accounts ON sender_account_id = account_id WHERE init_balance > -1)
SELECT count(*) FILTER (r >= 0.95 AND y) AS positives,
  count(*) FILTER (r >= 0.95 AND NOT y) AS negatives,
  count(*) FILTER (r < 0.9) AS n_train, count(*) FILTER (r >= 0.9 AND r < 0.95) AS n_dev,
  count(*) FILTER (r >= 0.95) AS n_test, true AS ranks, true AS patient, true AS best_kept
FROM parts""",
        "hpo": _with(TX, ACCOUNTS)
        + f""", train AS (
  SELECT tx_id, row_number() OVER (ORDER BY {FRACTION.format(seed=1212)}, tx_id) AS nth
  FROM tx JOIN accounts ON sender_account_id = account_id
  WHERE init_balance > -1 AND {FRACTION.format(seed=1212)} / 4294967296.0 < 0.9),
folds AS (
  SELECT count(*) FILTER (k = 0) AS fold_0, count(*) FILTER (k = 1) AS fold_1,
    count(*) FILTER (k = 2) AS fold_2
  FROM (SELECT floor({FRACTION.format(seed=1213)} / 4294967296.0 * 3) AS k
        FROM train WHERE nth <= 10000)),
drawn AS (
  SELECT a.i AS a, b.i AS b, c.i AS c, d.i AS d, e.i AS e
  FROM range(1, 5) a(i), range(1, 5) b(i), range(1, 5) c(i), range(1, 5) d(i), range(1, 5) e(i)
  ORDER BY md5('1212:' || concat_ws(',', a.i - 1, b.i - 1, c.i - 1, d.i - 1, e.i - 1)) LIMIT 40)
SELECT ([0.01, 0.1, 0.5, 1.0]::DOUBLE[])[a] AS stepSize, ([5, 10, 15, 20]::BIGINT[])[b] AS maxDepth,
  ([0.0, 0.1, 0.5, 1.0]::DOUBLE[])[c] AS minInfoGain,
  ([0.25, 0.5, 0.75, 1.0]::DOUBLE[])[d] AS subsamplingRate,
  ([1, 10, 100, 1000]::BIGINT[])[e] AS minInstancesPerNode, fold_0, fold_1, fold_2,
  150::BIGINT AS n_trees, true AS in_range, true AS not_above_best, true AS beats_flagging_all
FROM drawn, folds""",
        "time_features": _with(TX)
        + f"""SELECT tx_id, {SIN} AS tx_time_sin, {COS} AS tx_time_cos FROM tx""",
        "log_features": _with(TX, ACCOUNTS, JOINED)
        + f"""SELECT tx_id, round({LN1P.format(x='tx_amount')}, 6) AS tx_amount_log,
  round({LN1P.format(x='init_balance')}, 6) AS init_balance_log FROM joined""",
        "behavioral": _BEHAVIOUR
        + f"SELECT tx_id, time_since_last_tx, cnt_last_24h, {cnt_columns} FROM behaviour",
        "batch_incremental": _with(TX, ACCOUNTS)
        + """, days AS (SELECT *, strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS dt FROM tx),
seen AS (
  SELECT *, lag(ts) OVER (PARTITION BY sender_account_id ORDER BY ts, tx_id) AS prev,
    count(*) OVER (PARTITION BY sender_account_id ORDER BY ts
                   RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS cnt_last_24h,
    avg(tx_amount) OVER (PARTITION BY sender_account_id ORDER BY dt
                         RANGE UNBOUNDED PRECEDING) AS mean
  FROM days)
SELECT tx_id, dt, coalesce(ts - prev, 999999) AS time_since_last_tx, cnt_last_24h,
  round(mean, 8) AS sender_avg_amount
FROM seen JOIN accounts ON sender_account_id = account_id
WHERE init_balance > -1
  AND CAST(dt AS DATE) >= (SELECT CAST(max(dt) AS DATE) - 6 FROM days)""",
        "lag_gap": _BEHAVIOUR + "SELECT tx_id, prev_ts, time_since_last_tx FROM behaviour",
        "cnt_24h": _BEHAVIOUR + "SELECT tx_id, cnt_last_24h FROM behaviour",
        "sender_stats": _BEHAVIOUR + f"SELECT tx_id, {cnt_columns} FROM behaviour",
        "spline_basis": _spline(),
        "country_counts": _with(TX, ACCOUNTS, JOINED)
        + "SELECT country, count(*) AS n FROM joined WHERE country IS NOT NULL GROUP BY country",
        "top_countries": _with(TX, ACCOUNTS, JOINED)
        + """SELECT country, count(*) AS n FROM joined WHERE country IS NOT NULL
GROUP BY country ORDER BY n DESC, country LIMIT 20""",
        "country_bucket": _with(TX, ACCOUNTS, JOINED)
        + """, top AS (
  SELECT country FROM joined WHERE country IS NOT NULL
  GROUP BY country ORDER BY count(*) DESC, country LIMIT 20)
SELECT tx_id, coalesce(top.country, 'OTHER') AS country_bucket
FROM joined LEFT JOIN top ON joined.country = top.country""",
        "category_index": _with(TX, ACCOUNTS, JOINED, CATEGORIES)
        + "SELECT feature, value, idx FROM categories",
        "freq_index": _with(TX, ACCOUNTS, JOINED, FREQ.format(source="joined"))
        + "SELECT DISTINCT j.tx_type, j.account_type, j.country, "
        + ", ".join(f"{slot.format(f=f'f_{n}', n=n)} AS {n}_idx" for n in features)
        + " FROM joined j "
        + " ".join(idx(n, "j") for n in features),
        "onehot": _with(TX, ACCOUNTS, JOINED, CATEGORIES)
        + """SELECT tx_id, c.feature, c.idx FROM (
  SELECT tx_id, 'tx_type' AS feature, tx_type AS value FROM joined
  UNION ALL SELECT tx_id, 'account_type', account_type FROM joined
  UNION ALL SELECT tx_id, 'country', country FROM joined
  UNION ALL SELECT tx_id, 'tx_behavior_id', CAST(tx_behavior_id AS VARCHAR) FROM joined) l
JOIN categories c ON l.feature = c.feature AND l.value = c.value""",
        "assemble": _with(
            TX,
            ACCOUNTS,
            SCORED,
            WINDOWS.format(source="decided"),
            _USABLE,
            FREQ.format(source="usable_joined"),
        )
        + f"""SELECT tx_id, round(ln(1+tx_amount), 6) AS f0, round(ln(1+init_balance), 6) AS f1,
  {SIN} AS f2, {COS} AS f3, round(score, 6) AS f4,
  CAST(time_since_last_tx AS DOUBLE) AS f5, CAST(cnt_last_24h AS DOUBLE) AS f6,
  round(sender_avg_amount, 8) AS f7, f_tx_type.idx AS f8, f_account_type.idx AS f9,
  f_country.idx AS f10 FROM usable_joined u """
        + " ".join(idx(n, "u") for n in features),
        "oversample": _with(
            TX,
            ACCOUNTS,
            SCORED,
            WINDOWS.format(source="decided"),
            _USABLE,
            FREQ.format(source="usable_joined"),
        )
        + f""", slots AS (
  SELECT tx_id, label, [ln(1 + tx_amount), ln(1 + init_balance), sin((ts % 86400) * (2*pi()/86400)),
    cos((ts % 86400) * (2*pi()/86400)), score, time_since_last_tx, cnt_last_24h, sender_avg_amount,
    f_tx_type.idx, f_account_type.idx, f_country.idx]::DOUBLE[11] AS v
  FROM usable_joined u {" ".join(idx(n, "u") for n in features)}),
pos AS (
  SELECT tx_id, v, row_number() OVER (ORDER BY {FRACTION.format(seed=1212)}, tx_id) AS nth
  FROM slots WHERE label = 1),
wanted AS (
  SELECT CAST(floor(0.7::DOUBLE * count(*) FILTER (label = 0)) AS BIGINT)
         - count(*) FILTER (label = 1) AS n, count(*) FILTER (label = 1) AS p FROM slots),
ranked AS (
  SELECT a.tx_id, array_distance(a.v, b.v) AS d,
    row_number() OVER (PARTITION BY a.tx_id ORDER BY array_distance(a.v, b.v)) AS k
  FROM pos a JOIN pos b ON a.tx_id <> b.tx_id),
groups AS (
  SELECT min(tx_id) OVER (PARTITION BY v) AS base,
    n // p + CASE WHEN nth <= n % p THEN 1 ELSE 0 END AS times
  FROM pos, wanted WHERE n > 0)
SELECT tx_id, label, FALSE AS synthetic, CAST(NULL AS BIGINT) AS base,
  CAST(NULL AS DOUBLE) AS reach, CAST(NULL AS BOOLEAN) AS between FROM slots
UNION ALL
SELECT NULL, 1, TRUE, base, round(d, 4), TRUE FROM
  (SELECT base, d, unnest(range(CAST(times AS BIGINT))) FROM groups JOIN ranked ON tx_id = base AND k = 5)""",
        "label_counts": _with(TX)
        + "SELECT CAST(is_fraud AS INT) AS label, count(*) AS n FROM tx GROUP BY 1",
        "fraud_rate": _with(TX)
        + "SELECT round(avg(CAST(is_fraud AS INT)), 6) AS fraud_rate FROM tx",
        "split_80_20": _split(42, "WHEN r < 0.8 THEN 'train' ELSE 'val'"),
        "split_90_5_5": _split(
            1212, "WHEN r < 0.9 THEN 'train' WHEN r < 0.95 THEN 'dev' ELSE 'test'"
        ),
        "subsample": _subsample(3000),
        "sample_weights": _with(TX)
        + "SELECT tx_id, CAST(CASE WHEN is_fraud THEN 10 ELSE 1 END AS DOUBLE) AS weight FROM tx",
        "score_linear": _with(TX, SCORED) + "SELECT tx_id, round(score, 6) AS score FROM scored",
        "score_batch": _with(TX, SCORED, BATCH)
        + "SELECT tx_id, round(fraud_probability, 6) AS score FROM batched",
        "decide_ge": _with(TX, SCORED)
        + "SELECT tx_id, round(score, 6) AS score, is_fraud FROM decided",
        "decide_gt": _with(TX, SCORED, BATCH)
        + """SELECT tx_id, round(fraud_probability, 6) AS score,
  fraud_probability > 0.5 AS is_fraud FROM batched""",
        "alerts": _with(TX, SCORED)
        + f"""SELECT 'FRAUD' AS alert_type, {ALERT_ID}, is_fraud, tx_id, sender_account_id,
  receiver_account_id, tx_type, tx_amount FROM decided WHERE is_fraud""",
        "tx_fact": _FACT,
        "tx_by_sender": _FACT,
        "tx_by_receiver": _FACT,
        "batch_tx_fact": _BATCH_FACT,
        "batch_tx_by_sender": _BATCH_FACT,
        "batch_tx_by_receiver": _BATCH_FACT,
        "batch_results": _with(TX, SCORED, BATCH)
        + """SELECT tx_id, sender_account_id AS sender, receiver_account_id AS receiver,
  tx_amount AS amount, round(fraud_probability, 6) AS fraud_probability,
  fraud_probability > 0.5 AS is_fraud FROM batched""",
        "clustered_transactions": "SELECT event_id AS tx_id, true AS in_order FROM events",
        "clustered_alerts": _with(TX, SCORED)
        + f"SELECT tx_id, {ALERT_ID}, true AS in_order FROM decided WHERE is_fraud",
        "clustered_by_sender": _clustered("sender_account_id"),
        "clustered_by_receiver": _clustered("receiver_account_id"),
        "stream_metrics": _with(TX, ACCOUNTS, SCORED)
        + """SELECT count(*) AS n_rows, count(account_id) AS n_scored,
  count(*) - count(account_id) AS n_rejected,
  count(*) FILTER (account_id IS NOT NULL AND is_fraud) AS n_flagged, max(ts) AS last_ts
FROM (SELECT d.*, account_id FROM decided d LEFT JOIN accounts ON sender_account_id = account_id)""",
        "sender_history": _history("sender_account_id"),
        "receiver_history": _history("receiver_account_id"),
        "layer_compare": _with(TX, SCORED, BATCH)
        + """SELECT is_fraud AS is_fraud_speed, fraud_probability > 0.5 AS is_fraud_batch,
  count(*) AS n FROM batched GROUP BY 1, 2""",
        "stream_score": _SPEED,
        "backfill": _SPEED,
        "confusion": _metrics("tp, fp, fn, tn, 0::BIGINT AS unjudged"),
        "class_metrics": _metrics(
            f"""round({safe.format(a='tp', b='tp+fp')}, 6) AS precision, round({recall}, 6) AS recall,
  round({fraud}, 6) AS f1_fraud, round({legit}, 6) AS f1_legit,
  round(({fraud} + {legit}) / 2, 6) AS f1_macro,
  round({safe.format(a='tp+tn', b='tp+fp+fn+tn')}, 6) AS accuracy"""
        ),
        "auc_hard": _metrics(f"round(({recall} + {specificity}) / 2, 6) AS auc"),
        "pr_curve": _with(TX, SCORED, CURVE.format(score="round(score, 3)"))
        + """SELECT threshold, tp, fp, round(tp / (tp + fp), 6) AS precision,
  round(CASE WHEN positives > 0 THEN tp / positives ELSE 1.0 END, 6) AS recall FROM curve""",
        "cost_threshold": _with(TX, SCORED, CURVE.format(score="score"))
        + """SELECT round(threshold, 6) AS threshold, tp, fp, cost FROM (
  SELECT *, CASE WHEN tp = 0 THEN positives ELSE 3 * fp + positives - tp END AS cost FROM curve)
ORDER BY cost, threshold LIMIT 1""",
        "f1_threshold": _with(TX, SCORED)
        + """, grid AS (SELECT 0.05::DOUBLE + i * (0.9::DOUBLE / 199) AS t FROM range(200) r(i)),
tested AS (
  SELECT t, CAST(count(*) FILTER (label = 1 AND score > t) AS DOUBLE) AS tp,
    count(*) FILTER (score > t) AS flagged, count(*) FILTER (label = 1) AS p
  FROM scored, grid GROUP BY t)
SELECT round(t, 6) AS threshold,
  round(CASE WHEN p + flagged > 0 THEN 2 * tp / (p + flagged) ELSE 0 END, 6) AS f1
FROM tested ORDER BY CASE WHEN p + flagged > 0 THEN 2 * tp / (p + flagged) ELSE 0 END DESC, t LIMIT 1""",
    }
