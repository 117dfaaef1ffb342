"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on the driver's views (region ... conversations) and must
produce the same column names and values as the Spark query.
"""

from __future__ import annotations

# Nothing of the library is imported here: a wrong constant or rule there must not come out right on both sides.


def three_band_sql(v: str) -> str:
    return f"CASE WHEN {v} IS NULL OR isnan({v}) THEN 'unknown' WHEN {v} < 12.0 THEN 'good' WHEN {v} < 35.4 THEN 'moderate' ELSE 'unhealthy' END"


def five_band_sql(v: str) -> str:
    return (
        f"CASE WHEN {v} IS NULL OR isnan({v}) THEN 'unknown' WHEN {v} < 12.0 THEN 'good' WHEN {v} < 35.0 THEN 'moderate' "
        f"WHEN {v} < 55.0 THEN 'unhealthy' WHEN {v} < 150.0 THEN 'very_unhealthy' ELSE 'hazardous' END"
    )


K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# measurements binding (see bindings.measurements)
M_SQL = f"""
SELECT event_type AS city,
       CAST(length(event_type) AS DOUBLE) * 7.5 - 40.0 AS latitude,
       CAST(ascii(event_type) AS DOUBLE) - 150.0 AS longitude,
       'UTC' AS timezone,
       ts AS "timestamp",
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS pm2_5,
       CAST(user_id AS DOUBLE) AS pm10,
       value * 10.0 AS carbon_monoxide,
       value / 4.0 AS nitrogen_dioxide,
       CAST(event_id % 50 AS DOUBLE) AS sulphur_dioxide,
       CAST((user_id * 7) % 120 AS DOUBLE) AS ozone,
       {K_SQL} AS us_aqi,
       ({K_SQL} * 7) % 600 AS european_aqi,
       event_id AS version,
       user_id AS station_id
FROM events
"""

LABEL3 = three_band_sql("pm2_5")
LABEL5 = five_band_sql("pm2_5")

# flattened rows of the landed hourly docs (ragged arrays padded with null)
FLAT_SQL = f"""
SELECT city, latitude, longitude, timezone,
       date_trunc('minute', "timestamp") AS "timestamp",
       pm2_5, pm10, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide,
       CASE WHEN hour(doc_hour) % 5 = 0 AND rev_pos = 1 THEN NULL ELSE ozone END AS ozone,
       us_aqi,
       CASE WHEN hour(doc_hour) % 7 = 0 THEN NULL ELSE european_aqi END AS european_aqi,
       'pm2_5' AS parameter,
       fetched AS fetch_timestamp,
       CAST(row_number() OVER (PARTITION BY city, station_block, doc_hour ORDER BY "timestamp", version) - 1 AS INTEGER) AS pos,
       "timestamp" AS ts_full, version, doc_hour
FROM (
  SELECT *,
         row_number() OVER (PARTITION BY city, station_block, doc_hour ORDER BY "timestamp" DESC, version DESC) AS rev_pos,
         max("timestamp") OVER (PARTITION BY city, station_block, doc_hour) AS fetched
  FROM (SELECT *, date_trunc('hour', "timestamp") AS doc_hour, station_id // 1024 AS station_block
        FROM ({M_SQL}) m0) m1
) d
"""

CURATED_COLS = (
    "city, latitude, longitude, timezone, \"timestamp\", pm2_5, pm10, carbon_monoxide, "
    "nitrogen_dioxide, sulphur_dioxide, ozone, us_aqi, european_aqi, parameter"
)

CURATED_SQL = f"""
SELECT {CURATED_COLS}, {LABEL3} AS air_quality_label, fetch_timestamp
FROM (
  SELECT *, row_number() OVER (PARTITION BY city, "timestamp" ORDER BY fetch_timestamp DESC, pos DESC) AS rn
  FROM ({FLAT_SQL}) f
) x WHERE rn = 1
"""

CUTOFF = "TIMESTAMP '2024-01-16 00:00:00'"

ORACLES: dict[str, str] = {}
ORACLES["curated_build"] = CURATED_SQL

DOCS_SQL = f"""
SELECT city, date_trunc('hour', "timestamp") AS doc_hour, any_value(latitude) AS latitude,
       any_value(longitude) AS longitude, max("timestamp") AS fetched, min("timestamp") AS first_ts,
       count(*) AS n
FROM ({M_SQL}) m GROUP BY city, station_id // 1024, date_trunc('hour', "timestamp")
"""

ORACLES["raw_json_scan"] = f"""
SELECT city, city AS city_name, latitude, longitude, 'UTC' AS timezone, fetched AS fetch_timestamp, n AS n_hours
FROM ({DOCS_SQL}) d
"""

ORACLES["land_raw_roundtrip"] = f"""
SELECT city, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_hours,
       min(strftime(fetched, '%Y-%m-%dT%H-%M-%S')) AS first_key,
       max(strftime(fetched, '%Y-%m-%dT%H-%M-%S')) AS last_key
FROM ({DOCS_SQL}) d GROUP BY city
"""

ORACLES["curated_scan"] = f"""
SELECT city, "timestamp", pm2_5, air_quality_label FROM ({CURATED_SQL}) c
WHERE city = 'click' AND pm2_5 > 50.0
"""

ORACLES["curated_write_roundtrip"] = f"""
SELECT city, count(*) AS n_rows, round(sum(pm2_5), 6) AS sum_pm2_5 FROM ({CURATED_SQL}) c
WHERE city <> 'view' OR pm2_5 > 100.0 GROUP BY city
"""

ORACLES["long_feed_explode"] = f"""
SELECT 'station-' || CAST(station_id AS VARCHAR) AS location, city, 'XX' AS country, 'pm25' AS parameter,
       pm2_5 AS value, 'ug/m3' AS unit, "timestamp" AS ts_utc, "timestamp" AS ts_local
FROM ({M_SQL}) m WHERE pm2_5 IS NOT NULL
"""

FEATS = "pm2_5, pm10, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone, us_aqi, european_aqi"

ORACLES["hourly_explode"] = f"""
SELECT city, "timestamp", {FEATS}, parameter, pos, fetch_timestamp FROM ({FLAT_SQL}) f
"""

ORACLES["parse_event_time"] = """
SELECT event_id,
       CASE WHEN event_id % 97 = 0 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%dT%H:%M') END AS time_raw,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE date_trunc('minute', ts) END AS "timestamp"
FROM events
"""

ORACLES["quality_label"] = f"SELECT version, pm2_5, {LABEL3} AS air_quality_label FROM ({M_SQL}) m"
ORACLES["quality_label_five_band"] = f"SELECT version, pm2_5, {LABEL5} AS air_quality_label FROM ({M_SQL}) m"

LM_SQL = f"SELECT *, {LABEL3} AS air_quality_label, 'pm2_5' AS parameter FROM ({M_SQL}) m"

ORACLES["prepare_training"] = f"""
SELECT {FEATS}, air_quality_label FROM ({LM_SQL}) x
WHERE air_quality_label IS NOT NULL AND air_quality_label <> 'unknown'
"""

REF_SQL = f"""
SELECT {FEATS}, air_quality_label FROM ({LM_SQL}) x
WHERE "timestamp" < {CUTOFF}
  AND pm2_5 IS NOT NULL AND pm10 IS NOT NULL AND carbon_monoxide IS NOT NULL AND nitrogen_dioxide IS NOT NULL
  AND sulphur_dioxide IS NOT NULL AND ozone IS NOT NULL AND us_aqi IS NOT NULL AND european_aqi IS NOT NULL
  AND air_quality_label IS NOT NULL
"""
ORACLES["reference_load"] = REF_SQL

ORACLES["align_features"] = f"""
SELECT version, pm2_5, pm10, 0.0::DOUBLE AS carbon_monoxide, 0.0::DOUBLE AS nitrogen_dioxide,
       0.0::DOUBLE AS sulphur_dioxide, ozone, CAST(us_aqi AS DOUBLE) AS us_aqi, 0.0::DOUBLE AS european_aqi
FROM ({M_SQL}) m
"""

VIEW_COLS = (
    "CAST(pm2_5 AS FLOAT) AS pm2_5, CAST(pm10 AS FLOAT) AS pm10, CAST(carbon_monoxide AS FLOAT) AS carbon_monoxide, "
    "CAST(nitrogen_dioxide AS FLOAT) AS nitrogen_dioxide, CAST(sulphur_dioxide AS FLOAT) AS sulphur_dioxide, "
    "CAST(ozone AS FLOAT) AS ozone, us_aqi, european_aqi"
)
ORACLES["feature_view_cast"] = f"""
SELECT city, "timestamp", version, {VIEW_COLS}, latitude, longitude, air_quality_label FROM ({LM_SQL}) x
"""
ORACLES["feature_service_training"] = f"""
SELECT city, "timestamp", {VIEW_COLS}, latitude, longitude, air_quality_label FROM ({LM_SQL}) x
"""
ORACLES["feature_service_inference"] = f"""
SELECT city, "timestamp", {VIEW_COLS} FROM ({LM_SQL}) x
"""


def _rules_sql():
    required = ("pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone")
    conds = [(f"({c} IS NULL OR {c} < 0 OR isnan({c}))", f"{c}:required:ge_0") for c in required]
    conds += [(f"({c} IS NOT NULL AND ({c} < 0 OR {c} > 500))", f"{c}:ge_0:le_500") for c in ("us_aqi", "european_aqi")]
    n = " + ".join(f"CAST(coalesce({b}, FALSE) AS INTEGER)" for b, _ in conds)
    names = ", ".join(f"CASE WHEN coalesce({b}, FALSE) THEN '{nm}' END" for b, nm in conds)
    return f"SELECT version, CAST({n} AS INTEGER) AS n_violations, concat_ws(',', {names}) AS violations FROM ({M_SQL}) m"


ORACLES["validate_rows"] = _rules_sql()

ORACLES["validate_batches"] = """
SELECT o_custkey AS batch_id, count(*) AS n, count(*) >= 1 AND count(*) <= 1000 AS valid
FROM orders GROUP BY o_custkey
"""

ORACLES["limit_per_entity"] = f"""
SELECT city, version, "timestamp", rank FROM (
  SELECT city, version, "timestamp",
         CAST(row_number() OVER (PARTITION BY city ORDER BY "timestamp" DESC, version DESC) AS INTEGER) AS rank
  FROM ({M_SQL}) m) x WHERE rank <= 100
"""

ORACLES["limit_per_entity_5000"] = ORACLES["limit_per_entity"].replace("rank <= 100", "rank <= 5000")

ORACLES["sanitize_name"] = "SELECT p_partkey, p_type, translate(p_type, ' /\\', '___') AS folder FROM part"

ORACLES["long_to_wide"] = f"""
SELECT city, "timestamp" AS ts, max(pm2_5) AS pm25, max(pm10) AS pm10, max(ozone) AS o3,
       max(nitrogen_dioxide) AS no2, max(sulphur_dioxide) AS so2, max(carbon_monoxide) AS co
FROM ({M_SQL}) m GROUP BY city, "timestamp"
"""

NR_SQL = "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"
ORACLES["dim_enrich"] = f"""
SELECT c_custkey, c_nationkey + 3 AS nation_key, d.n_name, d.r_name
FROM customer LEFT JOIN ({NR_SQL}) d ON c_nationkey + 3 = d.n_nationkey
"""
ORACLES["unknown_entities"] = f"""
SELECT c_custkey, c_nationkey + 3 AS nation_key FROM customer
WHERE NOT EXISTS (SELECT 1 FROM ({NR_SQL}) d WHERE d.n_nationkey = c_nationkey + 3)
"""

SPINE_SQL = "SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'"
VIEWS_SQL = "SELECT user_id, ts AS view_ts, value AS view_value, event_id AS view_id FROM events WHERE event_type = 'view'"
ORACLES["asof_features_ttl"] = f"""
SELECT s.event_id, s.user_id, s.ts,
       CASE WHEN f.view_ts >= s.ts - INTERVAL 6 HOUR THEN f.view_value END AS view_value,
       CASE WHEN f.view_ts >= s.ts - INTERVAL 6 HOUR THEN f.view_id END AS view_id,
       CASE WHEN f.view_ts >= s.ts - INTERVAL 6 HOUR THEN f.view_ts END AS feature_timestamp
FROM ({SPINE_SQL}) s ASOF LEFT JOIN ({VIEWS_SQL}) f ON s.user_id = f.user_id AND s.ts >= f.view_ts
"""

LATEST_VIEWS_SQL = f"""
SELECT user_id, view_ts, view_value, view_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY view_ts DESC, view_id DESC) AS rn FROM ({VIEWS_SQL}) v
) x WHERE rn = 1
"""
ORACLES["latest_per_entity"] = LATEST_VIEWS_SQL

ORACLES["online_lookup"] = f"""
SELECT c_custkey,
       CASE WHEN l.view_ts <= TIMESTAMP '2024-01-30 00:00:00' AND l.view_ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY
            THEN l.view_value END AS view_value,
       CASE WHEN l.view_ts <= TIMESTAMP '2024-01-30 00:00:00' AND l.view_ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY
            THEN l.view_ts END AS feature_timestamp
FROM customer LEFT JOIN ({LATEST_VIEWS_SQL}) l ON c_custkey = l.user_id
"""

ORACLES["label_counts"] = f"SELECT air_quality_label, count(*) AS count FROM ({LM_SQL}) x GROUP BY 1"
ORACLES["label_shares"] = f"""
SELECT air_quality_label, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM ({LM_SQL}) x WHERE pm2_5 IS NOT NULL GROUP BY 1
"""

ORACLES["stage_audit"] = f"""
SELECT 'flattened' AS stage, count(*) AS n_rows FROM events
UNION ALL SELECT 'loaded', count(*) FROM ({DOCS_SQL}) r
UNION ALL SELECT 'rejected', 0
UNION ALL SELECT 'saved', count(*) FROM ({CURATED_SQL}) c3
UNION ALL SELECT 'before_dedup', count(*) FROM events
UNION ALL SELECT 'after_dedup', count(*) FROM ({CURATED_SQL}) c
UNION ALL SELECT 'removed', (SELECT count(*) FROM events) - (SELECT count(*) FROM ({CURATED_SQL}) c2)
"""


def _ref_stats_sql():
    from ..config import FEATURES

    parts = []
    for f in FEATURES:
        parts.append(
            f"SELECT '{f}' AS feature, count(*) OVER () AS n_rows, CAST({f} AS DOUBLE) AS v FROM ({REF_SQL}) r"
        )
    u = " UNION ALL ".join(parts)
    return f"""
SELECT feature, any_value(n_rows) AS n_rows, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
       round(min(v), 6) AS min, round(max(v), 6) AS max, round(median(v), 6) AS median
FROM ({u}) u GROUP BY feature
"""


ORACLES["reference_stats"] = _ref_stats_sql()

ORACLES["payload_summary"] = f"""
SELECT city AS city_name, count(*) AS docs, CAST(sum(n) AS BIGINT) AS hours,
       min(strftime(first_ts, '%Y-%m-%dT%H:%M')) AS first_time, max(strftime(fetched, '%Y-%m-%dT%H:%M')) AS last_time
FROM ({DOCS_SQL}) d GROUP BY city
"""

ORACLES["ingest_summary"] = """
SELECT event_type AS city, count(*) AS records, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1
"""

ORACLES["dedup_latest"] = """
SELECT user_id, hour, event_id, value FROM (
  SELECT user_id, date_trunc('hour', ts) AS hour, event_id, value,
         row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn
  FROM events) x WHERE rn = 1
"""

ORACLES["union_feeds"] = f"""
SELECT 'hourly' AS source, city, "timestamp", pm2_5, pm10, NULL::DOUBLE AS ozone FROM ({FLAT_SQL}) f
UNION ALL
SELECT 'long', city, "timestamp", max(pm2_5), NULL::DOUBLE, max(ozone) FROM ({M_SQL}) m GROUP BY city, "timestamp"
"""

ORACLES["format_landing_key"] = "SELECT event_id, strftime(ts, '%Y-%m-%dT%H-%M-%S') AS landing_key FROM events"

ORACLES["json_props"] = f"""
SELECT event_id, {K_SQL} AS k, CAST(json_object('k', {K_SQL}, 'event_type', event_type) AS VARCHAR) AS json FROM events
"""

# ------------------------------------------------------------------ drift / quality / tests
CUR_SQL = f"SELECT {FEATS}, air_quality_label FROM ({LM_SQL}) x WHERE \"timestamp\" >= {CUTOFF}"
REF_ALL_SQL = f"SELECT {FEATS}, air_quality_label FROM ({LM_SQL}) x WHERE \"timestamp\" < {CUTOFF}"
LABEL_COL = "air_quality_label"


def _long(src, cols, side, cast):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {side} AS side, CAST({c} AS {cast}) AS value FROM ({src}) s" for c in cols
    )


def _status_sql(n_ref="n_ref", n_cur="n_cur"):
    return (
        f"CASE WHEN {n_ref} > 0 AND {n_cur} > 0 THEN 'ok' WHEN {n_ref} > 0 THEN 'no_current_data' "
        f"WHEN {n_cur} > 0 THEN 'no_reference_data' ELSE 'no_data' END"
    )


def _every_column_sql(pv_sql, feats, kind, test, threshold, statistic, score, drifted):
    """One row per requested column; ``pv_sql`` ends the WITH list with ``pv``."""
    names = ", ".join(f"('{f}')" for f in feats)
    return f"""
{pv_sql},
every AS (SELECT a.feature, pv.* EXCLUDE (feature, n_ref, n_cur), coalesce(pv.n_ref, 0) AS n_ref, coalesce(pv.n_cur, 0) AS n_cur
          FROM (VALUES {names}) a(feature) LEFT JOIN pv ON a.feature = pv.feature),
told AS (SELECT *, {_status_sql()} AS status FROM every)
SELECT feature, '{kind}' AS kind, '{test}' AS stattest,
       CASE WHEN status = 'ok' THEN round({statistic}, 6) END AS statistic,
       CASE WHEN status = 'ok' THEN round({score}, 6) END AS drift_score,
       CAST({threshold} AS DOUBLE) AS threshold,
       CASE WHEN status = 'ok' THEN {drifted} ELSE status <> 'no_data' END AS drift_detected,
       CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, status
FROM told
"""


def numeric_drift_sql(ref_sql, cur_sql, feats, test="wasserstein"):
    long = f"{_long(ref_sql, feats, 0, 'DOUBLE')} UNION ALL {_long(cur_sql, feats, 1, 'DOUBLE')}"
    return _every_column_sql(f"""
WITH l AS (SELECT * FROM ({long}) x WHERE value IS NOT NULL AND NOT isnan(value)),
counts AS (SELECT feature, value, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c_ref,
                  sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c_cur FROM l GROUP BY feature, value),
sizes AS (SELECT feature, CAST(sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n_ref,
                 CAST(sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS n_cur,
                 stddev_pop(CASE WHEN side = 0 THEN value END) AS ref_std FROM l GROUP BY feature),
rt AS (SELECT feature, value, sum(c_ref) OVER w AS cr, sum(c_cur) OVER w AS cc,
              lead(value) OVER (PARTITION BY feature ORDER BY value) AS nxt
       FROM counts WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
per AS (SELECT rt.feature, max(abs(cr / n_ref - cc / n_cur)) AS ks,
               sum(abs(cr / n_ref - cc / n_cur) * coalesce(nxt - value, 0.0)) AS w1,
               any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur, any_value(ref_std) AS ref_std
        FROM rt JOIN sizes USING (feature) GROUP BY rt.feature),
sc AS (SELECT *, ks * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS lam, w1 / greatest(ref_std, 0.001) AS wn FROM per),
pv AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(
          (SELECT sum(CASE WHEN t.j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * t.j * t.j * sc.lam * sc.lam))
           FROM range(1, 101) t(j)),
          0.0), 1.0) END AS p FROM sc)""", feats, "num", test,
        *((0.05, "ks", "p", "p < 0.05") if test == "ks" else (0.1, "wn", "wn", "wn >= 0.1")))


def categorical_drift_sql(ref_sql, cur_sql, cols, test="jensenshannon", terms=400):
    long = f"{_long(ref_sql, cols, 0, 'VARCHAR')} UNION ALL {_long(cur_sql, cols, 1, 'VARCHAR')}"
    return _every_column_sql(f"""
WITH l AS (SELECT * FROM ({long}) x WHERE value IS NOT NULL),
counts AS (SELECT feature, value, CAST(sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS c_ref,
                  CAST(sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS c_cur FROM l GROUP BY feature, value),
cc AS (SELECT c.*, s.n_ref, s.n_cur FROM counts c
       JOIN (SELECT feature, sum(c_ref) AS n_ref, sum(c_cur) AS n_cur FROM counts GROUP BY feature) s USING (feature)),
t AS (SELECT *, c_ref / n_ref AS p, c_cur / n_cur AS q, c_ref * n_cur / n_ref AS e FROM cc),
per AS (SELECT feature,
          sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2.0)) ELSE 0.0 END
                          + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2.0)) ELSE 0.0 END) / 2.0, 0.0)) AS js,
          sum(CASE WHEN e > 0 THEN (c_cur - e) * (c_cur - e) / e WHEN c_cur > 0 THEN 'inf'::DOUBLE ELSE 0.0 END) AS chi2,
          count(*) AS k, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur
        FROM t GROUP BY feature),
xa AS (SELECT *, chi2 / 2.0 AS x, CAST(k - 1 AS DOUBLE) / 2.0 AS a FROM per),
pv AS (SELECT *, CASE WHEN isnan(chi2) OR isinf(chi2) THEN 0.0 WHEN x <= 0 THEN 1.0
                      ELSE least(greatest(1.0 -
                           -- the lower incomplete gamma series, each term by its logarithm
                           (SELECT sum(exp(-xa.x + xa.a * ln(xa.x) - lgamma(xa.a + 1.0) + r.n * ln(xa.x) - r.cs)) FROM (
                              SELECT n, sum(CASE WHEN n = 0 THEN 0.0 ELSE ln(xa.a + n) END)
                                     OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs
                              FROM range(0, {terms} + 1) q(n)) r), 0.0), 1.0) END AS p
       FROM xa)""", cols, "cat", test,
        *((0.05, "chi2", "p", "p < 0.05") if test == "chisquare" else (0.1, "js", "js", "js >= 0.1")))


_F8 = [c.strip() for c in FEATS.split(",")]
DRIFT_SQL = numeric_drift_sql(REF_SQL, CUR_SQL, _F8)
ORACLES["drift_features"] = DRIFT_SQL
ORACLES["drift_sample_tests"] = (
    f"SELECT * FROM ({numeric_drift_sql(REF_ALL_SQL, CUR_SQL, _F8, test="ks")}) a UNION ALL "
    f"SELECT * FROM ({categorical_drift_sql(REF_ALL_SQL, CUR_SQL, [LABEL_COL], test="chisquare")}) b"
)


def dataset_sql(features_sql, share=0.5):
    return f"""
SELECT count(*) AS n_features, CAST(sum(CAST(drift_detected AS INTEGER)) AS BIGINT) AS n_drifted,
       round(avg(CAST(drift_detected AS DOUBLE)), 6) AS drift_score,
       coalesce(string_agg(CASE WHEN drift_detected THEN feature END, ',' ORDER BY CASE WHEN drift_detected THEN feature END), '') AS drifted_features,
       avg(CAST(drift_detected AS DOUBLE)) >= {share} AS drift_detected
FROM ({features_sql}) f
"""


ORACLES["drift_dataset"] = dataset_sql(DRIFT_SQL)
WIDE_SQL = "SELECT CAST(user_id % 300 AS VARCHAR) AS user_group, ts FROM events"
ORACLES["drift_chi2_wide"] = categorical_drift_sql(
    f"SELECT user_group FROM ({WIDE_SQL}) w WHERE ts < {CUTOFF}",
    f"SELECT user_group FROM ({WIDE_SQL}) w WHERE ts >= {CUTOFF}",
    ["user_group"], test="chisquare", terms=20000,
)
ORACLES["target_drift"] = categorical_drift_sql(REF_SQL, CUR_SQL, [LABEL_COL])


def dq_sql(src, numeric, categorical):
    parts = [f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS sval, CAST({c} AS DOUBLE) AS dval FROM ({src}) s" for c in numeric]
    parts += [f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS sval, NULL::DOUBLE AS dval FROM ({src}) s" for c in categorical]
    cols = ", ".join(list(numeric) + list(categorical))
    dup = f"(SELECT count(*) FROM ({src}) s3) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM ({src}) s2) d)"
    return f"""
WITH pv AS (SELECT col, sval, count(*) AS n, min(dval) AS dmin, max(dval) AS dmax, sum(dval) AS dsum
            FROM ({' UNION ALL '.join(parts)}) l GROUP BY col, sval),
s AS (SELECT col, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN sval IS NULL THEN n ELSE 0 END) AS BIGINT) AS n_null,
             count(CASE WHEN sval IS NOT NULL THEN 1 END) AS n_distinct, min(dmin) AS mn, max(dmax) AS mx,
             sum(dsum) / sum(CASE WHEN sval IS NOT NULL THEN n END) AS mean,
             max(CASE WHEN sval IS NOT NULL THEN n END) AS top FROM pv GROUP BY col)
SELECT col AS "column", n_rows, n_null, n_null / n_rows AS null_share, n_distinct, mn AS "min", mx AS "max", mean,
       top / (n_rows - n_null) AS most_common_share, n_distinct <= 1 AS is_constant, (n_rows - n_null) = 0 AS all_null,
       CAST({dup} AS BIGINT) AS duplicate_rows
FROM s
"""


def _rounded(sql, cols):
    sel = ", ".join(f"round({c}, 6) AS {c}" if c.strip('"') in cols else c for c in sql_cols(sql))
    return f"SELECT {sel} FROM ({sql}) r"


def sql_cols(sql):
    return ['"column"', "n_rows", "n_null", "null_share", "n_distinct", '"min"', '"max"', "mean", "most_common_share", "is_constant", "all_null", "duplicate_rows"]


DQ_ROUND = ["null_share", "min", "max", "mean", "most_common_share"]
ORACLES["data_quality"] = _rounded(dq_sql(f"SELECT {FEATS}, air_quality_label FROM ({LM_SQL}) x", _F8, [LABEL_COL]), DQ_ROUND)


def tests_sql(ref_sql, cur_sql, numeric, target):
    drift = (
        f"SELECT * FROM ({numeric_drift_sql(ref_sql, cur_sql, numeric)}) a UNION ALL "
        f"SELECT * FROM ({categorical_drift_sql(ref_sql, cur_sql, [target])}) b"
    )
    qr = dq_sql(ref_sql, numeric, [target])
    qc = dq_sql(cur_sql, numeric, [target])
    return f"""
WITH d AS ({drift}), r AS ({qr}), c AS ({qc}),
q AS (SELECT c."column", c.null_share AS c_ns, r.null_share AS r_ns, c.most_common_share AS c_mc, r.most_common_share AS r_mc,
             c.is_constant AS c_const, r.is_constant AS r_const, c.duplicate_rows AS c_dup, r.duplicate_rows AS r_dup, c.n_rows AS c_rows
      FROM c JOIN r USING ("column")),
tt AS (
  SELECT 'column_drift' AS name, feature AS "column", drift_score AS value, threshold AS bound,
         CASE WHEN drift_detected THEN 'FAIL' ELSE 'SUCCESS' END AS status FROM d
  UNION ALL
  SELECT 'share_of_missing_values', "column", c_ns, r_ns * 1.1,
         CASE WHEN c_ns <= r_ns * 1.1 + 1e-12 THEN 'SUCCESS' ELSE 'FAIL' END FROM q
  UNION ALL
  SELECT 'most_common_value_share', "column", c_mc, r_mc * 1.1,
         CASE WHEN coalesce(c_mc, 0.0) <= coalesce(r_mc, 0.0) * 1.1 + 1e-12 THEN 'SUCCESS' ELSE 'FAIL' END FROM q
  UNION ALL
  SELECT 'share_of_drifted_columns', NULL, s, 0.5, CASE WHEN s < 0.5 THEN 'SUCCESS' ELSE 'FAIL' END
  FROM (SELECT avg(CAST(drift_detected AS DOUBLE)) AS s FROM d) x
  UNION ALL
  SELECT 'number_of_constant_columns', NULL, cc, rc, CASE WHEN cc <= rc THEN 'SUCCESS' ELSE 'FAIL' END
  FROM (SELECT CAST(sum(CAST(c_const AS INTEGER)) AS DOUBLE) AS cc, CAST(sum(CAST(r_const AS INTEGER)) AS DOUBLE) AS rc FROM q) x
  UNION ALL
  SELECT 'number_of_duplicated_rows', NULL, cd, rd * 1.1, CASE WHEN cd <= rd * 1.1 THEN 'SUCCESS' ELSE 'FAIL' END
  FROM (SELECT CAST(any_value(c_dup) AS DOUBLE) AS cd, CAST(any_value(r_dup) AS DOUBLE) AS rd FROM q) x
  UNION ALL
  SELECT 'number_of_rows', NULL, cr, 0.0, CASE WHEN cr > 0 THEN 'SUCCESS' ELSE 'FAIL' END
  FROM (SELECT CAST(any_value(c_rows) AS DOUBLE) AS cr FROM q) x)
SELECT name, "column", round(CAST(value AS DOUBLE), 6) AS value, round(CAST(bound AS DOUBLE), 6) AS bound, status FROM tt
"""


ORACLES["monitoring_tests"] = f"""
SELECT t.*, CASE name
  WHEN 'column_drift' THEN 'The distribution of the column has not drifted from the reference.'
  WHEN 'share_of_missing_values' THEN 'The share of missing values is not above the reference''s by more than the tolerance.'
  WHEN 'most_common_value_share' THEN 'The share of the most common value is not above the reference''s by more than the tolerance.'
  WHEN 'share_of_drifted_columns' THEN 'Fewer than half of the columns have drifted.'
  WHEN 'number_of_constant_columns' THEN 'No more columns are constant than in the reference.'
  WHEN 'number_of_duplicated_rows' THEN 'No more rows are repeated than in the reference, within the tolerance.'
  WHEN 'number_of_rows' THEN 'The table has rows.' END AS description
FROM ({tests_sql(REF_SQL, CUR_SQL, _F8, LABEL_COL)}) t
"""
ORACLES["monitoring_report"] = f"""
SELECT 'drift_report_events' AS report_id, feature, stattest, drift_score, drift_detected FROM ({DRIFT_SQL}) d
"""

# ------------------------------------------------------------------ metrics on stored predictions
PRED_SQL = f"""
SELECT 'rule_' || CAST(m AS VARCHAR) AS model, event_id, {three_band_sql('value')} AS label,
       {three_band_sql('shifted')} AS prediction, sg / ((sg + sm) + su) AS p_good,
       sm / ((sg + sm) + su) AS p_moderate, su / ((sg + sm) + su) AS p_unhealthy
FROM (SELECT *, 1.0 / (1.0 + abs(shifted - 6.0)) AS sg, 1.0 / (1.0 + abs(shifted - 23.7)) AS sm,
             1.0 / (1.0 + abs(shifted - 60.0)) AS su
      FROM (SELECT event_id, value, m, value + CAST((event_id % 5) - 2 AS DOUBLE) * CAST(m AS DOUBLE) * 3.0 AS shifted
            FROM events, range(0, 5) r(m)) a) b
"""
CM_SQL = f"SELECT model, label, prediction, count(*) AS n FROM ({PRED_SQL}) p GROUP BY model, label, prediction"
ORACLES["confusion_matrix"] = CM_SQL

METRICS_RAW_SQL = f"""
WITH cm AS ({CM_SQL}),
pc AS (SELECT model, class, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
         SELECT model, label AS class, n AS support, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS tp FROM cm
         UNION ALL SELECT model, prediction, 0, n, 0 FROM cm) u GROUP BY model, class),
pc2 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM pc),
pc3 AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM pc2),
m AS (SELECT model, CAST(sum(support) AS DOUBLE) AS n, sum(tp) AS correct, sum(support * p) AS wp, sum(support * r) AS wr,
             sum(support * f) AS wf, sum(CAST(support AS DOUBLE) * CAST(predicted AS DOUBLE)) AS pe_raw FROM pc3 GROUP BY model)
SELECT model, correct / n AS accuracy, wr / n AS recall, wp / n AS prec, wf / n AS f1,
       CASE WHEN pe_raw / (n * n) < 1.0 THEN (correct / n - pe_raw / (n * n)) / (1.0 - pe_raw / (n * n)) ELSE 0.0 END AS kappa
FROM m
"""
ORACLES["classification_metrics"] = f"""
SELECT model, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall, round(prec, 6) AS prec,
       round(f1, 6) AS f1, round(kappa, 6) AS kappa FROM ({METRICS_RAW_SQL}) x
"""

AUC_RAW_SQL = f"""
WITH p AS ({PRED_SQL}),
pl AS (SELECT model, label, 'good' AS class, p_good AS score FROM p
       UNION ALL SELECT model, label, 'moderate', p_moderate FROM p
       UNION ALL SELECT model, label, 'unhealthy', p_unhealthy FROM p),
pre AS (SELECT model, class, score, sum(CASE WHEN label = class THEN 1 ELSE 0 END) AS n_pos,
               sum(CASE WHEN label = class THEN 0 ELSE 1 END) AS n_neg FROM pl GROUP BY model, class, score),
rt AS (SELECT *, sum(n_neg) OVER (PARTITION BY model, class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM pre),
pcl AS (SELECT model, class, sum(n_pos * (cum_neg - n_neg * 0.5)) AS u, sum(n_pos) AS P, sum(n_neg) AS N
        FROM rt GROUP BY model, class HAVING sum(n_pos) > 0 AND sum(n_neg) > 0)
SELECT model, sum(u / (CAST(P AS DOUBLE) * CAST(N AS DOUBLE)) * P) / sum(P) AS auc FROM pcl GROUP BY model
"""
ORACLES["auc_ovr"] = f"SELECT model, round(auc, 6) AS auc FROM ({AUC_RAW_SQL}) a"

BOARD_RAW_SQL = f"""
SELECT m.*, a.auc, CAST(row_number() OVER (ORDER BY m.f1 DESC NULLS LAST, m.model) AS INTEGER) AS rank
FROM ({METRICS_RAW_SQL}) m LEFT JOIN ({AUC_RAW_SQL}) a USING (model)
"""
_MR = "round(accuracy, 6) AS accuracy, round(auc, 6) AS auc, round(recall, 6) AS recall, round(prec, 6) AS prec, round(f1, 6) AS f1, round(kappa, 6) AS kappa"
ORACLES["leaderboard"] = f"SELECT model, {_MR}, rank FROM ({BOARD_RAW_SQL}) b WHERE rank <= 5"
ORACLES["select_model"] = f"""
SELECT model, {_MR}, rank, meets_criteria FROM (
  SELECT *, (f1 >= 0.75 AND coalesce(auc, -1.0) >= 0.95) AS meets_criteria FROM ({BOARD_RAW_SQL}) b WHERE rank <= 5
) x ORDER BY meets_criteria DESC, rank LIMIT 1
"""
ORACLES["prediction_join"] = f"""
SELECT p.model, p.event_id, p.prediction, {three_band_sql('e.value')} AS label,
       p.prediction = {three_band_sql('e.value')} AS correct
FROM ({PRED_SQL}) p JOIN events e ON p.event_id = e.event_id
"""
ORACLES["run_log_metrics"] = f"""
SELECT 'compare_models' AS run_name, k AS key, round(v, 6) AS value FROM (
  SELECT unnest(['best_accuracy', 'best_auc', 'best_recall', 'best_prec', 'best_f1', 'best_kappa']) AS k,
         unnest([accuracy, auc, recall, prec, f1, kappa]) AS v
  FROM ({BOARD_RAW_SQL}) b WHERE rank = 1) x
"""
ORACLES["latest_artifact"] = """
SELECT name, path, saved_at FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY saved_at DESC, path DESC) AS rn FROM (
    SELECT 'air_quality_' || event_type AS name, 'models/' || event_type || '/v' || CAST(event_id AS VARCHAR) AS path,
           ts AS saved_at FROM events) a) b WHERE rn = 1
"""

# ------------------------------------------------------------------ incremental
ORACLES["stream_curated"] = CURATED_SQL
ORACLES["stream_upsert"] = f"""
SELECT city, latitude, longitude, timezone, "timestamp", pm2_5, pm10, carbon_monoxide, nitrogen_dioxide,
       sulphur_dioxide, ozone, us_aqi, european_aqi, parameter, {three_band_sql('pm2_5')} AS air_quality_label,
       fetch_timestamp
FROM (
  SELECT * REPLACE (
           CASE WHEN CAST(fetch_timestamp AS DATE) = DATE '2024-01-10' THEN pm2_5 + 1000.0 ELSE pm2_5 END AS pm2_5,
           CASE WHEN CAST(fetch_timestamp AS DATE) = DATE '2024-01-10' THEN fetch_timestamp + INTERVAL 1 DAY ELSE fetch_timestamp END AS fetch_timestamp)
  FROM ({CURATED_SQL}) c
) x
"""
_REVISED_SQL = f"""
SELECT city, CASE WHEN CAST("timestamp" AS DATE) = DATE '2024-01-10' THEN pm2_5 + 1000.0 ELSE pm2_5 END AS pm2_5 FROM ({CURATED_SQL}) c
"""
ORACLES["upsert_snapshot"] = f"""
SELECT 1 AS version, city, count(*) AS n_rows, round(sum(pm2_5), 4) AS sum_pm2_5 FROM ({CURATED_SQL}) a GROUP BY city
UNION ALL SELECT 2, city, count(*), round(sum(pm2_5), 4) FROM ({_REVISED_SQL}) b GROUP BY city
UNION ALL SELECT 3, city, count(*), round(sum(pm2_5), 4)
FROM (SELECT * FROM ({_REVISED_SQL}) d UNION ALL SELECT 'again', pm2_5 FROM ({_REVISED_SQL}) e WHERE city = 'view') f GROUP BY city
"""
ORACLES["snapshot_diff"] = f"""
WITH c AS ({CURATED_SQL})
SELECT city, CASE city WHEN 'view' THEN 'removed' ELSE 'unchanged' END AS status, count(*) AS rows_before, CASE city WHEN 'view' THEN NULL ELSE count(*) END AS rows_after
FROM c GROUP BY city
UNION ALL SELECT 'view', 'added', NULL, count(*) FROM c WHERE city = 'view' AND pm2_5 > 100.0 HAVING count(*) > 0
UNION ALL SELECT 'new', 'added', NULL, count(*) FROM c WHERE city = 'click' HAVING count(*) > 0
"""
ORACLES["materialize_incremental"] = LATEST_VIEWS_SQL


def psi_sql(ref_sql, cur_sql, feats, bins=10, eps=1e-4, thr=0.2):
    """PSI on exact reference deciles (quantile_cont), shares floored at eps."""
    probs = [i / bins for i in range(1, bins)]
    parts = []
    for f in feats:
        qs = ", ".join(f"quantile_cont(CAST({f} AS DOUBLE), {p}) AS e{i}" for i, p in enumerate(probs))
        edges = f"(SELECT {qs} FROM ({ref_sql}) r WHERE {f} IS NOT NULL AND NOT isnan(CAST({f} AS DOUBLE)))"
        binexpr = " + ".join(f"CAST(e.e{i} < v AS INTEGER)" for i in range(len(probs)))
        both = (
            f"SELECT 0 AS side, CAST({f} AS DOUBLE) AS v FROM ({ref_sql}) a UNION ALL "
            f"SELECT 1, CAST({f} AS DOUBLE) FROM ({cur_sql}) b"
        )
        parts.append(
            f"""SELECT '{f}' AS feature, side, {binexpr} AS bin FROM ({both}) x, {edges} e
                WHERE v IS NOT NULL AND NOT isnan(v)"""
        )
    long = " UNION ALL ".join(parts)
    return f"""
WITH b AS ({long}),
c AS (SELECT feature, bin, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c_ref, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c_cur
      FROM b GROUP BY feature, bin),
t AS (SELECT c.*, sum(c_ref) OVER (PARTITION BY feature) AS n_ref, sum(c_cur) OVER (PARTITION BY feature) AS n_cur FROM c),
s AS (SELECT feature, greatest(c_ref / n_ref, {eps}) AS a, greatest(c_cur / n_cur, {eps}) AS q FROM t),
p AS (SELECT feature, sum((q - a) * ln(q / a)) AS psi FROM s GROUP BY feature)
SELECT d.feature, d.kind, 'psi' AS stattest, CASE WHEN d.status = 'ok' THEN round(p.psi, 6) END AS statistic,
       CASE WHEN d.status = 'ok' THEN round(p.psi, 6) END AS drift_score, CAST({thr} AS DOUBLE) AS threshold,
       CASE WHEN d.status = 'ok' THEN p.psi >= {thr} ELSE d.status <> 'no_data' END AS drift_detected, d.n_ref, d.n_cur, d.status
FROM ({numeric_drift_sql(ref_sql, cur_sql, feats)}) d LEFT JOIN p USING (feature)
"""


ORACLES["drift_psi"] = psi_sql(REF_SQL, CUR_SQL, _F8)

ORACLES["raw_rejects"] = """
SELECT CASE event_id % 3 WHEN 0 THEN 'corrupt_document' WHEN 1 THEN 'unparsable_time' ELSE 'non_integral_aqi' END AS reject_reason,
       count(*) AS n_rows
FROM events WHERE event_id % 10 = 0 GROUP BY ALL
"""
ORACLES["snapshot_manifest_rows"] = f"""
SELECT 'raw' AS side, count(*) AS rows, true AS same FROM ({DOCS_SQL}) r
UNION ALL SELECT 'curated', count(*), true FROM ({CURATED_SQL}) c
"""
_WAVE = f"SELECT {FEATS}, air_quality_label FROM ({LM_SQL}) x WHERE \"timestamp\" >= {CUTOFF} AND \"timestamp\" "
_SPLIT = "TIMESTAMP '2024-01-23 00:00:00'"
ORACLES["stream_drift"] = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS batch_id, feature, stattest, drift_score, drift_detected FROM ({numeric_drift_sql(REF_SQL, _WAVE + cond, _F8)}) d{i}"
    for i, cond in enumerate((f"< {_SPLIT}", f">= {_SPLIT}"))
)
ORACLES["monitoring_summary"] = f"""
SELECT count(*) AS total, count(*) FILTER (status = 'SUCCESS') AS passed, count(*) FILTER (status <> 'SUCCESS') AS failed,
       bool_and(status = 'SUCCESS') AS all_passed
FROM ({ORACLES["monitoring_tests"]}) t
"""
ORACLES["train_test_split"] = f"""
SELECT CAST('0x' || substr(md5(CAST(version AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 100 < 70 AS is_train, air_quality_label, count(*) AS n
FROM ({LM_SQL}) x WHERE air_quality_label IS NOT NULL AND air_quality_label <> 'unknown' GROUP BY ALL
"""
ORACLES["tune_trials"] = "SELECT CAST(20 AS BIGINT) AS n_trials, CAST(20 AS BIGINT) AS n_points, CAST(20 AS BIGINT) AS n_scored FROM (SELECT count(*) FROM events) e"
ORACLES["score_checks"] = """
SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_versions, count(*) AS n_known, count(*) AS n_sum_one, count(*) AS n_confident FROM events
"""
ORACLES["auc_ovr_ranges"] = ORACLES["auc_ovr"]

ORACLES["city_enrich"] = """
WITH c AS (SELECT * FROM (VALUES ('Bogota', 4.7110, -74.0721, 0), ('Buenos_Aires', -34.6037, -58.3816, 1), ('Lima', -12.0464, -77.0428, 2),
  ('Mexico_City', 19.4326, -99.1332, 3), ('Santiago', -33.4489, -70.6693, 4), ('Sao_Paulo', -23.5505, -46.6333, 5)) t(city, lat, lon, i))
SELECT event_id, coalesce(city, 'elsewhere') AS city,
       CASE WHEN event_id % 5 = 0 THEN value ELSE CAST(lat AS DOUBLE) END AS latitude,
       CASE WHEN event_id % 5 = 0 THEN -value ELSE CAST(lon AS DOUBLE) END AS longitude
FROM events LEFT JOIN c ON event_id % 8 = i
"""
ORACLES["stamp_fetch"] = f"SELECT 'Lima' AS city_name, '2024-02-01T00:00:00' AS fetch_timestamp, count(*) AS n_docs FROM ({DOCS_SQL}) d"
ORACLES["preview"] = f'SELECT city, "timestamp", version FROM ({M_SQL}) m ORDER BY "timestamp", version LIMIT 5'
ORACLES["quick_drift"] = ORACLES["drift_dataset"]

ORACLES["validate_predictions"] = f"""
SELECT model, CASE WHEN event_id % 13 = 0 THEN 'confidence:ge_0:le_1' ELSE '' END AS violations, count(*) AS n
FROM ({PRED_SQL}) p GROUP BY ALL
"""
ORACLES["ingest_runs"] = f"""
SELECT 'ingest_' || city AS run_name, 'events' AS source, true AS has_path, true AS has_time, CAST(count(*) AS DOUBLE) AS records
FROM ({M_SQL}) m GROUP BY city
"""
ORACLES["model_stages"] = f"""
SELECT 'DecisionTreeClassificationModel' AS model_type, 'pm2_5,pm10,carbon_monoxide,nitrogen_dioxide,sulphur_dioxide,ozone,us_aqi,european_aqi' AS features,
       (SELECT string_agg(DISTINCT l, ',' ORDER BY l) FROM (SELECT air_quality_label AS l FROM ({LM_SQL}) x WHERE air_quality_label <> 'unknown')) AS classes
"""
ORACLES["model_roundtrip_same"] = "SELECT count(*) AS n_rows, count(*) AS n_same FROM events"
ORACLES["training_size"] = f"""
SELECT count(*) AS n_samples, CAST(8 AS BIGINT) AS n_features, count(DISTINCT air_quality_label) AS n_classes
FROM ({LM_SQL}) x WHERE air_quality_label IS NOT NULL AND air_quality_label <> 'unknown'
"""
ORACLES["score_margins"] = ORACLES["score_checks"]
ORACLES["drift_stored_days"] = ORACLES["drift_features"]
