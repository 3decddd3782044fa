"""Oracle SQL (DuckDB dialect) for every catalog query.

Each query restates the operator independently in SQL over the raw
``events`` / ``embeddings`` views, starting from the same frames projection.
Floating outputs that depend on summation order are rounded on both sides;
lists are returned as joined text so results hash the same in both engines.
"""

from __future__ import annotations

from .. import config as C
from ..config import FIXTURE_CONFIG

_CFG = FIXTURE_CONFIG
_KNOWN = ", ".join(f"'{c}'" for c in _CFG.known_cameras)
_DIM = _CFG.embedding_dim
_W = _CFG.drift_window
_N5 = _CFG.qa_window_batches
# place of a feed in the configured order
_PLACE = f"list_position([{_KNOWN}], feed_id)"

FRAMES = r"""
ev AS (
  SELECT event_id, ts, value, event_id % (SELECT greatest(count(*), 1) FROM embeddings) AS vec,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(user_id % 16 AS INTEGER) AS cam,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS batch_round
  FROM events),
frames AS (
  SELECT ev.event_id AS seq,
         'camera_' || CAST(cam AS VARCHAR) AS feed_id,
         batch_round,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
         CASE WHEN event_id % 101 = 0 THEN 'cam_' || CAST(cam AS VARCHAR)
              ELSE 'camera_' || CAST(cam AS VARCHAR) END AS camera_id,
         'camera_' || CAST(cam AS VARCHAR) || '_b' || lpad(CAST(batch_round AS VARCHAR), 3, '0')
           || '_f' || CAST(event_id AS VARCHAR) AS frame_id,
         CASE WHEN cam = 2 AND batch_round >= 21 THEN value * CAST(0.05 AS DOUBLE)
              WHEN cam = 5 AND batch_round >= 15 THEN value + CAST(68.0 AS DOUBLE)
              ELSE value + CAST(8.0 AS DOUBLE) END AS brightness_avg,
         CASE WHEN cam = 5 AND batch_round >= 15
              THEN CAST(k - 1 AS DOUBLE) / CAST(100.0 AS DOUBLE) + CAST(0.4 AS DOUBLE)
              ELSE CAST(k - 1 AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS blur_metric,
         list_transform(
           CASE WHEN event_id % 97 = 0 THEN list_slice(CAST(e.embedding AS DOUBLE[]), 1, 32)
                ELSE CAST(e.embedding AS DOUBLE[]) END,
           lambda x: x * (CAST(1.0 AS DOUBLE) + CAST(k % 10 AS DOUBLE) / CAST(10.0 AS DOUBLE))
                       * (CASE WHEN cam = 5 AND batch_round >= 15 THEN CAST(2.0 AS DOUBLE)
                               ELSE CAST(1.0 AS DOUBLE) END)) AS embedding,
         ts AS event_ts
  FROM ev LEFT JOIN embeddings e ON e.vec_id = ev.vec)"""


def _fail(column: str, check: str, case: str) -> str:
    return f"{{'column': '{column}', 'check': '{check}', 'failure_case': {case}}}"


GATED = FRAMES + f""",
checked AS (
  SELECT *,
    list_filter([
      CASE WHEN "timestamp" IS NULL THEN {_fail('timestamp', 'not_nullable', 'NULL::VARCHAR')} END,
      CASE WHEN camera_id IS NULL THEN {_fail('camera_id', 'not_nullable', 'NULL::VARCHAR')} END,
      CASE WHEN camera_id IS NOT NULL AND NOT regexp_full_match(camera_id, 'camera_[0-9]+')
           THEN {_fail('camera_id', '_camera_id_valid', 'camera_id')} END,
      CASE WHEN frame_id IS NULL THEN {_fail('frame_id', 'not_nullable', 'NULL::VARCHAR')} END,
      CASE WHEN brightness_avg IS NULL OR isnan(brightness_avg)
           THEN {_fail('brightness_avg', 'not_nullable', 'NULL::VARCHAR')} END,
      CASE WHEN NOT (brightness_avg IS NULL OR isnan(brightness_avg))
                AND NOT (brightness_avg >= 10.0 AND brightness_avg <= 255.0)
           THEN {_fail('brightness_avg', '_brightness_valid', 'CAST(brightness_avg AS VARCHAR)')} END,
      CASE WHEN blur_metric IS NULL OR isnan(blur_metric)
           THEN {_fail('blur_metric', 'not_nullable', 'NULL::VARCHAR')} END,
      CASE WHEN NOT (blur_metric IS NULL OR isnan(blur_metric)) AND NOT (blur_metric >= 0.0)
           THEN {_fail('blur_metric', '_blur_valid', 'CAST(blur_metric AS VARCHAR)')} END,
      CASE WHEN embedding IS NULL THEN {_fail('embedding', 'not_nullable', 'NULL::VARCHAR')} END,
      CASE WHEN embedding IS NOT NULL AND len(embedding) <> {_DIM}
           THEN {_fail('embedding', '_embedding_has_expected_dim', 'CAST(len(embedding) AS VARCHAR)')} END
    ], lambda x: x IS NOT NULL) AS failed_rules
  FROM frames),
gated AS (SELECT *, len(failed_rules) = 0 AS is_valid FROM checked),
batches AS (
  SELECT feed_id, batch_round,
         arg_min(coalesce(camera_id, 'unknown'), seq) AS camera_id,
         CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid_count,
         CAST(count(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS quarantined_count,
         max("timestamp") AS last_timestamp
  FROM gated GROUP BY feed_id, batch_round),
batches_x AS (
  SELECT *,
    CASE WHEN quarantined_count = 0 THEN 'passed' WHEN valid_count = 0 THEN 'failed'
         ELSE 'partial_failure' END AS status,
    valid_count + quarantined_count AS total_count,
    CASE WHEN valid_count + quarantined_count = 0 THEN 0.0
         ELSE CAST(quarantined_count AS DOUBLE) / (valid_count + quarantined_count) END AS quarantine_rate
  FROM batches),
brk AS (
  SELECT feed_id, batch_round, camera_id, status, valid_count, quarantined_count,
    CAST(sum(quarantined_count) OVER w AS DOUBLE) AS _q,
    CAST(sum(valid_count + quarantined_count) OVER w AS DOUBLE) AS _t
  FROM batches_x WHERE camera_id IN ({_KNOWN})
  WINDOW w AS (PARTITION BY camera_id ORDER BY batch_round, {_PLACE}
               ROWS BETWEEN {_N5 - 1} PRECEDING AND CURRENT ROW)),
rated AS (
  SELECT * EXCLUDE (_q, _t),
         CASE WHEN _t = 0 THEN 0.0 ELSE _q / _t END AS rolling_quarantine_rate
  FROM brk)"""


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


Q: dict[str, str] = {}

Q["frames_scan"] = with_(FRAMES, """
SELECT seq, feed_id, batch_round, "timestamp", camera_id, frame_id, brightness_avg, blur_metric,
       CAST(len(embedding) AS INTEGER) AS embedding_dim,
       round(sqrt(list_reduce(list_transform(embedding, lambda x: x * x), lambda a, b: a + b)), 9) AS embedding_norm
FROM frames""")

Q["feed_subset"] = with_(FRAMES, """
SELECT seq, feed_id, batch_round, frame_id FROM frames
WHERE feed_id IN ('camera_1', 'camera_2', 'camera_3')""")

Q["unknown_feeds"] = with_(FRAMES, f"""
SELECT seq, feed_id, batch_round, camera_id, frame_id FROM frames
WHERE feed_id NOT IN ({', '.join(f"'{c}'" for c in _CFG.known_cameras[:12])})""")

Q["batch_numbering"] = with_(FRAMES, """
SELECT f.seq, f.feed_id, b.batch_number
FROM frames f JOIN (
  SELECT feed_id, bucket, CAST(dense_rank() OVER (PARTITION BY feed_id ORDER BY bucket) AS INTEGER) AS batch_number
  FROM (SELECT DISTINCT feed_id, date_trunc('hour', event_ts) AS bucket FROM frames)) b
ON f.feed_id = b.feed_id AND date_trunc('hour', f.event_ts) = b.bucket""")

Q["latest_batch"] = with_(FRAMES, """
SELECT feed_id, max(batch_round) AS batch_number,
       arg_max(frame_id, batch_round * 1000000000000 + seq) AS last_frame_id,
       CAST(count(*) AS BIGINT) AS frame_count
FROM frames GROUP BY feed_id""")

Q["clamp"] = with_(FRAMES, """
SELECT seq,
       least(greatest(brightness_avg, 10.0), 255.0) AS brightness_clamped,
       greatest(blur_metric, 0.0) AS blur_clamped
FROM frames""")


def _rule_query(flag_sql: str, col: str) -> str:
    return with_(FRAMES, f"""
SELECT seq, feed_id, batch_round, {col}, ({flag_sql}) AS passed FROM frames""")


Q["rule_brightness"] = _rule_query(
    "brightness_avg >= 10.0 AND brightness_avg <= 255.0 AND NOT isnan(brightness_avg)", "brightness_avg")
Q["rule_blur"] = _rule_query("blur_metric >= 0.0 AND NOT isnan(blur_metric)", "blur_metric")
Q["rule_camera_id"] = _rule_query("regexp_full_match(camera_id, 'camera_[0-9]+')", "camera_id")
Q["rule_embedding_dim"] = with_(FRAMES, f"""
SELECT seq, feed_id, batch_round, CAST(len(embedding) AS INTEGER) AS embedding_dim,
       len(embedding) = {_DIM} AS passed FROM frames""")
Q["rule_not_null"] = with_(FRAMES, """
SELECT seq, feed_id, batch_round,
  ("timestamp" IS NOT NULL AND camera_id IS NOT NULL AND frame_id IS NOT NULL
   AND NOT (brightness_avg IS NULL OR isnan(brightness_avg))
   AND NOT (blur_metric IS NULL OR isnan(blur_metric)) AND embedding IS NOT NULL) AS passed
FROM frames""")

Q["coerce_types"] = with_(FRAMES, """
SELECT seq, TRY_CAST(CAST(brightness_avg AS VARCHAR) AS DOUBLE) AS brightness_avg,
       TRY_CAST(CAST(blur_metric AS VARCHAR) AS DOUBLE) AS blur_metric,
       TRY_CAST(frame_id AS DOUBLE) AS frame_id_as_double
FROM frames""")

Q["rule_failures"] = with_(GATED, """
SELECT feed_id, batch_round, seq, r.column AS "column", r.check AS "check",
       TRY_CAST(r.failure_case AS DOUBLE) AS failure_value,
       CASE WHEN r.column = 'camera_id' THEN r.failure_case END AS failure_text
FROM (SELECT feed_id, batch_round, seq, unnest(failed_rules) AS r FROM gated)""")

Q["valid_frames"] = with_(GATED, """
SELECT seq, feed_id, batch_round, camera_id, frame_id, brightness_avg, blur_metric
FROM gated WHERE is_valid""")

Q["quarantined_frames"] = with_(GATED, """
SELECT seq, feed_id, batch_round, camera_id, frame_id, brightness_avg, blur_metric,
       CAST(len(failed_rules) AS INTEGER) AS n_rules,
       array_to_string(list_transform(failed_rules, lambda r: r.check), ',') AS checks
FROM gated WHERE NOT is_valid""")

Q["failure_alerts"] = with_(GATED, """
SELECT feed_id, batch_round, seq AS row_index, CAST(len(failed_rules) AS INTEGER) AS n_rules,
       array_to_string(list_transform(failed_rules, lambda r: r.column || ':' || r.check), ',') AS rules
FROM gated WHERE NOT is_valid""")

Q["qa_batches"] = with_(GATED, """
SELECT feed_id, batch_round, camera_id, status, valid_count, quarantined_count, total_count,
       round(quarantine_rate, 9) AS quarantine_rate
FROM batches_x""")

Q["batch_quarantine_rate"] = with_(GATED, """
SELECT feed_id, batch_round, total_count, round(quarantine_rate, 9) AS quarantine_rate FROM batches_x""")

Q["rule_failure_counts"] = with_(GATED, """
SELECT b.camera_id, f.batch_round, f.column AS "column", f."check" AS "check",
       CAST(sum(f.failures) AS BIGINT) AS failures
FROM (SELECT feed_id, batch_round, r.column AS column, r.check AS "check", count(*) AS failures
      FROM (SELECT feed_id, batch_round, unnest(failed_rules) AS r FROM gated WHERE NOT is_valid)
      GROUP BY ALL) f
JOIN batches b USING (feed_id, batch_round)
GROUP BY b.camera_id, f.batch_round, f.column, f."check\"""")

Q["quarantine_reasons"] = with_(GATED, """
SELECT g.feed_id, g.batch_round, g.seq AS row_index, g.camera_id, g.frame_id,
       array_to_string(list_transform(g.failed_rules, lambda r: r.check), ',') AS checks,
       b.last_timestamp AS quarantined_at
FROM gated g JOIN batches b USING (feed_id, batch_round) WHERE NOT g.is_valid""")

Q["row_rules_fallback"] = with_(GATED, f"""
SELECT feed_id, batch_round, seq, frame_id,
  CASE WHEN len(list_filter(failed_rules, lambda r: r.column <> 'blur_metric')) > 0
    THEN array_to_string(list_transform(list_filter(failed_rules, lambda r: r.column <> 'blur_metric'), lambda r: r.column || ':' || r.check), ',')
    ELSE 'blur_metric:{C.CHECK_COLUMN}' END AS rules
FROM gated WHERE NOT is_valid""")

Q["missing_column"] = with_(GATED, f"""
SELECT feed_id, batch_round,
  CASE WHEN count(*) FILTER (WHERE bad) = 0 THEN 'passed' WHEN count(*) FILTER (WHERE NOT bad) = 0 THEN 'failed'
       ELSE 'partial_failure' END AS status,
  count(*) FILTER (WHERE NOT bad) AS valid_count, count(*) FILTER (WHERE bad) AS quarantined_count,
  'blur_metric:{C.CHECK_COLUMN}' AS rules
FROM (SELECT feed_id, batch_round, len(list_filter(failed_rules, lambda r: r.column <> 'blur_metric')) > 0 AS bad FROM gated)
GROUP BY feed_id, batch_round""")

Q["unreadable_column"] = with_(GATED, """
SELECT feed_id, batch_round, arg_min(coalesce(camera_id, 'unknown'), seq) AS camera_id, 'error' AS status,
  count(*) FILTER (WHERE NOT bad) AS valid_count, count(*) FILTER (WHERE bad) AS quarantined_count
FROM (SELECT *, len(list_filter(failed_rules, lambda r: r.column <> 'embedding')) > 0 AS bad FROM gated)
GROUP BY feed_id, batch_round""")

Q["split_by_semi_anti"] = with_(GATED, """
SELECT seq, feed_id, batch_round, is_valid AS kept FROM gated""")

Q["failed_rows_distinct"] = with_(GATED, """
SELECT DISTINCT feed_id, batch_round, seq FROM gated WHERE NOT is_valid""")

Q["breaker_input"] = with_(GATED, f"""
SELECT feed_id, batch_round, camera_id, status, valid_count, quarantined_count
FROM batches_x WHERE camera_id IN ({_KNOWN})""")

Q["rolling_quarantine_rate"] = with_(GATED, """
SELECT camera_id, feed_id, batch_round, round(rolling_quarantine_rate, 9) AS rolling_quarantine_rate
FROM rated""")

Q["topology_batches"] = with_(GATED, f"""
SELECT b.camera_id, b.feed_id, b.batch_round, coalesce(p.place, 2147483647) AS place,
       round(CASE WHEN sum(valid_count + quarantined_count) OVER w = 0 THEN 0.0
             ELSE CAST(sum(quarantined_count) OVER w AS DOUBLE) / sum(valid_count + quarantined_count) OVER w END, 9) AS rolling_quarantine_rate
FROM batches_x b
JOIN (SELECT feed_id AS camera_id FROM frames GROUP BY 1 HAVING count(*) >= (SELECT avg(n) FROM (SELECT count(*) AS n FROM frames GROUP BY feed_id))) k
  ON b.camera_id = k.camera_id
LEFT JOIN (SELECT feed_id, CAST(count(*) AS INTEGER) AS place FROM frames GROUP BY 1
           HAVING count(*) >= (SELECT avg(n) FROM (SELECT count(*) AS n FROM frames GROUP BY feed_id))) p
  ON b.feed_id = p.feed_id
WINDOW w AS (PARTITION BY b.camera_id ORDER BY batch_round, coalesce(p.place, 2147483647), b.feed_id
             ROWS BETWEEN {_N5 - 1} PRECEDING AND CURRENT ROW)""")

Q["frame_id_format"] = with_(FRAMES, """
SELECT seq, printf('%s_b%03d_f%02d', feed_id, batch_round, seq) AS formatted_frame_id,
       printf('%s_b%03d_f%02d', feed_id, batch_round, seq) = frame_id AS same_as_source
FROM frames""")

Q["time_strings"] = with_(FRAMES, """
SELECT seq, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso_time,
       strftime(event_ts, '%Y%m%dT%H%M%S%fZ') AS compact_time
FROM frames""")

Q["rate_text"] = with_(GATED, """
SELECT feed_id, batch_round,
       printf('%.2f%%', quarantine_rate * 100.0) AS rate_percent,
       CAST(printf('%.4f', quarantine_rate) AS DOUBLE) AS rate_rounded
FROM batches_x""")

Q["custom_rule"] = with_(FRAMES, """
SELECT seq, feed_id, batch_round,
       NOT (brightness_avg > 60.0 AND blur_metric > 0.9) AS passed
FROM frames""")

Q["embedding_elements"] = with_(GATED, """
SELECT CAST(pos AS INTEGER) AS pos, round(avg(x), 9) AS mean_value, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos
      FROM gated WHERE is_valid)
GROUP BY pos""")

Q["union_batches"] = with_(GATED, """
SELECT feed_id, batch_round, seq FROM gated WHERE is_valid AND batch_round <= 15
UNION ALL
SELECT feed_id, batch_round, seq FROM gated WHERE is_valid AND batch_round > 15""")


# ---------------------------------------------------------------------------
# Drift (W2..W4, K1..K11, S7, A7, A11, O2)
# ---------------------------------------------------------------------------
_NORM = "sqrt(list_reduce(list_transform({e}, lambda x: x * x), lambda a, c: a + c))"

DRIFT = GATED + f""",
vrows AS (
  SELECT g.feed_id, g.batch_round, g.seq, b.camera_id,
         g.brightness_avg AS xb, g.blur_metric AS xl, {_NORM.format(e='g.embedding')} AS xn, g.embedding
  FROM gated g JOIN batches b USING (feed_id, batch_round)
  WHERE g.is_valid AND b.camera_id IN ({_KNOWN})),
posd AS (
  SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY batch_round, {_PLACE}, seq) AS p FROM vrows),
bstat AS (
  SELECT feed_id, batch_round, camera_id, valid_count,
         CAST(sum(valid_count) OVER (PARTITION BY camera_id ORDER BY batch_round, {_PLACE}
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS buffer_total
  FROM batches),
dstatus AS (
  SELECT feed_id, batch_round, camera_id, valid_count, buffer_total,
    CASE WHEN valid_count = 0 THEN 'skipped' WHEN camera_id NOT IN ({_KNOWN}) THEN 'skipped'
         WHEN buffer_total < {_W} THEN 'buffering' ELSE 'analyzed' END AS status,
    CASE WHEN valid_count = 0 THEN 'empty_input' WHEN camera_id NOT IN ({_KNOWN}) THEN 'unknown_camera' END AS reason,
    CAST(CASE WHEN valid_count = 0 THEN (CASE WHEN camera_id IN ({_KNOWN}) THEN buffer_total ELSE 0 END)
              WHEN camera_id NOT IN ({_KNOWN}) THEN NULL
              WHEN buffer_total < {_W} THEN buffer_total END AS BIGINT) AS buffer_size
  FROM bstat),
wrows AS (
  SELECT s.feed_id, s.batch_round, s.camera_id, r.seq, r.xb, r.xl, r.xn, r.embedding
  FROM dstatus s JOIN posd r
    ON r.camera_id = s.camera_id AND r.p > s.buffer_total - {_W} AND r.p <= s.buffer_total
  WHERE s.status = 'analyzed'),
base AS (SELECT * FROM gated WHERE is_valid AND batch_round <= {_CFG.baseline_rounds} ORDER BY seq, feed_id, batch_round LIMIT {_CFG.baseline_samples}),
basev AS (SELECT seq, feed_id, batch_round, brightness_avg AS xb, blur_metric AS xl,
                 {_NORM.format(e='embedding')} AS xn, embedding FROM base),
bn AS (SELECT CAST(count(*) AS BIGINT) AS n2 FROM basev),
wcount AS (
  SELECT w.*,
    (SELECT count(*) FROM basev b WHERE b.xb <= w.xb) AS ble_b, (SELECT count(*) FROM basev b WHERE b.xb < w.xb) AS blt_b,
    (SELECT count(*) FROM basev b WHERE b.xl <= w.xl) AS ble_l, (SELECT count(*) FROM basev b WHERE b.xl < w.xl) AS blt_l,
    (SELECT count(*) FROM basev b WHERE b.xn <= w.xn) AS ble_n, (SELECT count(*) FROM basev b WHERE b.xn < w.xn) AS blt_n
  FROM wrows w),
wpts AS (
  SELECT a.feed_id, a.batch_round, a.camera_id, a.seq,
    any_value(a.ble_b) AS ble_b, any_value(a.blt_b) AS blt_b, any_value(a.ble_l) AS ble_l,
    any_value(a.blt_l) AS blt_l, any_value(a.ble_n) AS ble_n, any_value(a.blt_n) AS blt_n,
    count(*) FILTER (WHERE c.xb <= a.xb) AS wle_b, count(*) FILTER (WHERE c.xb < a.xb) AS wlt_b,
    count(*) FILTER (WHERE c.xl <= a.xl) AS wle_l, count(*) FILTER (WHERE c.xl < a.xl) AS wlt_l,
    count(*) FILTER (WHERE c.xn <= a.xn) AS wle_n, count(*) FILTER (WHERE c.xn < a.xn) AS wlt_n
  FROM wcount a JOIN wcount c ON a.feed_id = c.feed_id AND a.batch_round = c.batch_round
  GROUP BY a.feed_id, a.batch_round, a.camera_id, a.seq),
ksn AS (
  SELECT feed_id, batch_round, camera_id, CAST(count(*) AS BIGINT) AS n1, any_value(bn.n2) AS n2,
    CAST(max(greatest(abs(wle_b * bn.n2 - ble_b * {_W}), abs(wlt_b * bn.n2 - blt_b * {_W}))) AS BIGINT) AS kn_b,
    CAST(max(greatest(abs(wle_l * bn.n2 - ble_l * {_W}), abs(wlt_l * bn.n2 - blt_l * {_W}))) AS BIGINT) AS kn_l,
    CAST(max(greatest(abs(wle_n * bn.n2 - ble_n * {_W}), abs(wlt_n * bn.n2 - blt_n * {_W}))) AS BIGINT) AS kn_n
  FROM wpts, bn GROUP BY feed_id, batch_round, camera_id),
ks_long AS (
  SELECT feed_id, batch_round, camera_id, n1, n2, 'brightness_avg' AS feature, kn_b AS ks_num FROM ksn
  UNION ALL SELECT feed_id, batch_round, camera_id, n1, n2, 'blur_metric', kn_l FROM ksn
  UNION ALL SELECT feed_id, batch_round, camera_id, n1, n2, 'embedding', kn_n FROM ksn),
trip AS (SELECT DISTINCT n1, n2, ks_num AS kn FROM ks_long),
pvr(n1, n2, kn, t, st) AS (
  SELECT n1, n2, kn, 0, list_transform(range(0, n1 + 1), lambda i: CAST(0.0 AS DOUBLE)) FROM trip
  UNION ALL
  SELECT n1, n2, kn, t + 1,
    list_transform(range(0, n1 + 1), lambda i:
      CASE WHEN (t + 1) - i < 0 OR (t + 1) - i > n2 THEN CAST(0.0 AS DOUBLE)
           WHEN abs(i * n2 - ((t + 1) - i) * n1) >= kn THEN CAST(1.0 AS DOUBLE)
           ELSE CAST(i AS DOUBLE) / (t + 1) * (CASE WHEN i = 0 THEN CAST(0.0 AS DOUBLE) ELSE st[i] END)
                + CAST((t + 1) - i AS DOUBLE) / (t + 1) * st[i + 1] END)
  FROM pvr WHERE t < n1 + n2),
pv AS (SELECT n1, n2, kn, CASE WHEN kn <= 0 THEN CAST(1.0 AS DOUBLE) ELSE st[n1 + 1] END AS p_value
       FROM pvr WHERE t = n1 + n2),
kfeat AS (
  SELECT k.*, CAST(k.ks_num AS DOUBLE) / (k.n1 * k.n2) AS ks_statistic, pv.p_value,
         pv.p_value < {_CFG.drift_alpha} AS drift_detected
  FROM ks_long k JOIN pv ON pv.n1 = k.n1 AND pv.n2 = k.n2 AND pv.kn = k.ks_num),
wcen AS (
  SELECT feed_id, batch_round, pos, avg(x) AS wc
  FROM (SELECT feed_id, batch_round, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM wrows)
  GROUP BY feed_id, batch_round, pos),
bcen AS (
  SELECT pos, avg(x) AS bc
  FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM basev) GROUP BY pos),
cm AS (
  SELECT feed_id, batch_round,
    CAST(1.0 AS DOUBLE) - (CAST(1.0 AS DOUBLE) - sum(wc * bc) / (sqrt(sum(wc * wc)) * (SELECT sqrt(sum(bc * bc)) FROM bcen)))
      AS mean_cosine_similarity,
    sqrt(sum((wc - bc) * (wc - bc))) AS mean_euclidean_distance
  FROM wcen JOIN bcen USING (pos) GROUP BY feed_id, batch_round),
reports AS (
  SELECT s.feed_id, s.batch_round, s.camera_id, s.status, s.reason, s.buffer_size,
    CASE WHEN s.status = 'analyzed' THEN CAST(k.n1 AS INTEGER) END AS window_size,
    coalesce(s.status = 'analyzed' AND (fb.drift_detected OR fl.drift_detected OR fn.drift_detected), false) AS drift_detected,
    fb.drift_detected AS brightness_avg_drift, fl.drift_detected AS blur_metric_drift, fn.drift_detected AS embedding_drift,
    fb.p_value AS brightness_avg_p, fl.p_value AS blur_metric_p, fn.p_value AS embedding_p,
    fb.ks_statistic AS brightness_avg_ks, fl.ks_statistic AS blur_metric_ks, fn.ks_statistic AS embedding_ks,
    cm.mean_cosine_similarity, cm.mean_euclidean_distance
  FROM dstatus s
  LEFT JOIN ksn k USING (feed_id, batch_round)
  LEFT JOIN kfeat fb ON fb.feed_id = s.feed_id AND fb.batch_round = s.batch_round AND fb.feature = 'brightness_avg'
  LEFT JOIN kfeat fl ON fl.feed_id = s.feed_id AND fl.batch_round = s.batch_round AND fl.feature = 'blur_metric'
  LEFT JOIN kfeat fn ON fn.feed_id = s.feed_id AND fn.batch_round = s.batch_round AND fn.feature = 'embedding'
  LEFT JOIN cm ON cm.feed_id = s.feed_id AND cm.batch_round = s.batch_round)"""


# the features map as text: name, flag, whether it has centroid metrics, statistic
_FEATURES_TEXT = """'blur_metric:' || blur_metric_drift || ':false:' || printf('%.4f', round(blur_metric_ks, 4))
         || '|brightness_avg:' || brightness_avg_drift || ':false:' || printf('%.4f', round(brightness_avg_ks, 4))
         || '|embedding:' || embedding_drift || ':true:' || printf('%.4f', round(embedding_ks, 4))"""


def with_rec(ctes: str, body: str) -> str:
    return "WITH RECURSIVE " + ctes.strip() + "\n" + body


Q["baseline_rows"] = with_rec(DRIFT, """
SELECT seq, feed_id, batch_round, xb AS brightness_avg, xl AS blur_metric FROM basev""")

Q["baseline_centroid"] = with_rec(DRIFT, """
SELECT CAST(pos - 1 AS INTEGER) AS pos, round(bc, 9) AS centroid_value FROM bcen""")

Q["embedding_norm"] = with_(GATED, f"""
SELECT seq, feed_id, batch_round, {_NORM.format(e='embedding')} AS embedding_norm FROM gated WHERE is_valid""")

Q["drift_buffer"] = with_rec(DRIFT, f"""
SELECT feed_id, batch_round, camera_id, buffer_total FROM bstat WHERE camera_id IN ({_KNOWN})""")

Q["drift_status"] = with_rec(DRIFT, """
SELECT feed_id, batch_round, camera_id, status, reason, CAST(buffer_size AS DOUBLE) AS buffer_size FROM dstatus""")

Q["drift_windows"] = with_rec(DRIFT, """
SELECT feed_id, batch_round, camera_id, CAST(count(*) AS INTEGER) AS window_size,
       min(seq) AS first_seq, max(seq) AS last_seq, CAST(sum(seq) AS BIGINT) AS seq_sum
FROM wrows GROUP BY feed_id, batch_round, camera_id""")

Q["ks_statistic"] = with_rec(DRIFT, """
SELECT feed_id, batch_round, camera_id, feature, ks_num, ks_statistic FROM kfeat""")

Q["ks_pvalue"] = with_rec(DRIFT, """
SELECT feed_id, batch_round, camera_id, feature, ks_num, round(p_value, 10) AS p_value FROM kfeat""")

# K3 from its definition: P(D_n < d) is the chance that the i-th of n ordered uniform
# draws lies between lo_i = i/n - d and hi_i = (i-1)/n + d for every i.  Going through
# all these bounds t in order, q[j+1] is the weight of j draws up to t: at most as many
# as have lo_i < t, at least as many as have hi_i <= t.
Q["ks_pvalue_asymptotic"] = with_rec(DRIFT + """,
one AS (SELECT DISTINCT n1, n2, ks_num, ks_statistic AS d, CAST(round(CAST(n1 AS DOUBLE) * n2 / (n1 + n2)) AS INTEGER) AS n FROM kfeat),
bounds AS (SELECT *,
  list_transform(range(1, n + 1), lambda i: greatest(CAST(0.0 AS DOUBLE), CAST(i AS DOUBLE) / n - d)) AS lo,
  list_transform(range(1, n + 1), lambda i: least(CAST(1.0 AS DOUBLE), CAST(i - 1 AS DOUBLE) / n + d)) AS hi FROM one),
cuts AS (SELECT *, list_sort(list_distinct(list_concat(list_concat(lo, hi), [CAST(0.0 AS DOUBLE), CAST(1.0 AS DOUBLE)]))) AS t FROM bounds),
walk(n1, n2, ks_num, d, n, lo, hi, t, k, q) AS (
  SELECT n1, n2, ks_num, d, n, lo, hi, t, 1,
    list_transform(range(0, n + 1), lambda j: CASE WHEN j = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) FROM cuts
  UNION ALL
  SELECT n1, n2, ks_num, d, n, lo, hi, t, k + 1,
    list_transform(range(0, n + 1), lambda j:
      CASE WHEN j < len(list_filter(hi, lambda x: x <= t[k + 1])) OR j > len(list_filter(lo, lambda x: x < t[k + 1]))
           THEN CAST(0.0 AS DOUBLE)
           ELSE list_sum(list_transform(range(0, j + 1), lambda l:
             q[l + 1] * pow(t[k + 1] - t[k], j - l) / gamma(CAST(j - l + 1 AS DOUBLE)))) END)
  FROM walk WHERE k < len(t)),
late AS (SELECT n1, n2, ks_num,
  CASE WHEN d <= 0 THEN CAST(1.0 AS DOUBLE) WHEN d >= 1 THEN CAST(0.0 AS DOUBLE)
       ELSE least(1.0, greatest(0.0, CAST(1.0 AS DOUBLE) - gamma(CAST(n + 1 AS DOUBLE)) * q[n + 1])) END AS p
  FROM walk WHERE k = len(t))""", """
SELECT k.feed_id, k.batch_round, k.camera_id, k.feature, round(l.p, 8) AS p_value
FROM kfeat k JOIN late l USING (n1, n2, ks_num)""")

Q["feature_drift"] = with_rec(DRIFT, """
SELECT feed_id, batch_round, camera_id, feature, drift_detected FROM kfeat""")

Q["centroid_similarity"] = with_rec(DRIFT, """
SELECT s.feed_id, s.batch_round, s.camera_id, round(cm.mean_cosine_similarity, 9) AS mean_cosine_similarity
FROM dstatus s JOIN cm USING (feed_id, batch_round)""")

Q["centroid_distance"] = with_rec(DRIFT, """
SELECT s.feed_id, s.batch_round, s.camera_id, round(cm.mean_euclidean_distance, 9) AS mean_euclidean_distance
FROM dstatus s JOIN cm USING (feed_id, batch_round)""")

Q["drift_reports"] = with_rec(DRIFT, """
SELECT feed_id, batch_round, camera_id, status, reason, CAST(buffer_size AS DOUBLE) AS buffer_size,
       CAST(window_size AS DOUBLE) AS window_size, drift_detected,
       coalesce(brightness_avg_drift, false) AS brightness_avg_drift,
       coalesce(blur_metric_drift, false) AS blur_metric_drift, coalesce(embedding_drift, false) AS embedding_drift,
       brightness_avg_ks, blur_metric_ks, embedding_ks,
       round(brightness_avg_p, 10) AS brightness_avg_p, round(blur_metric_p, 10) AS blur_metric_p,
       round(embedding_p, 10) AS embedding_p,
       CASE WHEN status = 'analyzed' THEN """ + _FEATURES_TEXT + """ END AS features
FROM reports""")

Q["drift_alerts"] = with_rec(DRIFT, """
SELECT feed_id, batch_round, camera_id, feature, round(p_value, 10) AS p_value FROM kfeat WHERE drift_detected""")

Q["drifted_features"] = with_rec(DRIFT, """
SELECT feed_id, batch_round, camera_id,
  array_to_string(list_filter([CASE WHEN brightness_avg_drift THEN 'brightness_avg' END,
                               CASE WHEN blur_metric_drift THEN 'blur_metric' END,
                               CASE WHEN embedding_drift THEN 'embedding' END], lambda x: x IS NOT NULL), ', ') AS features,
  CAST(coalesce(brightness_avg_drift::INT, 0) + coalesce(blur_metric_drift::INT, 0)
       + coalesce(embedding_drift::INT, 0) AS INTEGER) AS feature_count
FROM reports WHERE status = 'analyzed' AND drift_detected""")

Q["tail_per_camera"] = with_rec(DRIFT, f"""
SELECT camera_id, feed_id, batch_round, seq, rank_from_end FROM (
  SELECT camera_id, feed_id, batch_round, seq,
         CAST(row_number() OVER (PARTITION BY camera_id ORDER BY batch_round DESC, {_PLACE} DESC, seq DESC) AS INTEGER)
           AS rank_from_end
  FROM vrows) WHERE rank_from_end <= {_W}""")


# ---------------------------------------------------------------------------
# Breaker with drift, incidents, summaries
# ---------------------------------------------------------------------------
_RATE_T = _CFG.rate_threshold
_MINF = _CFG.min_drift_features

BREAKER = DRIFT + f""",
dlast AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT r.*, row_number() OVER (PARTITION BY camera_id, batch_round ORDER BY {_PLACE} DESC) AS rn
    FROM reports r) WHERE rn = 1),
bev AS (
  SELECT r.camera_id, r.feed_id, r.batch_round, r.valid_count, r.quarantined_count, r.rolling_quarantine_rate,
    d.status AS drift_status, d.drift_detected, d.window_size AS drift_window_size,
    d.blur_metric_drift, d.brightness_avg_drift, d.embedding_drift, d.blur_metric_ks, d.brightness_avg_ks, d.embedding_ks,
    CASE WHEN d.status = 'analyzed' AND d.drift_detected THEN
      list_filter([CASE WHEN d.brightness_avg_drift THEN 'brightness_avg' END,
                   CASE WHEN d.blur_metric_drift THEN 'blur_metric' END,
                   CASE WHEN d.embedding_drift THEN 'embedding' END], lambda x: x IS NOT NULL)
      ELSE CAST([] AS VARCHAR[]) END AS drifted
  FROM rated r LEFT JOIN dlast d ON d.camera_id = r.camera_id AND d.batch_round = r.batch_round),
bev2 AS (
  SELECT *,
    rolling_quarantine_rate > {_RATE_T} AS rate_trip,
    len(drifted) >= {_MINF} AS drift_trip,
    'QA quarantine rate ' || printf('%.2f%%', rolling_quarantine_rate * 100.0)
      || ' exceeds ' || printf('%.2f%%', {_RATE_T} * 100.0) || ' threshold.' AS rate_msg,
    'Drift detected across ' || CAST(len(drifted) AS VARCHAR) || ' features: '
      || array_to_string(drifted, ', ') || '.' AS drift_msg
  FROM bev),
bev3 AS (
  SELECT *, rate_trip OR drift_trip AS should_trip,
    array_to_string(list_filter([CASE WHEN rate_trip THEN '{C.REASON_RATE}' END,
                                 CASE WHEN drift_trip THEN '{C.REASON_DRIFT}' END], lambda x: x IS NOT NULL), ',')
      AS reason_types,
    array_to_string(list_filter([CASE WHEN rate_trip THEN rate_msg END,
                                 CASE WHEN drift_trip THEN drift_msg END], lambda x: x IS NOT NULL), '; ')
      AS messages
  FROM bev2),
bev4 AS (
  SELECT *,
    sum(CAST(should_trip AS INTEGER)) OVER (PARTITION BY camera_id ORDER BY batch_round, {_PLACE}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ordinal
  FROM bev3),
incs AS (
  SELECT 'inc_' || e.camera_id || '_' || substr(sha256(e.camera_id || '|' || CAST(e.batch_round AS VARCHAR)), 1, 12)
           AS incident_id,
         e.*, b.last_timestamp || '+00:00' AS "timestamp",
         'Circuit breaker tripped for ' || e.camera_id || ': ' || e.messages AS summary
  FROM bev4 e JOIN batches b USING (feed_id, batch_round)
  WHERE e.should_trip AND e.ordinal = 1)"""

_C = _CFG

Q["qa_with_drift"] = with_rec(BREAKER, """
SELECT camera_id, feed_id, batch_round, valid_count, quarantined_count, drift_status,
       coalesce(drift_detected, false) AS drift_detected FROM bev""")

Q["breaker_evaluation"] = with_rec(BREAKER, """
SELECT camera_id, feed_id, batch_round, round(rolling_quarantine_rate, 9) AS rolling_quarantine_rate,
       should_trip, reason_types, messages FROM bev3""")

Q["breaker_trips"] = with_rec(BREAKER, """
SELECT camera_id, feed_id, batch_round, round(rolling_quarantine_rate, 9) AS rolling_quarantine_rate, reason_types
FROM bev4 WHERE should_trip AND ordinal = 1""")

Q["breaker_suppressed"] = with_rec(BREAKER, """
SELECT camera_id, feed_id, batch_round, CAST(ordinal AS INTEGER) AS trip_ordinal, reason_types
FROM bev4 WHERE should_trip AND ordinal > 1""")

Q["breaker_timeline"] = with_rec(BREAKER, """
SELECT camera_id, feed_id, batch_round,
  CASE WHEN should_trip AND ordinal = 1 THEN 'tripped' WHEN ordinal > 0 THEN 'open' ELSE 'closed' END AS breaker_state
FROM bev4""")

Q["incidents"] = with_rec(BREAKER, f"""
SELECT incident_id, camera_id, batch_round, '{_C.severity}' AS severity, 'open' AS status, "timestamp", summary,
       CAST(printf('%.4f', rolling_quarantine_rate) AS DOUBLE) AS rolling_quarantine_rate,
       {_C.qa_window_batches} AS qa_window_batches,
       coalesce(drift_status = 'analyzed', false) AS has_drift_report,
       CASE WHEN drift_status = 'analyzed' THEN CAST(drift_window_size AS DOUBLE) END AS drift_window_size,
       CASE WHEN drift_status = 'analyzed' THEN {_FEATURES_TEXT} END AS drift_features
FROM incs""")

Q["incident_notifications"] = with_rec(BREAKER, f"""
SELECT incident_id, '{_C.alert_channel}' AS channel,
       '{_C.incident_title}: breaker open for ' || camera_id || ' since round ' || CAST(batch_round AS VARCHAR)
         || ', ' || printf('%.2f%%', rolling_quarantine_rate * 100.0) || ' of recent rows quarantined' AS chat_text,
       '{_C.pager_routing_key}' AS routing_key,
       'Breaker open for ' || camera_id AS pager_summary
FROM incs""")

Q["retrain_requests"] = with_rec(BREAKER, f"""
SELECT 'retrain_' || substr(sha256('retrain|' || incident_id), 1, 12) AS request_id, incident_id, camera_id,
       "timestamp" AS triggered_at, '{_C.retrain_pipeline}' AS pipeline, '{_C.retrain_engine}' AS engine,
       '{_C.retrain_action}' AS action, '{_C.retrain_dag_id}' AS dag_id, batch_round,
       CAST(len(string_split(reason_types, ',')) AS INTEGER) AS reason_count
FROM incs""")

Q["incident_records"] = with_rec(BREAKER, f"""
SELECT incident_id, camera_id, batch_round, '{_C.alerts_dir}/' || incident_id || '.json' AS alert_path,
       'retrain_' || substr(sha256('retrain|' || incident_id), 1, 12) AS request_id, 'queued' AS retraining_status,
       CAST(len(string_split(reason_types, ',')) AS INTEGER) AS reason_count
FROM incs""")

Q["round_incidents"] = with_rec(BREAKER, """
SELECT batch_round, CAST(count(*) AS BIGINT) AS incident_count,
       array_to_string(list_sort(list(incident_id)), ',') AS incident_ids
FROM incs GROUP BY batch_round""")

Q["incident_summary"] = with_rec(BREAKER, """
SELECT CAST(count(*) AS BIGINT) AS total_incidents,
       coalesce(array_to_string(list_sort(list(DISTINCT camera_id)), ','), '') AS tripped_cameras
FROM incs""")

Q["incident_triggers"] = with_rec(BREAKER, f"""
SELECT incident_id, camera_id, batch_round, 0 AS place, '{C.REASON_RATE}' AS type, rate_msg AS message FROM incs WHERE rate_trip
UNION ALL
SELECT incident_id, camera_id, batch_round, CASE WHEN rate_trip THEN 1 ELSE 0 END, '{C.REASON_DRIFT}', drift_msg FROM incs WHERE drift_trip""")

Q["batch_frame_ids"] = with_(GATED, """
SELECT feed_id, batch_round, seq, frame_id FROM gated WHERE is_valid""")

Q["pipeline_totals"] = with_rec(BREAKER, """
SELECT 'total_quarantined_rows' AS metric, CAST(sum(quarantined_count) AS BIGINT) AS value FROM batches
UNION ALL SELECT 'drift_alert_count', CAST(count(*) FILTER (WHERE drift_detected) AS BIGINT) FROM reports
UNION ALL SELECT 'total_incidents', CAST(count(*) AS BIGINT) FROM incs""")

Q["batch_telemetry"] = with_(GATED + """,
vagg AS (
  SELECT feed_id, batch_round, arg_min(camera_id, seq) AS camera_id, CAST(count(*) AS BIGINT) AS frame_count,
         min(seq) AS first_seq, max(seq) AS last_seq,
         avg(brightness_avg) AS bmean, min(brightness_avg) AS bmin, avg(blur_metric) AS lmean,
         sum(list_reduce(embedding, lambda a, c: a + c)) AS s1,
         sum(list_reduce(list_transform(embedding, lambda x: x * x), lambda a, c: a + c)) AS s2,
         sum(len(embedding)) AS n
  FROM gated WHERE is_valid GROUP BY feed_id, batch_round)""", """
SELECT b.feed_id, b.batch_round, coalesce(v.camera_id, b.camera_id) AS camera_id,
       coalesce(v.frame_count, 0) AS frame_count, CAST(v.first_seq AS DOUBLE) AS first_seq,
       CAST(v.last_seq AS DOUBLE) AS last_seq,
       round(coalesce(v.bmean, 0.0), 9) AS brightness_avg_mean, round(coalesce(v.bmin, 0.0), 9) AS brightness_avg_min,
       round(coalesce(v.lmean, 0.0), 9) AS blur_metric_mean,
       round(coalesce(v.s1 / v.n, 0.0), 9) AS embedding_mean,
       round(coalesce(sqrt(greatest(v.s2 / v.n - (v.s1 / v.n) * (v.s1 / v.n), 0.0)), 0.0), 9) AS embedding_std
FROM batches b LEFT JOIN vagg v USING (feed_id, batch_round)""")
