"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from orbitlens.plans.catalog import HIGH, LOW, PIPELINE_HIGH, PIPELINE_LOW, SCORE_AT, STEPS, VECTOR

HALF_LOG_2PI = "0.9189385332046727"


def draw(*keys: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '42', {', '.join(keys)})), 1, 8))::BIGINT"


def below(fraction: float, *keys: str) -> str:
    return f"{draw(*keys)} < {fraction!r} * 4294967296"


EVENT = ("event_id",)
LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
LINE_COLUMNS = ", ".join(LINE)

PERIODS = """
  per AS (SELECT ts AS "start", ts + INTERVAL 30 MINUTE AS "end" FROM events
          WHERE event_type = 'error' AND value > 200)"""

LABELLED = PERIODS + """,
  lab AS (SELECT event_id, ts, value,
            CASE WHEN EXISTS (SELECT 1 FROM per p WHERE p."start" <= e.ts AND e.ts < p."end")
                 THEN 1 ELSE 0 END AS label
          FROM events e)"""

NEAR = LABELLED + """,
  near AS (SELECT l.*, CASE WHEN EXISTS (
              SELECT 1 FROM lab p WHERE p.label = 1
                AND l.ts BETWEEN p.ts - INTERVAL 15 MINUTE AND p.ts + INTERVAL 15 MINUTE)
            THEN 1 ELSE 0 END AS is_test
          FROM lab l)"""

SPLIT = NEAR + f""",
  spl AS (SELECT event_id, ts, value, label,
            CASE WHEN is_test = 1 THEN 'test' WHEN {below(0.8, *EVENT)} THEN 'train' ELSE 'validation' END AS split
          FROM near)"""

SCORED = LABELLED + f""",
  raw AS (SELECT *, 0.5 * (value / 100 - 0.5) * (value / 100 - 0.5) + {HALF_LOG_2PI} AS nll FROM lab),
  sco AS (SELECT *, median(nll) OVER (ORDER BY ts, event_id ROWS 99 PRECEDING) AS sm FROM raw)"""


def islands(source: str, ts: str, key: str, on: str, name: str = "isl") -> str:
    """Runs where ``on`` holds: start, and the first timestamp after the run."""
    return f"""
  {name}_m AS (SELECT {ts} AS ts, row_number() OVER o AS n, ({on}) AS is_on,
               lead({ts}) OVER o AS next_ts FROM {source} WINDOW o AS (ORDER BY {ts}, {key})),
  {name}_g AS (SELECT ts, next_ts, n, n - row_number() OVER (ORDER BY n) AS g FROM {name}_m WHERE is_on),
  {name} AS (SELECT arg_min(ts, n) AS "start", arg_max(coalesce(next_ts, ts), n) AS "end"
             FROM {name}_g GROUP BY g)"""


def grid(low: float, high: float, n: int) -> str:
    step = (high - low) / (n - 1)
    return f"""
  thr AS (SELECT CASE WHEN j = {n - 1} THEN {high!r}::DOUBLE ELSE j * {step!r}::DOUBLE + ({low!r})::DOUBLE END AS t
          FROM range({n}) r(j))"""


def sweep(source: str, ts: str, label: str, score: str) -> str:
    """Metrics per threshold by counting every row at every threshold."""
    return f"""
  hit AS (SELECT i."start", i."end", min({score}) AS low FROM (SELECT DISTINCT * FROM isl) i
          JOIN {source} r ON r.{ts} BETWEEN i."start" AND i."end" GROUP BY 1, 2),
  best AS (SELECT r.{ts} AS ts, min(h.low) AS low FROM (SELECT DISTINCT {ts} FROM {source} WHERE {label} = 1) r
           JOIN hit h ON r.{ts} BETWEEN h."start" AND h."end" GROUP BY 1),
  row_s AS (SELECT r.{label} AS label, {score} AS s, least({score}, b.low) AS es
            FROM {source} r LEFT JOIN best b ON b.ts = r.{ts}),
  cnt AS (SELECT t, count(*) FILTER (s < t) AS pred, count(*) FILTER (s < t AND label = 1) AS tp,
            count(*) FILTER (es < t AND label = 1) AS etp, count(*) FILTER (label = 1) AS pos
          FROM thr, row_s GROUP BY t),
  rat AS (SELECT t, coalesce(tp / nullif(pred, 0), 0)::DOUBLE AS p, coalesce(etp / nullif(pos, 0), 0)::DOUBLE AS r
          FROM cnt),
  met AS (SELECT t AS threshold, p AS point_precision, r AS event_recall,
            CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS composite_f1 FROM rat)"""


METRICS = "round(point_precision, 6) AS point_precision, round(event_recall, 6) AS event_recall, " \
          "round(composite_f1, 6) AS composite_f1"
BEST = f"""SELECT CASE WHEN composite_f1 > 0 THEN round(point_precision, 6) ELSE 0 END AS point_precision,
  CASE WHEN composite_f1 > 0 THEN round(event_recall, 6) ELSE 0 END AS event_recall,
  round(composite_f1, 6) AS composite_f1, round(threshold, 6) AS best_threshold
FROM met ORDER BY met.composite_f1 DESC, threshold LIMIT 1"""

ONE_THRESHOLD = f"\n  thr AS (SELECT {SCORE_AT!r}::DOUBLE AS t)"
LABEL_RUNS = islands("sco", "ts", "event_id", "label = 1")


def dense(x: str, n_in: int, n_out: int, relu: bool) -> str:
    total = f"list_sum(list_transform(range(0, {n_in}), lambda i: {x}[i + 1] * sin(7.0 * i + j) / 10)) + sin(3.0 * j) / 10"
    return f"list_transform(range(0, {n_out}), lambda j: {f'greatest(0.0, {total})' if relu else total})"


def network(source: str) -> str:
    """Forward pass of the fixed-weight model over ``source(vec_id, x DOUBLE[])``."""
    return f"""
  e1 AS (SELECT vec_id, x, {dense('x', VECTOR, 8, True)} AS h FROM {source}),
  e2 AS (SELECT vec_id, x, {dense('h', 8, 8, True)} AS h FROM e1),
  e3 AS (SELECT vec_id, x, {dense('h', 8, 4, False)} AS code FROM e2),
  d0 AS (SELECT vec_id, x, code, code[1:2] AS z FROM e3),
  d1 AS (SELECT vec_id, x, code, {dense('z', 2, 8, True)} AS h FROM d0),
  d2 AS (SELECT vec_id, x, code, {dense('h', 8, 8, True)} AS h FROM d1),
  d3 AS (SELECT vec_id, x, code, {dense('h', 8, VECTOR, False)} AS m FROM d2),
  net AS (SELECT vec_id, code, list_sum(list_transform(range(0, {VECTOR}), lambda k:
            0.5 * (x[k + 1] - m[k + 1]) * (x[k + 1] - m[k + 1]) * exp(-sin(1.0 * k) / 10)
            + 0.5 * sin(1.0 * k) / 10 + {HALF_LOG_2PI})) AS nll FROM d3)"""


SCALED_VECTORS = f"""
  par AS (SELECT list(c ORDER BY i) AS c, list(s ORDER BY i) AS s FROM (
            SELECT i, avg(embedding[i]::DOUBLE) AS c, stddev_pop(embedding[i]::DOUBLE) AS s
            FROM embeddings, range(1, {VECTOR + 1}) r(i) GROUP BY i)),
  vec AS (SELECT vec_id, list_transform(range(1, {VECTOR + 1}),
            lambda i: (embedding[i]::DOUBLE - par.c[i]) / par.s[i]) AS x FROM embeddings, par)"""

PREDICTIONS = f"""WITH {SCALED_VECTORS}
SELECT (vec_id // 10)::BIGINT AS request_id,
  (row_number() OVER (PARTITION BY vec_id // 10 ORDER BY vec_id) - 1)::INT AS position,
  round(list_sum(list_transform(x, lambda v: 0.5 * v * v + {HALF_LOG_2PI})), 6) AS nll
FROM vec"""

HISTORY = """
  his AS (SELECT user_id AS trial, event_id, value AS val_loss,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch FROM events)"""

RUNS = """
  runs AS (SELECT o_orderkey::VARCHAR AS run_id, o_orderpriority AS run_name, o_orderdate AS start_time,
             o_orderkey AS number, o_totalprice / 600000 AS composite_f1 FROM orders)"""

LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def per_feature(center: str, scale: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round({center.format(c)}, 6) AS center, round({scale.format(c)}, 6) AS scale "
        "FROM lineitem"
        for c in LINE_FEATURES
    )


def median_over(window: str, value: str = "value") -> str:
    return f"round(median({value}) OVER ({window} ORDER BY ts, event_id ROWS 99 PRECEDING), 6)"


RESULTS = SPLIT + """,
  res AS (SELECT ts, event_id, value, split AS dataset, label,
            median(value) OVER (ORDER BY ts, event_id ROWS 99 PRECEDING) AS sm
          FROM spl WHERE split <> 'train')"""

ORACLES: dict[str, str] = {
    "select_float_features":
        f"SELECT l_shipdate, {LINE_COLUMNS}, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
    "hash_sample": f"SELECT event_id, ts, value FROM events WHERE {below(0.1, *EVENT)}",
    "preprocess_telemetry":
        f"SELECT l_shipdate, {LINE_COLUMNS}, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem "
        f"WHERE {below(0.05, *LINE)} ORDER BY l_shipdate, {LINE_COLUMNS}",
    "archive_chunks": f"""
WITH p AS (SELECT year(l_shipdate)::INT AS year, l_shipdate,
             row_number() OVER (PARTITION BY year(l_shipdate) ORDER BY {LINE_COLUMNS}) - 1 AS i FROM lineitem),
  q AS (SELECT *, ((i // 500) - (i // 500) % 4)::INT AS chunk FROM p)
SELECT year, chunk, min(l_shipdate) AS "start", max(l_shipdate) AS "end", count(*) AS rows,
  printf('row_groups_%05d_to_%05d.parquet', chunk, (max(i) // 500 + 1)::INT) AS file_name
FROM q GROUP BY year, chunk""",
    "parse_doy_periods": f"""
WITH {PERIODS}, txt AS (SELECT strftime("start", '%Y/%j/%H:%M:%S') AS start_text,
                          strftime("end", '%Y/%j/%H:%M:%S') AS end_text FROM per)
SELECT *, strptime(start_text, '%Y/%j/%H:%M:%S') AS "start", strptime(end_text, '%Y/%j/%H:%M:%S') AS "end" FROM txt""",
    "normalize_paths": r"""
WITH p AS (SELECT page_id, ['minio://', '/minio/', 'minio/', 's3://'][page_id % 4 + 1]
             || regexp_replace(url, '^https?://', '') AS path FROM pages)
SELECT page_id, path, regexp_replace(path, '^(minio://|/minio/|minio/)', 's3a://') AS uri,
  string_split(path, '/')[-1] AS name,
  regexp_extract(path || '/' || (page_id + 1900)::VARCHAR, '\d{4}')::INT AS year
FROM p""",
    "event_timestamps_iso": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS logged_at FROM events",
    "batch_numbers": """
SELECT event_id, ts, value, ((row_number() OVER (ORDER BY ts, event_id) - 1) // 512)::BIGINT AS batch FROM events""",
    "merge_periods": f"""
WITH {PERIODS},
  m AS (SELECT *, max("end") OVER (ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b
        FROM per),
  g AS (SELECT *, sum(CASE WHEN b IS NULL OR "start" > b THEN 1 ELSE 0 END) OVER (ORDER BY "start", "end") AS g FROM m)
SELECT min("start") AS "start", max("end") AS "end" FROM g GROUP BY g.g""",
    "label_intervals": f"WITH {LABELLED} SELECT event_id, ts, value, label FROM lab",
    "label_intervals_bucketed": f"WITH {LABELLED} SELECT event_id, ts, value, label FROM lab",
    "test_window_mask": f"WITH {NEAR} SELECT event_id, ts, value, label, is_test FROM near",
    "anomaly_intervals": f"""WITH {LABELLED}, {islands('lab', 'ts', 'event_id', 'label = 1')}
SELECT "start", "end" FROM isl""",
    "anomaly_intervals_bucketed": f"""WITH {LABELLED}, {islands('lab', 'ts', 'event_id', 'label = 1')}
SELECT "start", "end" FROM isl""",
    "tied_value_runs": f"""WITH {islands('lineitem', 'l_shipdate', LINE_COLUMNS, 'l_discount >= 0.08')}
SELECT "start", "end" FROM isl""",
    "train_val_test_split": f"WITH {SPLIT} SELECT event_id, ts, value, label, split FROM spl",
    "exact_train_split": f"""
WITH {NEAR},
  rnk AS (SELECT event_id, row_number() OVER (ORDER BY {draw(*EVENT)}, event_id) AS n,
            round_even(0.8 * count(*) OVER (), 0) AS k FROM near WHERE is_test = 0)
SELECT n.event_id, ts, value, label,
  CASE WHEN is_test = 1 THEN 'test' WHEN r.n <= r.k THEN 'train' ELSE 'validation' END AS split
FROM near n LEFT JOIN rnk r ON r.event_id = n.event_id""",
    "val_anti_join": f"""
SELECT {LINE_COLUMNS}, l_shipdate, l_quantity FROM lineitem WHERE l_shipdate NOT IN (
  SELECT l_shipdate FROM lineitem WHERE {below(0.02, *LINE)})""",
    "fit_standard_scaler": per_feature("avg({0})", "stddev_pop({0})"),
    "fit_minmax_scaler": per_feature("min({0})", "max({0}) - min({0})"),
    "scale_frames": f"""
WITH f AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in LINE_FEATURES)}
           FROM lineitem WHERE {below(0.8, *LINE)})
SELECT {LINE_COLUMNS}, {', '.join(f'round(({c} - {c}_m) / {c}_s, 6) AS {c}' for c in LINE_FEATURES)}, l_returnflag
FROM lineitem, f""",
    "gaussian_nll": f"""
SELECT vec_id, round(list_sum(list_transform(range(0, {VECTOR}), lambda i:
    0.5 * (embedding[i + 1]::DOUBLE - i * 0.01) * (embedding[i + 1]::DOUBLE - i * 0.01) * exp(0.05 * i)
    - 0.5 * 0.05 * i + {HALF_LOG_2PI})), 6) AS nll,
  round(0.5 + {HALF_LOG_2PI} + ln(exp(0.5 * -0.05)), 6) AS entropy
FROM embeddings""",
    "elbo_terms": f"""
WITH r AS (SELECT
    -0.5 * list_sum(list_transform(range(1, 33), lambda i: 1 + embedding[i + 32]::DOUBLE
      - embedding[i]::DOUBLE * embedding[i]::DOUBLE - exp(embedding[i + 32]::DOUBLE))) AS kl,
    list_sum(list_transform(range(1, 33), lambda i: (embedding[i + 32]::DOUBLE - embedding[i]::DOUBLE)
      * (embedding[i + 32]::DOUBLE - embedding[i]::DOUBLE))) AS sq FROM embeddings),
  s AS (SELECT sum(kl) AS kl, sum(sq) / (count(*) * 32) AS mse,
          avg(-0.5 * sq - 32 * {HALF_LOG_2PI}) AS mean_log_density FROM r)
SELECT round(kl, 6) AS kl, round(mse, 6) AS mse, round(mean_log_density, 6) AS mean_log_density,
  round(mse + 0.01 * (mse - 1e-5 * mean_log_density) + 0.001 * kl, 6) AS loss FROM s""",
    "rolling_median_global": f"SELECT event_id, ts, value, {median_over('')} AS rolling_median FROM events",
    "rolling_median_bucketed": f"SELECT event_id, ts, value, {median_over('')} AS rolling_median FROM events",
    "rolling_median_user": f"""
SELECT event_id, ts, user_id, value, {median_over('PARTITION BY user_id')} AS rolling_median FROM events""",
    "smoothed_results": f"""WITH {RESULTS}
SELECT ts, event_id, value AS neg_log_likelihood, dataset, CASE WHEN dataset = 'test' THEN label ELSE 0 END AS label,
  round(sm, 6) AS smoothed_neg_log_likelihood FROM res""",
    "event_predictions": f"""
WITH {SCORED}, {LABEL_RUNS},
  hit AS (SELECT DISTINCT i."start", i."end" FROM isl i JOIN sco r ON r.ts BETWEEN i."start" AND i."end"
          WHERE -r.sm < {SCORE_AT!r})
SELECT event_id, ts, label, (-sm < {SCORE_AT!r})::INT AS prediction_point,
  (-sm < {SCORE_AT!r} OR EXISTS (SELECT 1 FROM hit h WHERE r.ts BETWEEN h."start" AND h."end"))::INT AS prediction_event
FROM sco r""",
    "metrics_at_threshold": f"""
WITH {SCORED}, {LABEL_RUNS}, {ONE_THRESHOLD}, {sweep('sco', 'ts', 'label', '-sm')} SELECT {METRICS} FROM met""",
    "threshold_sweep": f"""
WITH {SCORED}, {LABEL_RUNS}, {grid(LOW, HIGH, STEPS)}, {sweep('sco', 'ts', 'label', '-sm')}
SELECT round(threshold, 6) AS threshold, {METRICS} FROM met""",
    "tied_threshold_sweep": f"""
WITH lin AS (SELECT *, (l_discount >= 0.08)::INT AS label, l_extendedprice / 1000 AS sm FROM lineitem),
  {islands('lin', 'l_shipdate', LINE_COLUMNS, 'label = 1')}, {grid(-110.0, -60.0, 26)},
  {sweep('lin', 'l_shipdate', 'label', '-sm')}
SELECT round(threshold, 6) AS threshold, {METRICS} FROM met""",
    "best_threshold": f"""
WITH {SCORED}, {LABEL_RUNS}, {grid(LOW, HIGH, STEPS)}, {sweep('sco', 'ts', 'label', '-sm')} {BEST}""",
    "metric_rows": f"""
WITH {SCORED}, {LABEL_RUNS}, {ONE_THRESHOLD}, {sweep('sco', 'ts', 'label', '-sm')}
SELECT unnest(['point_precision', 'event_recall', 'composite_f1']) AS metric,
  round(unnest([point_precision, event_recall, composite_f1]), 6) AS value FROM met""",
    "batch_infer": f"""
WITH vec AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), {network('vec')}
SELECT vec_id, round(nll, 6) AS neg_log_likelihood, round(code[1], 6) AS mean_z_0, round(code[2], 6) AS mean_z_1,
  round(code[3], 6) AS log_var_z_0, round(code[4], 6) AS log_var_z_1 FROM net""",
    "score_vectors": f"WITH {SCALED_VECTORS}, {network('vec')} SELECT vec_id, round(nll, 6) AS nll FROM net",
    "score_requests": PREDICTIONS,
    "score_stream": PREDICTIONS,
    "stream_labels": f"WITH {LABELLED} SELECT event_id, ts, value, label FROM lab",
    "early_stop": f"""
WITH {HISTORY},
  mins AS (SELECT *, min(val_loss) OVER (PARTITION BY trial ORDER BY epoch
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM his),
  best AS (SELECT *, max(CASE WHEN before IS NULL OR val_loss < before THEN epoch END)
             OVER (PARTITION BY trial ORDER BY epoch) AS b FROM mins),
  stp AS (SELECT trial, coalesce(min(CASE WHEN epoch - b >= 5 THEN epoch END), max(epoch)) AS s
          FROM best GROUP BY trial)
SELECT stp.trial, stp.s AS stop_epoch, best.b AS best_epoch
FROM stp JOIN best ON best.trial = stp.trial AND best.epoch = stp.s""",
    "best_epoch": f"""
WITH {HISTORY}, r AS (SELECT *, row_number() OVER (PARTITION BY trial ORDER BY val_loss, epoch) AS n FROM his)
SELECT trial, epoch AS best_epoch, val_loss AS best_val_loss FROM r WHERE n = 1""",
    "best_trial": f"""
WITH {HISTORY} SELECT trial, epoch, event_id, val_loss FROM his ORDER BY val_loss, trial, epoch, event_id LIMIT 1""",
    "run_lookup": f"""
WITH {RUNS} SELECT * FROM runs WHERE run_name = '2-HIGH' ORDER BY start_time DESC, number DESC LIMIT 1""",
    "latest_runs": f"""
WITH {RUNS}, r AS (SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, number DESC) AS n
                   FROM runs)
SELECT run_id, run_name, start_time, number, composite_f1 FROM r WHERE n = 1""",
    "promotion_gate": f"WITH {RUNS} SELECT * FROM runs WHERE composite_f1 > 0.7",
    "split_plot_data": f"""
WITH {SPLIT}, d AS (SELECT * FROM spl WHERE {below(0.1, *EVENT)})
SELECT 'train' AS series, ts, value AS y FROM d WHERE split = 'train'
UNION ALL SELECT 'test', ts, value FROM d WHERE split = 'test'
UNION ALL SELECT 'anomalies', ts, label::DOUBLE FROM d WHERE split = 'test'""",
    "result_plot_points": f"""
WITH {SCORED}, d AS (SELECT * FROM sco WHERE {below(0.1, *EVENT)})
SELECT 'log_likelihood' AS series, ts, round(-nll, 6) AS y FROM d
UNION ALL SELECT 'log_likelihood_smoothed', ts, round(-sm, 6) FROM d""",
    "result_plot_bands": f"""
WITH {SPLIT}, {islands('spl', 'ts', 'event_id', "split = 'test'", 'tst')},
  {islands('spl', 'ts', 'event_id', 'label = 1', 'ano')}
SELECT 'test' AS kind, "start", "end" FROM tst UNION ALL SELECT 'anomaly', "start", "end" FROM ano""",
    "anomaly_detection": f"""
WITH {SPLIT},
  par AS (SELECT avg(value) AS c, stddev_pop(value) AS s FROM spl WHERE split = 'train'),
  raw AS (SELECT event_id, ts, CASE WHEN split = 'test' THEN label ELSE 0 END AS label,
            0.5 * ((value - c) / s) * ((value - c) / s) + {HALF_LOG_2PI} AS nll
          FROM spl, par WHERE split <> 'train'),
  sco AS (SELECT *, median(nll) OVER (ORDER BY ts, event_id ROWS 99 PRECEDING) AS sm FROM raw),
  {LABEL_RUNS}, {grid(PIPELINE_LOW, PIPELINE_HIGH, STEPS)}, {sweep('sco', 'ts', 'label', '-sm')} {BEST}""",
}
