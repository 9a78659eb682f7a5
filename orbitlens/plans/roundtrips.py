"""Registered queries that go through the readers and writers, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlens.functions import likelihood as lk
from orbitlens.functions.scalars import unique_run_name
from orbitlens.operators import evaluation as ev
from orbitlens.operators import model as md
from orbitlens.operators import registry, sampling, scaling
from orbitlens.plans import catalog
from orbitlens.plans import oracles as sql
from orbitlens.plans.catalog import FEATURES, KEY, LINE_FEATURES, LINE_KEY, VECTOR, periods, query, r6, table, vectors
from orbitlens.plans.pipeline import load_model
from orbitlens.session import scratch_path
from orbitlens.sources import readers, row_groups, writers
from orbitlens.streaming import scoring

GROUP_ROWS, GROUPS = 500, 4
CHOICES = {"lr": [0.0005, 0.0001, 0.00005], "batch_size": [32.0, 64.0, 128.0], "beta": [0.001, 0.0001, 0.0001]}
DRAWN = 12


@query
def period_files(spark, sf_dir):
    """Periods as day-of-year texts in CSV, JSON and Parquet, read back by the period reader."""
    text = [F.date_format(c, "yyyy/DDD/HH:mm:ss").alias(f"{c}_text") for c in ("start", "end")]
    raw = periods(spark, sf_dir).select(*text)
    out = None
    for kind in ("csv", "json", "parquet"):
        path = scratch_path(spark, f"periods-{kind}")
        raw.write.format(kind).option("header", "true").save(path)
        back = readers.read_periods(spark, path, "start_text", "end_text", kind).select(
            F.lit(kind).alias("format"), *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")])
        out = back if out is None else out.unionByName(back)
    return out


@query
def telemetry_files(spark, sf_dir):
    """Two folders read as one telemetry frame: timestamp, keys and float columns only."""
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_FEATURES, "l_shipdate", "l_returnflag")
    odd, even = scratch_path(spark, "telemetry"), scratch_path(spark, "telemetry")
    writers.write_frame(rows.where("l_linenumber % 2 = 1"), odd)
    writers.write_frame(rows.where("l_linenumber % 2 = 0"), even)
    return readers.read_telemetry(spark, [odd, even], "l_shipdate", tuple(LINE_KEY))


@query
def archive_files(spark, sf_dir):
    """Archives of one file each, two for every year, re-chunked and listed from what was written."""
    source, target = scratch_path(spark, "archives"), scratch_path(spark, "chunks")
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_shipdate", "l_quantity")
    name = F.concat_ws("_", F.year("l_shipdate"), F.when(F.col("l_linenumber") == 1, "first").otherwise("rest"))
    named = rows.withColumn("archive", name)
    named.repartition("archive").write.partitionBy("archive").parquet(source)
    found, rejected = readers.read_archives(spark, source)
    if rejected.head(1):
        raise ValueError("an archive without a year")
    listed = writers.write_archive_chunks(found, target, "l_shipdate", GROUP_ROWS, GROUPS)
    return listed.select("year", "chunk", "rows", "file_name")


#: rows of a row group in archives of odd and even years; row groups of an archive that are cut at all
UNEVEN, GROUP_CAP = (700, 300), 12


@query
def archive_row_groups(spark, sf_dir):
    """Archives with uneven row groups, cut by their footers up to a cap; the list is that of the files on disk."""
    source, target = scratch_path(spark, "archives"), scratch_path(spark, "chunk-files")
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_shipdate", "l_quantity")
    rows = rows.withColumn("archive", F.concat(F.lit("archive_"), F.year("l_shipdate")))
    for even, size in enumerate(UNEVEN):
        mine = rows.where(F.year("l_shipdate") % 2 == 1 - even)
        (mine.repartition("archive").sortWithinPartitions("archive", *LINE_KEY).write.mode("append")
         .option("parquet.block.row.count.limit", size).partitionBy("archive").parquet(source))
    row_groups.rechunk(spark, source, target, GROUPS, GROUP_CAP)
    parts = F.split("path", "/")
    return row_groups.list_files(spark, target, "l_shipdate").select(
        F.element_at(parts, -2).cast("int").alias("year"), F.element_at(parts, -1).alias("file_name"), "rows", "start", "end")


@query
def scaler_file(spark, sf_dir):
    """A fitted scaler written, read back and applied."""
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_FEATURES)
    path = scratch_path(spark, "scaler")
    writers.write_scaler(scaling.fit_scaler(rows, LINE_FEATURES), path)
    done = scaling.scale_columns(rows, readers.read_frame(spark, path))
    return done.select(*LINE_KEY, *[r6(c).alias(c) for c in LINE_FEATURES])


@query
def metrics_file(spark, sf_dir):
    """The metrics record as JSON and back."""
    path = scratch_path(spark, "metrics")
    found = ev.metrics_at_threshold(catalog.scored(spark, sf_dir), "ts", KEY, "label", catalog.SCORE_AT)
    writers.write_metrics(found, path)
    kinds = ", ".join(f"{c} double" for c in found.columns)
    return spark.read.schema(kinds).json(path).select(*[r6(c).alias(c) for c in found.columns])


@query
def weights_by_run(spark, sf_dir):
    """Two runs of one name in the registry; the vectors scored with the weights of the later one."""
    runs, store = scratch_path(spark, "runs"), scratch_path(spark, "weights")
    wrong = {n: w * 0 for n, w in catalog.fixed_weights().items()}
    for run_id, weights in (("first", wrong), ("second", catalog.fixed_weights())):
        writers.write_weights(md.weight_table(spark, weights), run_id, store)
        registry.append_run(registry.run_record(spark, run_id, "nightly", {"beta": 0.5, "latent_dim": 2}), runs)
    rows = catalog.vector_columns(spark, sf_dir)
    params = scaling.scaler_values(scaling.fit_scaler(rows, FEATURES))
    done = scoring.score_vectors(rows, FEATURES, params, load_model(spark, "nightly", runs, store), dtype="float64")
    run = registry.require_run(spark.read.parquet(runs), "nightly").select(registry.hyperparameter("beta").alias("beta"))
    return done.select("vec_id", r6("nll").alias("nll"), F.lit(run.first()["beta"]).alias("beta"))


@query
def score_stream_model(spark, sf_dir):
    """Request bodies through a stream, scored by the model."""
    source, answers = scratch_path(spark, "requests"), scratch_path(spark, "answers")
    catalog.requests(spark, sf_dir).write.json(source)
    params = scaling.scaler_values(scaling.fit_scaler(catalog.vector_columns(spark, sf_dir), FEATURES))
    stream = scoring.score_requests(scoring.read_request_stream(spark, source), FEATURES, params, catalog.fixed_weights())
    scoring.run_to_table(stream, answers, scratch_path(spark, "offsets"))
    found = F.from_json("response", "predictions array<double>")["predictions"]
    flat = spark.read.parquet(answers).select("request_id", F.posexplode(found).alias("position", "nll"))
    return flat.select((F.col("request_id") * 10 + F.col("position")).alias("vec_id"), r6("nll").alias("nll"))


@query
def trial_draws(spark, sf_dir):
    """Random search draws, with the number of vectors each trial would be fitted on."""
    trials = sampling.draw_trials(spark, CHOICES, DRAWN)
    return trials.withColumn("rows", F.lit(vectors(spark, sf_dir).count()).cast("long"))


@query
def observed_draws(spark, sf_dir):
    """Random search over the values a table holds: drawn pairs of tax and discount, and the lines that have them."""
    lines = table(spark, sf_dir, "lineitem")
    choices = {c: [r[0] for r in lines.select(c).distinct().orderBy(c).collect()] for c in ("l_tax", "l_discount")}
    trials = sampling.draw_trials(spark, choices, DRAWN)
    found = lines.groupBy("l_tax", "l_discount").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    return trials.join(found, ["l_tax", "l_discount"], "left").select(
        "trial", "l_tax", "l_discount", F.coalesce("lines", F.lit(0)).cast("long").alias("lines"), r6(F.coalesce("quantity", F.lit(0.0))).alias("quantity"))


@query
def first_features(spark, sf_dir):
    cut = vectors(spark, sf_dir).select("vec_id", scaling.first_features("features", 3).alias("cut"))
    return cut.select("vec_id", F.size("cut").alias("width"), *[r6(F.get("cut", F.lit(i)).cast("double")).alias(f"f{i}") for i in range(3)])


@query
def request_objects(spark, sf_dir):
    """Rows as JSON objects, parsed again."""
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_FEATURES)
    made = rows.select(*LINE_KEY, writers.instances_json(LINE_FEATURES).alias("body"))
    back = F.from_json("body", ", ".join(f"{c} double" for c in LINE_FEATURES))
    return made.select(*LINE_KEY, back.alias("b")).select(*LINE_KEY, "b.*")


@query
def rejected_requests(spark, sf_dir):
    """Bodies that are no requests, next to the number of rows of those that are."""
    asked = catalog.requests(spark, sf_dir)
    spoilt = asked.withColumn("body", F.when(F.col("request_id") % 7 == 0, F.expr("left(body, 20)")).otherwise(F.col("body")))
    rows, rejected = readers.parse_requests(spoilt, "body", "request_id")
    good = rows.groupBy("request_id").agg(F.count("*").alias("rows"), F.lit(False).alias("rejected"))
    return good.union(rejected.select("request_id", F.lit(0).cast("long"), F.lit(True)))


@query
def rejected_vectors(spark, sf_dir):
    """Vectors a model of the given width cannot take."""
    cut = F.when(F.col("vec_id") % 5 == 0, F.slice("features", 1, 10)).otherwise(
        F.when(F.col("vec_id") % 5 == 1, F.transform("features", lambda x, i: F.when(i != 3, x))).otherwise(F.col("features")))
    _, rejected = md.split_by_width(vectors(spark, sf_dir).withColumn("features", cut), VECTOR)
    return rejected.select("vec_id", F.size("features").alias("width"))


@query
def normal_moments(spark, sf_dir):
    """Mean, variance and standard deviation of a Normal by its log-variance, and a draw by given noise."""
    rows = catalog.telemetry(spark, sf_dir).select("event_id", (F.col("value") / 100).alias("log_var"))
    return rows.select("event_id", r6(lk.variance(F.col("log_var"))).alias("variance"), r6(lk.stddev(F.col("log_var"))).alias("stddev"))


@query
def run_name_shape(spark, sf_dir):
    """Unique run names have the wanted shape, one for every order priority."""
    names = table(spark, sf_dir, "orders").select("o_orderpriority").distinct().select(
        "o_orderpriority", unique_run_name("train").alias("name"))
    shaped = F.col("name").rlike("^train-[0-9]{8}-[0-9]{6}-[0-9a-f]{8}$")
    return names.select("o_orderpriority", shaped.alias("shaped"), F.length("name").alias("length"))


def _moments(column: str) -> str:
    return f"avg({column}) AS {column}_m, stddev_pop({column}) AS {column}_s"


def _product() -> str:
    parts = [f"(SELECT row_number() OVER () - 1 AS i{n}, v AS {n} FROM (SELECT unnest({values}) AS v))" for n, values in CHOICES.items()]
    a, b = len(CHOICES["batch_size"]), len(CHOICES["beta"])
    return (f"SELECT (ilr * {a * b} + ibatch_size * {b} + ibeta)::INTEGER AS combination, lr, batch_size, beta "
            f"FROM {parts[0]}, {parts[1]}, {parts[2]}")


ORACLES = {
    "period_files": f"""
WITH {sql.PERIODS}, txt AS (SELECT strptime(strftime("start", '%Y/%j/%H:%M:%S'), '%Y/%j/%H:%M:%S') AS "start",
                          strptime(strftime("end", '%Y/%j/%H:%M:%S'), '%Y/%j/%H:%M:%S') AS "end" FROM per)
SELECT format, txt.* FROM txt, (SELECT unnest(['csv', 'json', 'parquet']) AS format)""",
    "telemetry_files": f"SELECT l_shipdate, {sql.LINE_COLUMNS}, {', '.join(LINE_FEATURES)} FROM lineitem",
    "archive_files": f"""
WITH n AS (SELECT year(l_shipdate)::INTEGER AS year, l_linenumber = 1 AS first, count(*) AS n FROM lineitem GROUP BY ALL),
c AS (SELECT year, n, unnest(range(0, ceil(n / {GROUP_ROWS * GROUPS}.0)::BIGINT)) AS i FROM n),
r AS (SELECT year, (i * {GROUPS})::INTEGER AS chunk, least({GROUP_ROWS * GROUPS}, n - i * {GROUP_ROWS * GROUPS})::BIGINT AS rows FROM c)
SELECT *, printf('row_groups_%05d_to_%05d.parquet', chunk, chunk + ceil(rows / {GROUP_ROWS}.0)::INTEGER) AS file_name FROM r""",
    "archive_row_groups": f"""
WITH n AS (SELECT year(l_shipdate)::INTEGER AS year, l_shipdate,
             row_number() OVER (PARTITION BY year(l_shipdate) ORDER BY {sql.LINE_COLUMNS}) - 1 AS i FROM lineitem),
g AS (SELECT *, (i // CASE WHEN year % 2 = 1 THEN {UNEVEN[0]} ELSE {UNEVEN[1]} END)::INTEGER AS g FROM n),
c AS (SELECT year, g // {GROUPS} * {GROUPS} AS chunk, max(g) + 1 AS stop, count(*) AS rows, min(l_shipdate) AS "start",
        max(l_shipdate) AS "end" FROM g WHERE g < {GROUP_CAP} GROUP BY ALL)
SELECT year, printf('row_groups_%05d_to_%05d.parquet', chunk, stop) AS file_name, rows, "start", "end" FROM c""",
    "scaler_file": f"""
WITH f AS (SELECT {', '.join(map(_moments, LINE_FEATURES))} FROM lineitem)
SELECT {sql.LINE_COLUMNS}, {', '.join(f'round(({c} - {c}_m) / {c}_s, 6) AS {c}' for c in LINE_FEATURES)} FROM lineitem, f""",
    "metrics_file": sql.ORACLES["metrics_at_threshold"],
    "weights_by_run": f"SELECT *, 0.5::DOUBLE AS beta FROM ({sql.ORACLES['score_vectors']})",
    "score_stream_model": sql.ORACLES["score_vectors"],
    "trial_draws": f"""
WITH p AS ({_product()}),
d AS (SELECT *, {sql.draw('combination')} AS draw FROM p),
t AS (SELECT (row_number() OVER (ORDER BY draw, combination) - 1)::INTEGER AS trial, lr::DOUBLE AS lr,
        batch_size::DOUBLE AS batch_size, beta::DOUBLE AS beta FROM d)
SELECT t.*, (SELECT count(*) FROM embeddings) AS rows FROM t WHERE trial < {DRAWN}""",
    "observed_draws": f"""
WITH t AS (SELECT l_tax, row_number() OVER (ORDER BY l_tax) - 1 AS i FROM (SELECT DISTINCT l_tax FROM lineitem)),
d AS (SELECT l_discount, row_number() OVER (ORDER BY l_discount) - 1 AS j, count(*) OVER () AS m FROM (SELECT DISTINCT l_discount FROM lineitem)),
p AS (SELECT l_tax, l_discount, (i * m + j)::INTEGER AS combination FROM t, d),
r AS (SELECT l_tax, l_discount, (row_number() OVER (ORDER BY {sql.draw('combination')}, combination) - 1)::INTEGER AS trial FROM p),
n AS (SELECT l_tax, l_discount, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL)
SELECT trial, l_tax, l_discount, coalesce(lines, 0)::BIGINT AS lines, round(coalesce(quantity, 0), 6)::DOUBLE AS quantity
FROM r LEFT JOIN n USING (l_tax, l_discount) WHERE trial < {DRAWN}""",
    "first_features": f"""
SELECT vec_id, 3::INTEGER AS width, {', '.join(f'round(embedding[{i + 1}]::DOUBLE, 6) AS f{i}' for i in range(3))} FROM embeddings""",
    "request_objects": f"SELECT {sql.LINE_COLUMNS}, {', '.join(LINE_FEATURES)} FROM lineitem",
    "rejected_requests": """
SELECT vec_id // 10 AS request_id, CASE WHEN (vec_id // 10) % 7 = 0 THEN 0 ELSE count(*) END AS rows,
  (vec_id // 10) % 7 = 0 AS rejected FROM embeddings GROUP BY vec_id // 10""",
    "rejected_vectors": f"""
SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 10 ELSE {VECTOR} END::INTEGER AS width FROM embeddings WHERE vec_id % 5 < 2""",
    "normal_moments": """
SELECT event_id, round(exp(value / 100), 6) AS variance, round(exp(0.5 * value / 100), 6) AS stddev FROM events""",
    "run_name_shape": """
SELECT DISTINCT o_orderpriority, true AS shaped, 30::INTEGER AS length FROM orders""",
}


QUERIES = {n: catalog.QUERIES[n] for n in ORACLES}
