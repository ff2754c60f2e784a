"""Queries over a training log, read from ``events``: run = user, loss = value.

The iteration is the place of an event in its run, ordered by ``(ts, event_id)``.
Averages are taken over pi times the values: unlike the values themselves these are no
short decimal fractions, so that rounding never meets a tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.functions import metrics, nested
from corpusflow.functions.lists import array_histogram as histogram_of
from corpusflow.operators import runlog
from corpusflow.operators.scan import number_rows
from corpusflow.plans.registry import query
from corpusflow.scratch import scratch_path
from corpusflow.sinks.tables import write_run_metrics
from corpusflow.sources.tables import read_table

LOG = """
    log AS (
        SELECT user_id AS run_id, event_id, ts, event_type, value AS loss,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS iter
        FROM events
    ),
    timed AS (
        SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY run_id ORDER BY iter))) / 1000000.0::DOUBLE AS dt
        FROM log
    )"""
# Four consecutive events are the micro-steps of one iteration.
STEPS = f"""
    WITH {LOG},
    steps AS (
        SELECT run_id, iter // 4 AS iter, list(loss * pi() ORDER BY iter) AS dt, list(loss * pi() / 3 ORDER BY iter) AS dtf,
               list(loss * pi() - loss * pi() / 3 ORDER BY iter) AS dtb
        FROM log GROUP BY run_id, iter // 4
    )"""
GAS = 4


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """``(run_id, iter, event_id, ts, event_type, loss)``."""
    events = read_table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"), "event_id", "ts", "event_type", F.col("value").alias("loss")
    )
    return number_rows(events, ["run_id"], ["ts", "event_id"], out="iter")


def micro_steps(spark: SparkSession, folder: str) -> DataFrame:
    """One row per iteration with arrays of micro-step times; a group holds four rows at most."""
    log = run_log(spark, folder).withColumn("iter", F.expr(f"iter div {GAS}").alias("iter")).withColumn("at", F.struct("ts", "event_id"))
    steps = log.groupBy("run_id", "iter").agg(F.array_sort(F.collect_list(F.struct("at", "loss"))).alias("s"))
    loss = F.col("s.loss")
    return steps.select(
        "run_id",
        "iter",
        F.transform(loss, lambda v: v * F.pi()).alias("dt"),
        F.transform(loss, lambda v: v * F.pi() / 3).alias("dtf"),
        F.transform(loss, lambda v: v * F.pi() - v * F.pi() / 3).alias("dtb"),
    )


@query(f"WITH {LOG} SELECT run_id, iter, event_id, loss FROM log")
def run_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The numbering of the log itself."""
    return run_log(spark, folder).select("run_id", "iter", "event_id", "loss")


@query("""
    SELECT event_id, event_type AS "event/type", user_id AS "event/user",
           CAST(json_extract(props, '$.k') AS BIGINT) AS "event/props/k", value
    FROM events
""")
def flatten_events(spark: SparkSession, folder: str) -> DataFrame:
    """Nested columns, one of them from JSON, flattened to names with slashes."""
    events = read_table(spark, folder, "events")
    props = F.from_json("props", "struct<k: bigint>").alias("props")
    nest = F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"), props).alias("event")
    return nested.flatten_struct(events.select("event_id", nest, "value"))


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS "props/k",
           CASE WHEN event_type = 'click' THEN value END AS "of/click", CASE WHEN event_type = 'error' THEN value END AS "of/error",
           CASE WHEN event_type = 'purchase' THEN value END AS "of/purchase", CASE WHEN event_type = 'signup' THEN value END AS "of/signup",
           CASE WHEN event_type = 'view' THEN value END AS "of/view"
    FROM events
""")
def flatten_event_maps(spark: SparkSession, folder: str) -> DataFrame:
    """MAP columns, whose keys differ from row to row, as plain columns."""
    events = read_table(spark, folder, "events")
    props = F.from_json("props", "map<string, double>").alias("props")
    return nested.flatten_maps(events.select("event_id", props, F.create_map("event_type", "value").alias("of")))


@query("SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events")
def rows_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows to JSON text and back."""
    events = read_table(spark, folder, "events")
    back = nested.json_to_rows(nested.rows_to_json(events), events.schema)
    return back.select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "user_id", "event_type", "value", "props"
    )


@query(f"""
    WITH {LOG}
    SELECT run_id, iter, round(1000000 * CASE
        WHEN iter < 8 THEN 6e-4::DOUBLE * iter / 8
        WHEN iter > 48 THEN 6e-5::DOUBLE
        ELSE 6e-5::DOUBLE + 0.5::DOUBLE * (1 + cos(pi() * (iter - 8) / 40.0::DOUBLE)) * (6e-4::DOUBLE - 6e-5::DOUBLE)
    END, 6) AS lr_micro
    FROM log
""")
def lr_schedule(spark: SparkSession, folder: str) -> DataFrame:
    rate = metrics.lr_at("iter", lr=6e-4, min_lr=6e-5, warmup=8, decay=48)
    return run_log(spark, folder).select("run_id", "iter", F.round(rate * 1000000, 6).alias("lr_micro"))


@query(f"WITH {LOG} SELECT run_id, iter, round(dt, 6) AS dt FROM timed")
def step_dt(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.step_dt(run_log(spark, folder), dense=True).select("run_id", "iter", F.round("dt", 6).alias("dt"))


@query(f"""
    WITH {LOG}
    SELECT run_id, iter, round(loss * 5, 6) AS loss_tot, round(491520.0::DOUBLE / nullif(dt, 0), 3) AS tokens_per_sec,
           round(40.0::DOUBLE / nullif(dt, 0), 6) AS samples_per_sec,
           round(491520.0::DOUBLE / nullif(dt, 0) / 8, 3) AS tokens_per_sec_per_gpu,
           round(40.0::DOUBLE / nullif(dt, 0) / 8, 6) AS samples_per_sec_per_gpu
    FROM timed
""")
def step_throughput(spark: SparkSession, folder: str) -> DataFrame:
    rates = metrics.throughput("dt", metrics.BatchShape(gas=5, world=8, batch=12, block=1024))
    digits = {name: 3 if name.startswith("tokens") else 6 for name in rates}
    return runlog.step_dt(run_log(spark, folder), dense=True).select(
        "run_id",
        "iter",
        F.round(metrics.loss_total("loss", 5), 6).alias("loss_tot"),
        *[F.round(rate, digits[name]).alias(name) for name, rate in rates.items()],
    )


@query(f"""
    WITH {LOG}
    SELECT run_id, iter, round((6.0 * 123653376 + 12.0 * 12 * 12 * 64 * 1024) * 1024 * 60 / nullif(dt, 0) / 312e12, 9) AS mfu
    FROM timed
""")
def step_mfu(spark: SparkSession, folder: str) -> DataFrame:
    shape = metrics.ModelShape(n_layer=12, n_head=12, n_embd=768, block_size=1024, vocab_size=50257, bias=True)
    share = metrics.mfu("dt", shape, passes=60)
    return runlog.step_dt(run_log(spark, folder), dense=True).select("run_id", "iter", F.round(share, 9).alias("mfu"))


@query(f"WITH {LOG} SELECT run_id, iter, loss FROM log WHERE iter % 10 = 0 AND iter < 50")
def log_interval(spark: SparkSession, folder: str) -> DataFrame:
    """Logged steps of the first 50 iterations."""
    log = runlog.first_iters(run_log(spark, folder), 50)
    return runlog.every_n(log, 10).select("run_id", "iter", "loss")


@query(f"""
    WITH {LOG}, sizes AS (SELECT run_id, max(iter) + 1 AS n FROM log GROUP BY run_id)
    SELECT run_id, iter, CASE WHEN n < 64 THEN greatest(1, n // 20) ELSE 64 END AS log_interval
    FROM log JOIN sizes USING (run_id) WHERE iter % CASE WHEN n < 64 THEN greatest(1, n // 20) ELSE 64 END = 0
""")
def log_interval_auto(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.logged_steps(run_log(spark, folder), 64).select("run_id", "iter", "log_interval")


_EMA = """round(list_reduce(
        list({0}) OVER (PARTITION BY run_id ORDER BY iter ROWS UNBOUNDED PRECEDING),
        lambda old, new: 0.9::DOUBLE * old + 0.1::DOUBLE * new), 6)"""


@query(f"WITH {LOG} SELECT run_id, iter, {_EMA.format('loss * pi()')} AS ema FROM log")
def ema_loss(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.ema(run_log(spark, folder).withColumn("loss", F.col("loss") * F.pi())).select("run_id", "iter", F.round("ema", 6).alias("ema"))


@query(f"""
    WITH {LOG}, used AS (
        SELECT run_id, iter, (6.0 * 123653376 + 12.0 * 12 * 12 * 64 * 1024) * 1024 * 60 / nullif(dt, 0) / 312e12 AS mfu
        FROM timed WHERE iter % 5 = 0
    ),
    averaged AS (SELECT run_id, iter, {_EMA.format('100 * mfu')} AS mfu FROM used WHERE mfu IS NOT NULL)
    SELECT run_id, iter, averaged.mfu FROM used LEFT JOIN averaged USING (run_id, iter)
""")
def running_mfu(spark: SparkSession, folder: str) -> DataFrame:
    """Moving average of the utilisation over logged steps, in per cent; steps without a time have none."""
    shape = metrics.ModelShape(vocab_size=50257, bias=True)
    logged = runlog.every_n(runlog.step_dt(run_log(spark, folder), dense=True), 5)
    shares = logged.select("run_id", "iter", (100 * metrics.mfu("dt", shape, passes=60)).alias("share"))
    return runlog.ema(shares, "share", out="mfu").select("run_id", "iter", F.round("mfu", 6).alias("mfu"))


@query(f"""
    WITH {LOG}, evals AS (SELECT run_id, iter, loss AS val FROM log),
    best AS (
        SELECT *, coalesce(min(val) OVER (PARTITION BY run_id ORDER BY iter ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e9) AS best
        FROM evals
    )
    SELECT run_id, iter, val, best, iter > 0 AND val < best AS save FROM best
""")
def best_loss(spark: SparkSession, folder: str) -> DataFrame:
    evals = run_log(spark, folder).select("run_id", "iter", F.col("loss").alias("val"))
    return runlog.best_so_far(evals).select("run_id", "iter", "val", "best", "save")


@query("SELECT event_type AS split, round(avg(value * pi()), 6) AS loss FROM events GROUP BY event_type")
def mean_loss(spark: SparkSession, folder: str) -> DataFrame:
    losses = read_table(spark, folder, "events").select(F.col("event_type").alias("split"), (F.col("value") * F.pi()).alias("loss"))
    return runlog.mean_loss(losses).select("split", F.round("loss", 6).alias("loss"))


@query(STEPS + """
    SELECT run_id, iter, round(list_sum(dt), 6) AS dt_tot, round(list_avg(dt), 6) AS dt_avg,
           round(list_sum(dtf), 6) AS dtf_tot, round(list_avg(dtf), 6) AS dtf_avg,
           round(list_sum(dtb), 6) AS dtb_tot, round(list_avg(dtb), 6) AS dtb_avg
    FROM steps
""")
def timer_summary(spark: SparkSession, folder: str) -> DataFrame:
    summed = runlog.timer_summary(micro_steps(spark, folder))
    names = [f"{timer}_{kind}" for timer in ("dt", "dtf", "dtb") for kind in ("tot", "avg")]
    return summed.select("run_id", "iter", *[F.round(n, 6).alias(n) for n in names])


@query("""
    SELECT user_id AS run_id, round(sum(value * pi()), 5) AS dt_tot, round(avg(value * pi()), 5) AS dt_avg,
           round(sum(value * pi() / 3), 5) AS dtf_tot, round(avg(value * pi() / 3), 5) AS dtf_avg,
           round(sum(value * pi() - value * pi() / 3), 5) AS dtb_tot, round(avg(value * pi() - value * pi() / 3), 5) AS dtb_avg
    FROM events GROUP BY user_id
""")
def timer_totals(spark: SparkSession, folder: str) -> DataFrame:
    summed = runlog.timer_totals(micro_steps(spark, folder))
    return summed.select("run_id", *[F.round(c, 5).alias(c) for c in summed.columns if c != "run_id"])


@query("""
    SELECT key, round(value, 5) AS value FROM (
        SELECT 'loss' AS key, avg(value * pi()) AS value FROM events
        UNION ALL SELECT 'high/loss', avg(value * pi()) FILTER (WHERE value > 50) FROM events
        UNION ALL SELECT 'high/k', avg(CAST(json_extract(props, '$.k') AS BIGINT) * pi()) FROM events
    )
""")
def average_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Means over nested metrics, one of them missing in some rows and one in all."""
    events = read_table(spark, folder, "events")
    nest = F.struct(
        F.when(F.col("value") > 50, F.col("value") * F.pi()).alias("loss"),
        (F.get_json_object("props", "$.k").cast("int") * F.pi()).alias("k"),
        F.lit(None).cast("double").alias("none"),
    )
    averaged = runlog.average_metrics(events.select((F.col("value") * F.pi()).alias("loss"), nest.alias("high")))
    return averaged.select("key", F.round("value", 5).alias("value"))


@query("""
    WITH ranges AS (SELECT event_type, min(value) AS low, max(value) AS high FROM events GROUP BY event_type),
    guessed AS (
        SELECT event_type, low, high, value, (high - low) / 64 AS step,
               least(CAST(floor((value - low) / (high - low) * 64) AS INTEGER), 63) AS g
        FROM events JOIN ranges USING (event_type)
    )
    SELECT event_type, CASE WHEN value < low + g * step THEN g - 1
                            WHEN value >= low + (g + 1) * step AND g <> 63 THEN g + 1 ELSE g END AS bin,
           low, high, count(*) AS cnt
    FROM guessed GROUP BY ALL
""")
def loss_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.histogram(read_table(spark, folder, "events"), "value", bins=64, by=["event_type"])


@query(STEPS + """
    , ranges AS (SELECT run_id, iter, dt, list_min(dt) AS lo, list_max(dt) AS hi FROM steps),
    bins AS (
        SELECT run_id, iter, lo, hi, dt, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS low,
               CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS high,
               CASE WHEN lo = hi THEN 1.0::DOUBLE ELSE hi - lo END AS width FROM ranges
    ),
    guessed AS (
        SELECT *, unnest(dt) AS v FROM bins
    ),
    placed AS (
        SELECT *, least(CAST(floor((v - low) / width * 4) AS INTEGER), 3) AS g FROM guessed
    ),
    fixed AS (
        SELECT *, CASE WHEN v < low + g * (width / 4) THEN g - 1 WHEN v >= low + (g + 1) * (width / 4) AND g <> 3 THEN g + 1 ELSE g END AS bin
        FROM placed
    )
    SELECT run_id, iter, low, high, count(*) FILTER (WHERE bin = 0) || ',' || count(*) FILTER (WHERE bin = 1) || ',' ||
           count(*) FILTER (WHERE bin = 2) || ',' || count(*) FILTER (WHERE bin = 3) AS counts
    FROM fixed GROUP BY run_id, iter, low, high
""")
def array_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """A histogram for the timer array of every iteration."""
    made = micro_steps(spark, folder).withColumn("h", histogram_of("dt", bins=4))
    counts = F.array_join(F.col("h.counts").cast("array<string>"), ",")
    return made.select("run_id", "iter", "h.low", "h.high", counts.alias("counts"))


@query(STEPS + """
    , bins AS (
        SELECT run_id, iter, dt, list_min(dt) AS lo, list_max(dt) AS hi FROM steps
    ),
    placed AS (
        SELECT run_id, iter, lo, hi, unnest(dt) AS v FROM bins
    ),
    counted AS (
        SELECT run_id, iter, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS low, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS high,
               count(*) FILTER (WHERE lo < hi AND v < lo + (hi - lo) / 2) AS below, count(*) AS n
        FROM placed GROUP BY ALL
    )
    SELECT run_id, iter, 'Timing' AS grp, 'dt/low' AS key, round(low, 6) AS value FROM counted
    UNION ALL SELECT run_id, iter, 'Timing', 'dt/high', round(high, 6) FROM counted
    UNION ALL SELECT run_id, iter, 'Timing', 'dt/0', CAST(below AS DOUBLE) FROM counted
    UNION ALL SELECT run_id, iter, 'Timing', 'dt/1', CAST(n - below AS DOUBLE) FROM counted
    UNION ALL SELECT run_id, iter, 'Loss', 'first', round(dt[1], 6) FROM steps
""")
def metrics_long_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """An array metric in long form: its range and the counts of two bins, beside a plain one."""
    steps = micro_steps(spark, folder).withColumn("first", F.col("dt")[0])
    long = runlog.metrics_long(steps, {"Timing": ["dt"], "Loss": ["first"]}, bins=2)
    return long.withColumn("value", F.round("value", 6))


@query(f"""
    WITH {LOG}, wide AS (SELECT run_id, iter, loss, 5 * loss AS loss_tot, round(dt, 6) AS dt FROM timed)
    SELECT run_id, iter, 'Training' AS grp, 'loss' AS key, loss AS value FROM wide
    UNION ALL SELECT run_id, iter, 'Loss', 'loss_tot', loss_tot FROM wide
    UNION ALL SELECT run_id, iter, 'Timing', 'dt', dt FROM wide
""")
def metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics in long form, written and read back."""
    timed = runlog.step_dt(run_log(spark, folder), dense=True)
    wide = timed.select("run_id", "iter", "loss", metrics.loss_total("loss", 5).alias("loss_tot"), F.round("dt", 6).alias("dt"))
    long = runlog.metrics_long(wide, {"Training": ["loss"], "Loss": ["loss_tot"], "Timing": ["dt"]})
    path = scratch_path(spark, "metrics")
    write_run_metrics(long, path)
    return spark.read.parquet(path).select("run_id", "iter", "grp", "key", "value")
