"""Queries on training-log lines, run signals and progress, batch and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siftwork.operators import telemetry
from siftwork.plans.registry import query, table
from siftwork.session import checkpoint_dir
from siftwork.sources.readers import read_log_parts
from siftwork.streaming import supervisor

# Points made from events: a run per user, ordered by event. Losses are scaled
# down for low k, so that some spike, and lost (NaN) for high k; rewards come
# with one event type and are flat for some users.
_LOSS = "CASE WHEN event_type = 'error' THEN NULL WHEN k >= 80 THEN 'NaN'::DOUBLE WHEN k < 40 THEN value / 20 ELSE value END"
_REWARD = "CASE WHEN event_type IN ('error', 'view') THEN CASE WHEN user_id % 3 = 0 THEN 0.5 + k / 2000.0 ELSE k / 100.0 END END"
_POINTS = f"""pts AS MATERIALIZED (SELECT user_id AS run_id, event_id AS seq, event_id AS iter, {_LOSS} AS loss, {_REWARD} AS reward, false AS skipped
    FROM (SELECT *, regexp_extract(props, '\\d+')::INT AS k FROM events))"""


def _points(spark, d):
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    rows = table(spark, d, "events", "event_id", "user_id", "event_type", "value", "props").withColumn("k", k)
    loss = (
        F.when(F.col("event_type") == "error", None)
        .when(F.col("k") >= 80, F.lit(float("nan")))
        .when(F.col("k") < 40, F.col("value") / 20)
        .otherwise(F.col("value"))
    )
    flat = F.when(F.col("user_id") % 3 == 0, 0.5 + F.col("k") / 2000.0).otherwise(F.col("k") / 100.0)
    return rows.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("iter"),
        loss.cast("double").alias("loss"),
        F.when(F.col("event_type").isin("error", "view"), flat).alias("reward"),
        F.lit(False).alias("skipped"),
    )


_LINE = """CASE event_id % 6 WHEN 0 THEN 'Iter ' || event_id || ': Train loss ' || value || ', Learning Rate 1e-5'
    WHEN 1 THEN 'Iter ' || event_id || ': Val loss ' || value || ', Val total_rewards_mean ' || value || ', more'
    WHEN 2 THEN 'Iter ' || event_id || ': Val loss ' || value || ', Val took 1s' WHEN 3 THEN 'Loss: nan'
    WHEN 4 THEN 'loss 1.2.3' ELSE 'chatter ' || event_type END"""


def _lines(spark, d):
    v, i = F.col("value").cast("string"), F.col("event_id").cast("string")
    kind = F.col("event_id") % 6
    line = (
        F.when(kind == 0, F.concat(F.lit("Iter "), i, F.lit(": Train loss "), v, F.lit(", Learning Rate 1e-5")))
        .when(kind == 1, F.concat(F.lit("Iter "), i, F.lit(": Val loss "), v, F.lit(", Val total_rewards_mean "), v, F.lit(", more")))
        .when(kind == 2, F.concat(F.lit("Iter "), i, F.lit(": Val loss "), v, F.lit(", Val took 1s")))
        .when(kind == 3, F.lit("Loss: nan"))
        .when(kind == 4, F.lit("loss 1.2.3"))
        .otherwise(F.concat(F.lit("chatter "), "event_type"))
    )
    events = table(spark, d, "events", "event_id", "event_type", "value")
    return events.select(F.col("event_type").alias("run_id"), F.col("event_id").alias("seq"), line.alias("value"))


@query(
    "log_points",
    """SELECT event_type AS run_id, event_id AS seq, CASE WHEN event_id % 6 IN (0, 1) THEN event_id ELSE -1 END AS iter,
    CASE event_id % 6 WHEN 0 THEN value WHEN 2 THEN value END AS loss, event_id % 6 IN (3, 4) AS lost,
    CASE event_id % 6 WHEN 1 THEN value END AS reward FROM events WHERE event_id % 6 < 5""",
)
def log_points(spark, d):
    points = telemetry.train_points(_lines(spark, d))
    return points.select(
        "run_id", "seq", "iter", F.nullif("loss", F.lit(float("nan"))).alias("loss"),
        F.coalesce(F.isnan("loss"), F.lit(False)).alias("lost"), "reward",
    )


@query(
    "reward_variance",
    f"""WITH {_POINTS} SELECT run_id, seq, round(var_pop(reward) OVER w, 10) AS variance, first_value(seq) OVER w AS opened FROM pts
    WHERE reward IS NOT NULL WINDOW w AS (PARTITION BY run_id ORDER BY seq ROWS 9 PRECEDING) QUALIFY count(*) OVER w = 10""",
)
def reward_variance(spark, d):
    return telemetry.reward_variance(telemetry.placed_points(_points(spark, d))).withColumn("variance", F.round("variance", 10))


@query(
    "bad_loss_streaks",
    f"""WITH {_POINTS}, l AS (SELECT *, lag(isnan(loss)) OVER w AS p, lag(seq) OVER w AS opened FROM pts WHERE loss IS NOT NULL
        WINDOW w AS (PARTITION BY run_id ORDER BY seq))
    SELECT run_id, seq, opened FROM l WHERE isnan(loss) AND p""",
)
def bad_loss_streaks(spark, d):
    return telemetry.bad_losses(telemetry.placed_points(_points(spark, d)))


@query(
    "smoothed_losses",
    f"""WITH RECURSIVE {_POINTS}, l AS MATERIALIZED (SELECT run_id, seq, loss, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS n FROM pts
        WHERE loss IS NOT NULL AND NOT isnan(loss)),
    e AS (SELECT run_id, n, seq, loss AS level FROM l WHERE n = 1
        UNION ALL SELECT l.run_id, l.n, l.seq, 0.9::DOUBLE * e.level + 0.1::DOUBLE * l.loss FROM e JOIN l ON l.run_id = e.run_id AND l.n = e.n + 1)
    SELECT run_id, seq, round(level, 6) AS level FROM e""",
)
def smoothed_losses(spark, d):
    smooth = telemetry.smoothed_losses(telemetry.placed_points(_points(spark, d)))
    return smooth.select("run_id", "seq", F.round("after", 6).alias("level"))


# One step of the supervisor per point of every run. The state is (bad, level,
# rollbacks, rewards, ended); ``why`` is what the point triggers, if anything.
_STEPS = """
    l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS n FROM pts),
    s AS (
        SELECT DISTINCT run_id, 0::BIGINT AS n, -1::BIGINT AS seq, 0 AS bad, NULL::DOUBLE AS level, 0 AS rollbacks, []::DOUBLE[] AS rewards, false AS ended, NULL::VARCHAR AS kind, NULL::VARCHAR AS reason
        FROM pts
        UNION ALL
        SELECT run_id, n, seq,
            CASE WHEN why IN ('nan', 'spike') THEN 0 WHEN loss IS NULL OR why IS NOT NULL THEN bad WHEN isnan(loss) THEN bad + 1 ELSE 0 END,
            CASE WHEN why IN ('nan', 'spike') THEN NULL WHEN loss IS NULL OR isnan(loss) OR why IS NOT NULL THEN level WHEN level IS NULL THEN loss ELSE 0.9::DOUBLE * level + 0.1::DOUBLE * loss END,
            CASE WHEN why IN ('nan', 'spike') THEN rollbacks + 1 ELSE rollbacks END,
            CASE WHEN why IN ('nan', 'spike') THEN []::DOUBLE[] ELSE rw END,
            coalesce(why IN ('variance', 'skipped') OR (why IN ('nan', 'spike') AND rollbacks >= 2), false),
            CASE WHEN why IN ('variance', 'skipped') THEN 'grpo.collapsed' WHEN why IS NULL THEN NULL WHEN rollbacks >= 2 THEN 'abort' ELSE 'rollback' END,
            CASE WHEN why IN ('variance', 'skipped') OR why IS NULL OR rollbacks < 2 THEN why ELSE why || '.unrecoverable' END
        FROM (SELECT *, CASE WHEN skipped THEN 'skipped' WHEN reward IS NOT NULL AND len(rw) = 10 AND list_var_pop(rw) < 0.01 THEN 'variance'
                WHEN isnan(loss) AND bad >= 1 THEN 'nan'
                WHEN loss IS NOT NULL AND NOT isnan(loss) AND iter > 20 AND loss > level * 10 THEN 'spike' END AS why
            FROM (SELECT l.run_id, l.n, l.seq, l.iter, l.loss, l.reward, l.skipped, s.bad, s.level, s.rollbacks,
                CASE WHEN l.reward IS NULL THEN s.rewards ELSE list_append(s.rewards, l.reward)[-10:] END AS rw
                FROM s JOIN l ON l.run_id = s.run_id AND l.n = s.n + 1 WHERE NOT s.ended)))
    SELECT run_id, seq, kind, reason, CASE WHEN kind = 'rollback' THEN rollbacks END AS next_rollback_index FROM s WHERE kind IS NOT NULL"""
_SUPERVISE = f"WITH RECURSIVE {_POINTS}, {_STEPS}"


@query("supervised_runs", _SUPERVISE)
def supervised_runs(spark, d):
    return telemetry.supervise(_points(spark, d))


@query("supervised_stream", _SUPERVISE)
def supervised_stream(spark, d):
    """Points of all runs arrive in two parts; the stream is restarted in between."""
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    points = _points(spark, d)
    half = points.agg(F.percentile_approx("seq", 0.5)).first()[0]
    shape = "run_id string, seq bigint, iter bigint, loss double, reward double, skipped boolean"
    for late in (False, True):
        part = points.filter((F.col("seq") > half) == F.lit(late))
        part.withColumn("run_id", F.col("run_id").cast("string")).write.mode("append").parquet(f"{base}/in")
        signals = supervisor.supervise_stream(spark.readStream.schema(shape).parquet(f"{base}/in"))
        running = (
            signals.writeStream.format("parquet")
            .option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
    schema = "run_id string, seq bigint, kind string, reason string, next_rollback_index int"
    return spark.read.schema(schema).parquet(f"{base}/out").withColumn("run_id", F.col("run_id").cast("bigint"))


# Text logs made from events: a run per fortieth of the users, in three parts by event.
# Errors with high k are skip markers, views reward lines, sign-ups say nothing.
_PARTS = """cut AS (SELECT user_id % 40 AS run, event_id * 3 // (SELECT max(event_id) + 1 FROM events) AS part, *,
        regexp_extract(props, '\\d+')::INT AS k FROM events),
    numbered AS (SELECT *, part * 4294967296 + row_number() OVER (PARTITION BY run, part ORDER BY event_id) - 1 AS seq FROM cut),
    pts AS MATERIALIZED (SELECT run::VARCHAR AS run_id, seq, CASE WHEN event_type = 'error' AND k >= 97 THEN -1 ELSE event_id END AS iter,
        CASE WHEN event_type IN ('error', 'view') THEN NULL WHEN k >= 90 THEN 'NaN'::DOUBLE ELSE (value + 20) / 20 END AS loss,
        CASE WHEN event_type = 'view' THEN CASE WHEN run % 3 = 0 THEN 0.5 + k / 2000.0 ELSE k / 100.0 END END AS reward,
        event_type = 'error' AND k >= 97 AS skipped
        FROM numbered WHERE event_type <> 'signup' AND (event_type <> 'error' OR k >= 97))"""


def _text_logs(spark, d):
    events = table(spark, d, "events", "event_id", "user_id", "event_type", "value", "props")
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    last = events.agg(F.max("event_id")).first()[0]
    run = F.col("user_id") % 40
    step, loss = F.col("event_id").cast("string"), ((F.col("value") + 20) / 20).cast("string")
    reward = F.when(run % 3 == 0, 0.5 + k / 2000.0).otherwise(k / 100.0).cast("string")
    line = (
        F.when((F.col("event_type") == "error") & (k >= 97), F.lit("grpo.skipped no reward"))
        .when(F.col("event_type") == "error", F.lit("Traceback"))
        .when(F.col("event_type") == "view", F.concat(F.lit("Iter "), step, F.lit(": Val loss 1.0, Val total_rewards_mean "), reward))
        .when(F.col("event_type") == "signup", F.lit("chatter"))
        .otherwise(F.concat(F.lit("Iter "), step, F.lit(": Train loss "), F.when(k >= 90, F.lit("nan")).otherwise(loss)))
    )
    part = F.floor(F.col("event_id") * 3 / (last + 1))
    return events.select(run.alias("run"), part.alias("part"), "event_id", line.alias("value"))


@query("supervised_text_logs", f"WITH RECURSIVE {_PARTS}, {_STEPS}")
def supervised_text_logs(spark, d):
    """Raw lines as text files in parts; the later parts arrive first, and the stream is restarted."""
    base = f"{checkpoint_dir(spark)}/logs-{uuid.uuid4().hex}"
    lines = _text_logs(spark, d)
    for arriving in ("part > 0", "part < 2"):
        chosen = lines.filter(arriving).repartition("run", "part").sortWithinPartitions("run", "part", "event_id")
        chosen.drop("event_id").write.mode("append").partitionBy("run", "part").text(f"{base}/in")
        parts = read_log_parts(spark, f"{base}/in", pattern=r"run=(\d+)/part=(\d+)/[^/]+$")
        signals = supervisor.supervise_parts(supervisor.part_points(parts, "grpo"))
        running = (
            signals.writeStream.format("parquet")
            .option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
    schema = "run_id string, seq bigint, kind string, reason string, next_rollback_index int"
    return spark.read.schema(schema).parquet(f"{base}/out")


@query(
    "latest_checkpoints",
    """SELECT user_id AS run_id, max(event_id) AS iter, lpad(max(event_id)::VARCHAR, 7, '0') || '_adapters.safetensors' AS checkpoint
    FROM events WHERE event_type = 'click' GROUP BY 1""",
)
def latest_checkpoints(spark, d):
    name = F.when(
        F.col("event_type") == "click", F.format_string("%07d_adapters.safetensors", F.col("event_id"))
    ).otherwise(F.concat(F.col("event_id").cast("string"), F.lit("_adapters.safetensors.tmp")))
    listing = table(spark, d, "events", "event_id", "user_id", "event_type").select(
        F.col("user_id").alias("run_id"), name.alias("name")
    )
    return telemetry.latest_checkpoint(listing, "run_id")


_ABORTED = "CASE WHEN event_type = 'error' THEN CASE WHEN k < 50 THEN 'rollback.nan' ELSE 'spike.unrecoverable' END END"


@query(
    "run_progress",
    f"""WITH p AS (SELECT *, {_ABORTED} AS aborted, CASE WHEN event_type = 'click' THEN value END AS loss
        FROM (SELECT *, regexp_extract(props, '\\d+')::INT AS k FROM events)),
    g AS (SELECT user_id AS run_id, arg_max(event_id, event_id) FILTER (aborted IS NULL) AS iter, arg_max(loss, event_id) FILTER (aborted IS NULL AND loss IS NOT NULL) AS loss,
        arg_max(coalesce(aborted, ''), event_id) AS last, arg_max(aborted, event_id) FILTER (aborted IS NOT NULL) AS message FROM p GROUP BY 1)
    SELECT run_id, iter, loss, CASE WHEN last = '' THEN 'running' WHEN last LIKE 'rollback%' THEN 'rollback' ELSE 'error' END AS status, message FROM g""",
)
def run_progress(spark, d):
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    reason = F.when(k < 50, "rollback.nan").otherwise("spike.unrecoverable")
    points = table(spark, d, "events", "event_id", "user_id", "event_type", "value", "props").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("iter"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("loss"),
        F.when(F.col("event_type") == "error", reason).alias("aborted"),
    )
    return telemetry.progress(points)


@query(
    "stage_status",
    """SELECT user_id AS stage, arg_max(CASE event_type WHEN 'error' THEN 'err' WHEN 'view' THEN 'start' ELSE 'ok' END, event_id) AS status,
    arg_max(props, event_id) AS detail FROM events GROUP BY 1""",
)
def stage_status(spark, d):
    status = F.when(F.col("event_type") == "error", "err").when(F.col("event_type") == "view", "start").otherwise("ok")
    events = table(spark, d, "events", "event_id", "user_id", "event_type", "props").select(
        F.col("user_id").alias("stage"), F.col("event_id").alias("seq"), status.alias("status"), F.col("props").alias("detail")
    )
    return telemetry.stage_status(events)
