"""Training-log lines, points and the signals a supervisor derives from them.

A run is an ordered sequence, yet no operator here gathers a run in one task.
Points get a dense position within their run, are cut into blocks of ``BLOCK``
points, and each block is judged alone:

* reward variance needs the nine rewards before, bad-loss streaks one loss, so
  a block repeats the few points before it;
* the smoothed loss is affine in the level it starts from, so a block is summed
  up in one row, the rows of a run are folded, and every block is replayed from
  its true level, beginning ``REPLAY`` points early so that the last bits of the
  fold fade.

A supervisor signal restarts its run, and a run has at most ``max_rollbacks``
restarts, so all first signals, then all second ones, and so on are found by
that many passes, whatever the number and length of runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwork.operators.ordering import running_counts
from siftwork.session import broadcast_if_small, cut

BLOCK = 8192
REPLAY = 1024

# The log line shapes, tried in this order, and the skip marker.
NUMBER = r"[\d.]+"
NUMBER_OR_WORD = r"[\d.]+|[+-]?(?:(?i)nan|inf(?:inity)?)"
TRAIN_LINE = r"Iter\s+(\d+):\s+Train loss\s+({n})"
REWARD_LINE = r"^Iter\s+(\d+):\s+Val loss\s+({n}),\s+Val total_rewards_mean\s+({n})"
LOSS_LINE = r"(?i)loss[:\s]+({n})"
SKIP_MARKER = "grpo.skipped"
CHECKPOINT_NAME = r"^(\d{7})_adapters\.safetensors$"


@dataclass(frozen=True)
class Limits:
    """Fixed values of the supervisor."""

    bad_streak: int = 2
    spike_factor: float = 10.0
    warmup_iters: int = 20
    max_rollbacks: int = 2
    window: int = 10
    variance_floor: float = 0.01
    keep: float = 0.9
    take: float = 0.1


# --- lines to points ----------------------------------------------------------


def parse_line(line: Column, words: bool = True, val_loss: str = "parity") -> Column:
    """``struct(iter, loss, reward)`` of a log line, or null for any other line.

    ``words`` also reads ``nan`` and ``inf`` as losses. Validation-loss lines
    count as losses with iter -1; ``val_loss="exclude"`` leaves them out.
    """
    # only the number words ignore case; the line shapes do not
    n = NUMBER_OR_WORD if words else NUMBER
    train, reward = TRAIN_LINE.replace("{n}", n), REWARD_LINE.replace("{n}", n)
    loss = LOSS_LINE.replace("{n}", n)

    def number(pattern: str, group: int) -> Column:
        text = F.lower(F.regexp_extract(line, pattern, group))
        return F.coalesce(text.try_cast("double"), F.lit(float("nan")))

    def point(it: Column, loss_value: Column | None, reward_value: Column | None) -> Column:
        null = F.lit(None).cast("double")
        return F.struct(
            it.cast("bigint").alias("iter"),
            (null if loss_value is None else loss_value).alias("loss"),
            (null if reward_value is None else reward_value).alias("reward"),
        )

    def iteration(pattern: str) -> Column:
        return F.regexp_extract(line, pattern, 1).try_cast("bigint")

    fallback = line.rlike(loss)
    if val_loss == "exclude":
        fallback = fallback & ~line.rlike(r"(?i)\bval loss")
    return (
        F.when(line.rlike(train), point(iteration(train), number(train, 2), None))
        .when(line.rlike(reward), point(iteration(reward), None, number(reward, 3)))
        .when(fallback, point(F.lit(-1), number(loss, 1), None))
    )


def train_points(lines: DataFrame, line: str = "value", **options) -> DataFrame:
    """Lines that parse, with ``iter``, ``loss`` and ``reward``; a projection and a filter."""
    parsed = lines.withColumn("_point", parse_line(F.col(line), **options))
    others = [c for c in lines.columns if c != line]
    return parsed.filter("_point is not null").select(*others, "_point.*")


def is_bad(loss: Column) -> Column:
    return F.isnan(loss) | (F.abs(loss) == float("inf"))


# --- blocks of a run ------------------------------------------------------------


def placed_points(points: DataFrame) -> DataFrame:
    """Points with their positions among the run's rewards, losses and good losses.

    Stored once; all signal operators read it.
    """
    reward, loss = F.col("reward"), F.col("loss")
    return cut(
        running_counts(
            points.select("run_id", "seq", "iter", "loss", "reward"),
            "run_id",
            "seq",
            at_reward=reward.isNotNull() & ~is_bad(reward),
            at_loss=loss.isNotNull(),
            at_good=loss.isNotNull() & ~is_bad(loss),
        )
    )


def _blocks(placed: DataFrame, overlap: int) -> DataFrame:
    """Add ``block`` and ``lead_in``; the last ``overlap`` points open the next block too."""
    size = max(BLOCK, 4 * overlap)
    block = F.floor(F.col("at") / size)
    own = F.struct(block.alias("block"), F.lit(False).alias("lead_in"))
    next_one = F.struct((block + 1).alias("block"), F.lit(True).alias("lead_in"))
    copies = F.when(F.col("at") % size >= size - overlap, F.array(own, next_one)).otherwise(
        F.array(own)
    )
    return placed.withColumn("_copy", F.explode(copies)).select("*", "_copy.*").drop("_copy")


def reward_variance(placed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Population variance of the last ``window`` finite rewards once there are that many.

    Takes placed points. Returns ``(run_id, seq, variance, opened)``;
    ``opened`` is the seq of the oldest reward in the window.
    """
    rewards = placed.filter("reward is not null").filter(~is_bad(F.col("reward")))
    rewards = rewards.select("run_id", "seq", "reward", F.col("at_reward").alias("at"))
    blocks = _blocks(rewards, limits.window - 1)
    order = Window.partitionBy("run_id", "block").orderBy("at")
    frame = order.rowsBetween(1 - limits.window, 0)
    return (
        blocks.withColumn("variance", F.var_pop("reward").over(frame))
        .withColumn("opened", F.lag("seq", limits.window - 1).over(order))
        .filter("not lead_in and opened is not null")
        .select("run_id", "seq", "variance", "opened")
    )


def bad_losses(placed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Bad losses that end a streak of ``bad_streak``: ``(run_id, seq, opened)``."""
    losses = placed.filter("loss is not null").select(
        "run_id", "seq", is_bad(F.col("loss")).alias("bad"), F.col("at_loss").alias("at")
    )
    reach = limits.bad_streak - 1
    blocks = _blocks(losses, reach)
    order = Window.partitionBy("run_id", "block").orderBy("at")
    return (
        blocks.withColumn("_all", F.min("bad").over(order.rowsBetween(-reach, 0)))
        .withColumn("opened", F.lag("seq", reach).over(order))
        .filter("not lead_in and _all and opened is not null")
        .select("run_id", "seq", "opened")
    )


def smoothed_losses(placed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Moving average of the good losses of each run, seeded by the first.

    Returns ``(run_id, seq, iter, loss, before, after)``; ``before`` is null on
    the first. Every loss is absorbed here: a spike restarts its run, so
    values after a run's first spike are not to be used.
    """
    good = placed.filter("loss is not null").filter(~is_bad(F.col("loss")))
    good = good.select("run_id", "seq", "iter", "loss", F.col("at_good").alias("at"))
    keep, take = limits.keep, limits.take
    starts = _block_starts(good, keep, take).withColumnsRenamed({"run_id": "_run", "block": "_block"})
    met = _blocks(good, REPLAY).join(
        broadcast_if_small(starts), (F.col("run_id") == F.col("_run")) & (F.col("block") == F.col("_block")), "left"
    ).drop("_run", "_block")

    # Runs are many and short or few and long: rows of all groups go through in order, not group by group.
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, level = None, None
        for batch in batches:
            before, after = [], []
            for run, block, loss, start in zip(*(batch.column(c).to_pylist() for c in ("run_id", "block", "loss", "start"))):
                if group != (run, block):
                    group, level = (run, block), start
                before.append(level)
                level = loss if level is None else keep * level + take * loss
                after.append(level)
            out = [batch.column(c) for c in ("run_id", "seq", "iter", "loss")]
            out += [pa.array(before, pa.float64()), pa.array(after, pa.float64())]
            out = pa.RecordBatch.from_arrays(out, names=["run_id", "seq", "iter", "loss", "before", "after"])
            yield out.filter(pc.invert(batch.column("lead_in")))

    run_type = placed.schema["run_id"].dataType.simpleString()
    schema = (
        f"run_id {run_type}, seq bigint, iter bigint, loss double, before double, after double"
    )
    met = met.repartition("run_id", "block").sortWithinPartitions("run_id", "block", "at")
    return met.select("run_id", "seq", "iter", "loss", "block", "start", "lead_in").mapInArrow(fold, schema)


def _block_starts(good: DataFrame, keep: float, take: float) -> DataFrame:
    """Level ``REPLAY`` points before every block but a run's first: ``(run_id, block, start)``.

    ``own`` is what the ``BLOCK`` points from there on add to ``keep ** BLOCK``
    times that level. The first loss of a run counts in full, so its block is
    corrected. One row per ``BLOCK`` points is folded for a run.
    """
    shifted = F.col("at") + REPLAY
    weight = F.pow(F.lit(keep), BLOCK - 1 - shifted % BLOCK)
    sums = good.groupBy("run_id", F.floor(shifted / BLOCK).alias("block")).agg(
        (take * F.sum(F.col("loss") * weight)).alias("own"),
        F.min("at").alias("at"),
        F.min_by("loss", "at").alias("first"),
    )
    faded = keep**BLOCK

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, level, is_first = None, None, True
        for batch in batches:
            starts = []
            for run, own, at, first in zip(*(batch.column(c).to_pylist() for c in ("run_id", "own", "at", "first"))):
                if is_first or run != last:
                    last, level, is_first = run, None, False
                starts.append(level)
                seeded = (1 - take) * keep ** (BLOCK - 1 - (at + REPLAY) % BLOCK) * first
                level = own + (seeded if level is None else faded * level)
            yield pa.RecordBatch.from_arrays(
                [batch.column("run_id"), batch.column("block"), pa.array(starts, pa.float64())], names=["run_id", "block", "start"]
            )

    run_type = good.schema["run_id"].dataType.simpleString()
    ordered = sums.repartition("run_id").sortWithinPartitions("run_id", "block")
    return ordered.select("run_id", "block", "own", "at", "first").mapInArrow(fold, f"run_id {run_type}, block bigint, start double")


def _spikes(placed: DataFrame, limits: Limits) -> DataFrame:
    return smoothed_losses(placed, limits).filter(
        (F.col("iter") > limits.warmup_iters)
        & F.col("before").isNotNull()
        & (F.col("loss") > F.col("before") * limits.spike_factor)
    )


# --- supervisor -------------------------------------------------------------------


def supervise(points: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Signals of every run: ``(run_id, seq, kind, reason, next_rollback_index)``.

    ``points`` has ``(run_id, seq, iter, loss, reward, skipped)`` with a unique
    seq per run; ``skipped`` marks a skip line. Points without a row continue.
    A rollback clears the state of its run; an abort or collapse ends it.
    """
    spark = points.sparkSession
    points = points.select(
        "run_id",
        F.col("seq").cast("bigint").alias("seq"),
        F.col("iter").cast("bigint").alias("iter"),
        F.col("loss").cast("double").alias("loss"),
        F.col("reward").cast("double").alias("reward"),
        "skipped",
    )
    placed = placed_points(points)
    flat = cut(
        reward_variance(placed, limits).filter(F.col("variance") < limits.variance_floor).select(
            "run_id", "seq", "opened", F.lit(0).alias("rank"), F.lit("variance").alias("what")
        )
        .unionByName(
            bad_losses(placed, limits).select(
                "run_id", "seq", "opened", F.lit(1).alias("rank"), F.lit("nan").alias("what")
            )
        )
        .unionByName(
            points.filter("skipped").select(
                "run_id",
                "seq",
                F.col("seq").alias("opened"),
                F.lit(0).alias("rank"),
                F.lit("skipped").alias("what"),
            )
        )
    )
    run_type = points.schema["run_id"].dataType.simpleString()
    signals = spark.createDataFrame(
        [], f"run_id {run_type}, seq bigint, kind string, reason string, next_rollback_index int"
    )
    state = None
    for rollbacks in range(limits.max_rollbacks + 1):
        if state is None:
            fresh, recent = flat, placed
        else:
            starts = broadcast_if_small(state)
            fresh = flat.join(starts, "run_id").filter("opened > start").drop("start")
            recent = placed.join(starts, "run_id").filter("seq > start").drop("start")
        jumps = _spikes(recent, limits).select(
            "run_id", "seq", F.col("seq").alias("opened"), F.lit(1).alias("rank"), F.lit("spike").alias("what")
        )
        first = (
            fresh.unionByName(jumps)
            .groupBy("run_id")
            .agg(F.min(F.struct("seq", "rank", "what")).alias("e"))
            .select("run_id", "e.seq", "e.what")
        )
        ends = F.col("what").isin("variance", "skipped")
        last_chance = rollbacks >= limits.max_rollbacks
        found = cut(
            first.select(
                "run_id",
                "seq",
                F.when(ends, "grpo.collapsed")
                .otherwise(F.lit("abort" if last_chance else "rollback"))
                .alias("kind"),
                F.when(ends | F.lit(not last_chance), F.col("what"))
                .otherwise(F.concat("what", F.lit(".unrecoverable")))
                .alias("reason"),
                F.when(ends | F.lit(last_chance), F.lit(None))
                .otherwise(F.lit(rollbacks + 1))
                .cast("int")
                .alias("next_rollback_index"),
            )
        )
        signals = signals.unionByName(found)
        state = found.filter("kind = 'rollback'").select("run_id", F.col("seq").alias("start"))
        if state.isEmpty():
            break
    return signals


def signal_points(signals: DataFrame, checkpoints: DataFrame | None = None) -> DataFrame:
    """Points shown for signals: ``(run_id, seq, iter, aborted)``.

    A rollback reports the iteration it returns to (from a checkpoint listing
    ``(run_id, name)``), anything else -1.
    """
    reverted = F.lit(-1).cast("bigint")
    if checkpoints is not None:
        signals = signals.join(latest_checkpoint(checkpoints, "run_id"), "run_id", "left")
        reverted = F.when(F.col("kind") == "rollback", F.col("iter")).otherwise(reverted)
    reason = F.when(F.col("kind") == "rollback", F.concat(F.lit("rollback."), "reason"))
    return signals.select(
        "run_id", "seq", reverted.alias("iter"), F.coalesce(reason, "reason").alias("aborted")
    )


def latest_checkpoint(listing: DataFrame, *by: str, name: str = "name") -> DataFrame:
    """Highest-numbered checkpoint by value, per group: ``(..., iter, name)``."""
    number = F.regexp_extract(F.col(name), CHECKPOINT_NAME, 1)
    numbered = listing.filter(F.col(name).rlike(CHECKPOINT_NAME)).withColumn(
        "_iter", number.cast("bigint")
    )
    return numbered.groupBy(*by).agg(
        F.max("_iter").alias("iter"), F.max_by(name, "_iter").alias("checkpoint")
    )


def rollback_target(listing: DataFrame, name: str = "name") -> int:
    """Iteration of the latest checkpoint; an error when there is none."""
    found = latest_checkpoint(listing, name=name).first()
    if found["iter"] is None:
        raise FileNotFoundError("no numbered checkpoint to revert to")
    return found["iter"]


def progress(points: DataFrame) -> DataFrame:
    """Per run: latest iteration, last known loss, status and message.

    ``points`` has ``(run_id, seq, iter, loss, aborted)``. All parts are
    combinable aggregates, so runs of any length reduce before the shuffle.
    """
    live = F.col("aborted").isNull()
    last = F.max_by(F.struct("aborted"), F.col("seq"))["aborted"]
    return points.groupBy("run_id").agg(
        F.max_by(F.col("iter"), F.when(live, F.col("seq"))).alias("iter"),
        F.max_by(F.col("loss"), F.when(live & F.col("loss").isNotNull(), F.col("seq"))).alias("loss"),
        F.when(last.isNull(), "running")
        .when(last.startswith("rollback"), "rollback")
        .otherwise("error")
        .alias("status"),
        F.max_by(F.col("aborted"), F.when(~live, F.col("seq"))).alias("message"),
    )


def stage_status(events: DataFrame) -> DataFrame:
    """Latest status and detail per stage from ``(stage, seq, status, detail)``."""
    latest = events.groupBy("stage").agg(F.max_by(F.struct("status", "detail"), "seq").alias("e"))
    return latest.select("stage", "e.status", "e.detail")
