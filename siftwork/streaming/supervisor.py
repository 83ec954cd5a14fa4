"""The supervisor as a stateful stream: one small state per run.

The state of a run is a handful of numbers, whatever its length, kept by the
RocksDB state store. Input comes in one of two forms:

* text logs in numbered parts (:func:`supervise_parts`): parts may arrive in any
  order and more than once. A part that is early waits in the run's state until
  the parts before it are there; a part that was applied is passed over. One part at
  a time is in memory.
* single points with a ``seq`` (:func:`supervise_stream`): those of a run are sorted within
  each micro-batch, and a late one fails the stream.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from siftwork.operators.telemetry import SKIP_MARKER, Limits, latest_checkpoint, parse_line

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_STATE = T.StructType(
    [
        T.StructField("bad", T.IntegerType()),
        T.StructField("level", T.DoubleType()),
        T.StructField("rollbacks", T.IntegerType()),
        T.StructField("rewards", T.ArrayType(T.DoubleType())),
        T.StructField("ended", T.BooleanType()),
    ]
)
_SIGNAL = "run_id string, seq bigint, kind string, reason string, next_rollback_index int"
FRESH = (0, None, 0, [], False)


def advance(
    state: tuple, iteration: int, loss: float | None, reward: float | None, skipped: bool, limits: Limits
) -> tuple[tuple, tuple | None]:
    """One point: the next state and a signal ``(kind, reason, index)`` or None."""
    bad, level, rollbacks, rewards, ended = state
    if ended:
        return state, None
    if skipped:
        return (bad, level, rollbacks, rewards, True), ("grpo.collapsed", "skipped", None)
    if reward is not None and math.isfinite(reward):
        rewards = [*rewards, reward][-limits.window :]
        if len(rewards) == limits.window:
            mean = sum(rewards) / limits.window
            spread = sum((r - mean) ** 2 for r in rewards) / limits.window
            if spread < limits.variance_floor:
                return (bad, level, rollbacks, rewards, True), ("grpo.collapsed", "variance", None)
    reason = None
    if loss is not None:
        if not math.isfinite(loss):
            bad += 1
            reason = "nan" if bad >= limits.bad_streak else None
        else:
            bad = 0
            if level is not None and iteration > limits.warmup_iters and loss > level * limits.spike_factor:
                reason = "spike"
            else:
                level = loss if level is None else limits.keep * level + limits.take * loss
    if reason is None:
        return (bad, level, rollbacks, rewards, False), None
    if rollbacks >= limits.max_rollbacks:
        return (bad, level, rollbacks, rewards, True), ("abort", f"{reason}.unrecoverable", None)
    return (0, None, rollbacks + 1, [], False), ("rollback", reason, rollbacks + 1)


def _none_if_missing(value) -> float | None:
    return None if value is None or value is pd.NA else float(value)


class Supervisor(StatefulProcessor):
    """Applies :func:`advance` to the points of each run in ``seq`` order.

    A point that arrives after a later one was applied fails the stream: bound
    the files per trigger, but deliver a run's parts in order.
    """

    def __init__(self, limits: Limits = Limits()):
        self.limits = limits

    def init(self, handle) -> None:
        self.store = handle.getValueState("run", _STATE)
        self.order = handle.getValueState("order", "last BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.store.get() if self.store.exists() else FRESH
        state = (state[0], state[1], state[2], list(state[3] or []), state[4])
        found = []
        batch = pd.concat(list(rows)).sort_values("seq")
        last = self.order.get()[0] if self.order.exists() else None
        if last is not None and int(batch["seq"].iloc[0]) <= last:
            raise ValueError(f"run {key[0]}: seq {batch['seq'].iloc[0]} comes after {last} was applied")
        self.order.update((int(batch["seq"].iloc[-1]),))
        columns = zip(
            batch["seq"], batch["iter"], batch["loss"], batch["has_loss"],
            batch["reward"], batch["has_reward"], batch["skipped"],
        )
        for seq, iteration, loss, has_loss, reward, has_reward, skipped in columns:
            state, signal = advance(
                state,
                int(iteration),
                float(loss) if has_loss else None,
                float(reward) if has_reward else None,
                bool(skipped),
                self.limits,
            )
            if signal:
                found.append((key[0], int(seq), *signal))
        self.store.update(state)
        if found:
            names = ["run_id", "seq", "kind", "reason", "next_rollback_index"]
            frame = pd.DataFrame(found, columns=names)
            frame["next_rollback_index"] = frame["next_rollback_index"].astype("Int32")
            yield frame

    def close(self) -> None:
        pass


PART_SHIFT = 32  # a point's seq is its part's number above this bit, and its line below
_ARRAYS = {"line": "bigint", "iter": "bigint", "loss": "double", "has_loss": "boolean", "reward": "double", "has_reward": "boolean", "skipped": "boolean"}
_PART = ", ".join(f"{name} array<{kind}>" for name, kind in _ARRAYS.items())


class PartSupervisor(StatefulProcessor):
    """Applies :func:`advance` to the parts of each run in the order of their numbers."""

    def __init__(self, limits: Limits = Limits()):
        self.limits = limits

    def init(self, handle) -> None:
        self.store = handle.getValueState("run", _STATE)
        self.order = handle.getValueState("order", "next BIGINT")
        self.early = handle.getMapState("early", "part BIGINT", _PART)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.store.get() if self.store.exists() else FRESH
        state = (state[0], state[1], state[2], list(state[3] or []), state[4])
        due = self.order.get()[0] if self.order.exists() else 0
        found: list[tuple] = []
        for frame in rows:
            for part, *columns in zip(frame["part"], *(frame[name] for name in _ARRAYS)):
                if part < due:
                    continue
                if part > due:
                    self.early.updateValue((int(part),), tuple([x.item() if hasattr(x, "item") else x for x in c] for c in columns))
                    continue
                state = self._apply(key[0], due, columns, state, found)
                due += 1
                while self.early.containsKey((due,)):
                    state = self._apply(key[0], due, self.early.getValue((due,)), state, found)
                    self.early.removeKey((due,))
                    due += 1
        self.order.update((due,))
        self.store.update(state)
        if found:
            frame = pd.DataFrame(found, columns=["run_id", "seq", "kind", "reason", "next_rollback_index"])
            frame["next_rollback_index"] = frame["next_rollback_index"].astype("Int32")
            yield frame

    def _apply(self, run: str, part: int, columns, state: tuple, found: list[tuple]) -> tuple:
        for line, iteration, loss, has_loss, reward, has_reward, skipped in zip(*columns):
            state, signal = advance(
                state, int(iteration), float(loss) if has_loss else None, float(reward) if has_reward else None, bool(skipped), self.limits
            )
            if signal:
                found.append((run, (part << PART_SHIFT) + int(line), *signal))
        return state

    def close(self) -> None:
        pass


def part_points(parts: DataFrame, mode: str = "sft", **options) -> DataFrame:
    """Parts ``(run_id, part, lines)`` to the points of their lines, as arrays side by side.

    Skip-marker lines count in mode ``grpo`` only, and where the line does not parse.
    """

    def point(line, number):
        skipped = line.startswith(SKIP_MARKER) if mode == "grpo" else F.lit(False)
        parsed = parse_line(line, **options)
        return F.struct(number.cast("bigint").alias("line"), parsed.alias("p"), (skipped & parsed.isNull()).alias("skipped"))

    found = F.filter(F.transform("lines", point), lambda x: x["p"].isNotNull() | x["skipped"])
    values = {
        "line": lambda x: x["line"],
        "iter": lambda x: F.coalesce(x["p"]["iter"], F.lit(-1)),
        "loss": lambda x: F.coalesce(x["p"]["loss"], F.lit(0.0)),
        "has_loss": lambda x: x["p"]["loss"].isNotNull(),
        "reward": lambda x: F.coalesce(x["p"]["reward"], F.lit(0.0)),
        "has_reward": lambda x: x["p"]["reward"].isNotNull(),
        "skipped": lambda x: x["skipped"],
    }
    staged = parts.select("run_id", "part", found.alias("found"))
    return staged.select(
        "run_id", "part", *[F.transform("found", get).cast(f"array<{_ARRAYS[name]}>").alias(name) for name, get in values.items()]
    )


def supervise_parts(parts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Signals of a stream of :func:`part_points`; ``seq`` is the part's number and the line in it."""
    parts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return parts.groupBy("run_id").transformWithStateInPandas(
        PartSupervisor(limits), outputStructType=_SIGNAL, outputMode="Append", timeMode="None"
    )


def log_points(lines: DataFrame, mode: str = "sft", **options) -> DataFrame:
    """``(run_id, seq, iter, loss, reward, skipped)`` of log lines, streaming or batch.

    Skip-marker lines count in mode ``grpo`` only.
    """
    skipped = F.col("value").startswith(SKIP_MARKER) if mode == "grpo" else F.lit(False)
    parsed = lines.select("run_id", "seq", parse_line(F.col("value"), **options).alias("p"), skipped.alias("_skip"))
    return parsed.filter("p is not null or _skip").select(
        "run_id", "seq", "p.iter", "p.loss", "p.reward", (F.col("_skip") & F.col("p").isNull()).alias("skipped")
    )


def supervise_stream(points: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Signals of a stream of points; needs the RocksDB state store of the session."""
    points.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    shaped = points.select(
        "run_id",
        "seq",
        F.coalesce("iter", F.lit(-1)).alias("iter"),
        F.coalesce("loss", F.lit(0.0)).alias("loss"),
        F.col("loss").isNotNull().alias("has_loss"),
        F.coalesce("reward", F.lit(0.0)).alias("reward"),
        F.col("reward").isNotNull().alias("has_reward"),
        "skipped",
    )
    return shaped.groupBy("run_id").transformWithStateInPandas(
        Supervisor(limits), outputStructType=_SIGNAL, outputMode="Append", timeMode="None"
    )


def signal_points_stream(signals: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Points to show for streamed signals, against a static checkpoint listing."""
    latest = latest_checkpoint(checkpoints, "run_id").select("run_id", F.col("iter").alias("_back"))
    rolled = F.col("kind") == "rollback"
    reason = F.when(rolled, F.concat(F.lit("rollback."), "reason")).otherwise(F.col("reason"))
    return signals.join(latest, "run_id", "left").select(
        "run_id",
        "seq",
        F.when(rolled, F.col("_back")).otherwise(F.lit(-1)).cast("bigint").alias("iter"),
        reason.alias("aborted"),
    )


def stage_stream(events: DataFrame) -> DataFrame:
    """Latest status per stage; run it in update mode."""
    latest = events.groupBy("stage").agg(F.max_by(F.struct("status", "detail"), "seq").alias("e"))
    return latest.select("stage", "e.status", "e.detail")
