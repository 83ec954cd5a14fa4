import math
import random

import pytest
from pyspark.sql import functions as F

from siftwork.operators import telemetry
from siftwork.operators.telemetry import Limits
from siftwork.sources.readers import read_log_parts
from siftwork.streaming.supervisor import (
    FRESH, advance, log_points, part_points, signal_points_stream, stage_stream, supervise_parts, supervise_stream,
)

NAN = float("nan")
SHAPE = "run_id string, seq bigint, iter bigint, loss double, reward double, skipped boolean"


@pytest.mark.parametrize(
    "line, point",
    [
        ("Iter 5: Train loss 1.234", (5, 1.234, None)),
        ("Iter 1: Val loss 0.000, Val total_rewards_mean 0.000, Val total_rewards_std 0.000", (1, None, 0.0)),
        ("Iter 8: Val loss 1.250, Val total_rewards_mean 0.375, Val x 0.1", (8, None, 0.375)),
        ("some unrelated stdout chatter", None),
        ("Iter 10: Train loss 0.5 extra garbage", (10, 0.5, None)),
        ("", None),
        ("loss: 1.5", (-1, 1.5, None)),
        ("Iter 1: Val loss 7.080, Val took 1.954s", (-1, 7.08, None)),
        ("LOSS 2", (-1, 2.0, None)),
    ],
)
def test_lines(spark, line, point):
    row = spark.createDataFrame([(line,)], "value string").select(telemetry.parse_line(F.col("value")).alias("p")).first()["p"]
    assert (tuple(row) if row else None) == point


def test_line_options(spark):
    rows = spark.createDataFrame([("Iter 3: Train loss nan",), ("Iter 1: Val loss 7.0, Val took 1s",), ("loss 1.2.3",)], "value string")

    def parsed(**options):
        return [r["p"] for r in rows.select(telemetry.parse_line(F.col("value"), **options).alias("p")).collect()]

    nan, val, odd = parsed()
    assert nan["iter"] == 3 and math.isnan(nan["loss"]) and val["loss"] == 7.0 and math.isnan(odd["loss"])
    assert parsed(words=False)[0] is None
    assert parsed(val_loss="exclude")[1] is None


def _signals(frame):
    return sorted((r["run_id"], r["seq"], r["kind"], r["reason"], r["next_rollback_index"]) for r in frame.collect())


def _twin(rows, limits=Limits()):
    out, states = [], {}
    for run, seq, iteration, loss, reward, skipped in sorted(rows):
        states[run], signal = advance(states.get(run, FRESH), iteration, loss, reward, skipped, limits)
        if signal:
            out.append((run, seq, *signal))
    return sorted(out)


def _supervise(spark, rows):
    return _signals(telemetry.supervise(spark.createDataFrame(rows, SHAPE)))


def _losses(run, pairs):
    return [(run, i, it, loss, None, False) for i, (it, loss) in enumerate(pairs)]


def test_supervisor_cases(spark):
    rows = _losses("clean", [(i, 2 / i) for i in range(1, 51)])
    rows += _losses("nan", [(1, NAN), (2, NAN)])
    rows += _losses("reset", [(1, NAN), (2, 1.0), (3, NAN)])
    rows += _losses("budget", [(i, NAN) for i in range(6)] + [(7, NAN), (8, NAN)])
    rows += _losses("warm", [(i, 1.0) for i in range(1, 5)] + [(5, 50.0)])
    rows += _losses("spike", [(i, 1.0) for i in range(1, 21)] + [(21, 50.0), (22, 50.0)])
    rows += _losses("tie", [(i, 1.0) for i in range(1, 21)] + [(21, 10.0)])
    rows += [("flat", i, i, None, 0.5, False) for i in range(1, 13)]
    rows += [("lively", i, i, None, r, False) for i, r in enumerate([0.0, 0.3, 0.6, 0.9, 0.2, 0.7, 0.1, 0.8, 0.4, 1.0])]
    rows += [("idle", 0, -1, None, None, False), ("skip", 0, -1, None, None, True), ("skip", 1, 1, NAN, None, False)]
    got = _supervise(spark, rows)
    assert got == _twin(rows)
    assert got == sorted(
        [
            ("nan", 1, "rollback", "nan", 1),
            ("budget", 1, "rollback", "nan", 1),
            ("budget", 3, "rollback", "nan", 2),
            ("budget", 5, "abort", "nan.unrecoverable", None),
            ("spike", 20, "rollback", "spike", 1),
            ("flat", 10, "grpo.collapsed", "variance", None),
            ("skip", 0, "grpo.collapsed", "skipped", None),
        ]
    )


def test_supervisor_matches_twin_on_random_runs(spark):
    rng = random.Random(9)
    rows = []
    for run in range(12):
        for seq in range(150):
            loss = rng.choice([None, NAN, 1.0, 1.0, 1.1, 12.0 if rng.random() < 0.1 else 1.0])
            reward = rng.choice([None, 0.5, 0.55, rng.random()]) if run % 2 else None
            rows.append((f"r{run}", seq, seq, loss, reward, False))
    assert _supervise(spark, rows) == _twin(rows)


def test_supervisor_matches_twin_across_blocks(spark, monkeypatch):
    """Signals lie thousands of points apart, many blocks after the last restart."""
    monkeypatch.setattr(telemetry, "BLOCK", 1100)
    rng = random.Random(10)
    rows = []
    for run in range(4):
        for seq in range(4500):
            loss = rng.uniform(0.5, 1.5)
            if rng.random() < 0.0008:
                loss = 40.0
            if rng.random() < 0.02:
                loss = NAN
            rows.append((f"r{run}", seq, seq, loss, rng.random() if run else None, False))
    got = _supervise(spark, rows)
    assert got == _twin(rows) and len(got) > 6 and max(s[1] for s in got) > 1500


def test_long_run_crosses_blocks_exactly(spark, monkeypatch):
    monkeypatch.setattr(telemetry, "BLOCK", 1500)
    rng = random.Random(4)
    rows = [("long", i, i, rng.uniform(0.5, 1.5), rng.random(), False) for i in range(6000)]
    level, expected = None, []
    for r in rows:
        level = r[3] if level is None else 0.9 * level + 0.1 * r[3]
        expected.append(level)
    placed = telemetry.placed_points(spark.createDataFrame(rows, SHAPE))
    smooth = telemetry.smoothed_losses(placed).orderBy("seq").collect()
    assert [r["after"] for r in smooth] == expected
    variance = telemetry.reward_variance(placed).collect()
    assert len(variance) == 6000 - 9


def test_stream_equals_batch_over_two_restarts(spark, tmp_path):
    rng = random.Random(6)
    rows = [
        (f"r{run}", seq, seq, rng.choice([None, NAN, 1.0, 1.0, 1.2, 30.0]), rng.choice([None, 0.4, 0.9]), False)
        for run in range(6)
        for seq in range(60)
    ]
    for low, high in ((0, 25), (25, 60)):
        part = spark.createDataFrame([r for r in rows if low <= r[1] < high], SHAPE)
        part.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SHAPE).parquet(str(tmp_path / "in"))
        started = (
            supervise_stream(stream)
            .writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
    got = _signals(spark.read.parquet(str(tmp_path / "out")))
    assert got == _twin(rows) == _supervise(spark, rows)


def _log_lines(rng, n):
    kinds = ["Iter {i}: Train loss 1.{i}", "Iter {i}: Train loss 1.0", "Iter {i}: Train loss nan", "Iter {i}: Train loss 40.0", "noise"]
    return [rng.choice(kinds).format(i=i) for i in range(n)]


def test_parts_in_any_order_equal_the_batch(spark, tmp_path):
    """Parts arrive shuffled over restarts, one twice and one empty; a run skips, another keeps its name's dots."""
    rng = random.Random(12)
    runs = {name: [_log_lines(rng, 15) for _ in range(5)] for name in ("a", "b.v1", "c")}
    runs["b.v1"][2] = []
    runs["c"][1][3] = "grpo.skipped reward"
    runs["c"][1][4] = "Iter 9: Train loss 1.0 grpo.skipped"
    rows = []
    for name, parts in runs.items():
        for number, lines in enumerate(parts):
            rows += [(name, (number << 32) + i, line) for i, line in enumerate(lines)]
    points = log_points(spark.createDataFrame(rows, "run_id string, seq bigint, value string"), "grpo")
    expected = _twin([tuple(r) for r in points.orderBy("run_id", "seq").collect()])
    (tmp_path / "in").mkdir()
    for number, batch in enumerate(([4, 1], [3, 0], [2, 1])):
        for name, parts in runs.items():
            for part in batch:
                again = f"more{number}" if number == 2 and part == 1 else ""
                folder = tmp_path / "in" / again
                folder.mkdir(exist_ok=True)
                text = "\r\n".join(parts[part]) if part % 2 else "\n".join([*parts[part], "\n"])
                (folder / f"{name}.{part}.log").write_bytes(text.encode())
        parts = read_log_parts(spark, str(tmp_path / "in"), max_files=4)
        started = (
            supervise_parts(part_points(parts, "grpo"))
            .writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
    assert _signals(spark.read.parquet(str(tmp_path / "out"))) == expected and len(expected) >= 4
    assert any(s[3] == "skipped" for s in expected)


def test_skip_lines_only_in_reward_mode(spark):
    lines = spark.createDataFrame(
        [("r", 0, "grpo.skipped reason=zero"), ("r", 1, "Iter 1: Train loss 1.0"), ("r", 2, "noise")],
        "run_id string, seq bigint, value string",
    )
    assert [r["skipped"] for r in log_points(lines, "grpo").orderBy("seq").collect()] == [True, False]
    assert [r["skipped"] for r in log_points(lines, "sft").collect()] == [False]


def test_checkpoints_and_signal_points(spark):
    listing = spark.createDataFrame(
        [("r", n) for n in ("0000100_adapters.safetensors", "0000900_adapters.safetensors", "adapters.safetensors", "99999999_adapters.safetensors", "0001000_adapters.safetensors")],
        "run_id string, name string",
    )
    assert telemetry.rollback_target(listing) == 1000
    with pytest.raises(FileNotFoundError):
        telemetry.rollback_target(listing.filter("name = 'adapters.safetensors'"))
    signals = spark.createDataFrame(
        [("r", 4, "rollback", "nan", 1), ("r", 9, "abort", "nan.unrecoverable", None)],
        "run_id string, seq bigint, kind string, reason string, next_rollback_index int",
    )
    shown = [("r", 4, 1000, "rollback.nan"), ("r", 9, -1, "nan.unrecoverable")]
    assert sorted(map(tuple, telemetry.signal_points(signals, listing).collect())) == shown
    assert sorted(map(tuple, signal_points_stream(signals, listing).collect())) == shown


def test_progress_and_stages(spark):
    points = spark.createDataFrame(
        [("a", 1, 1, 0.5, None), ("a", 2, 2, None, None), ("b", 1, 7, 0.1, None), ("b", 2, 3, None, "rollback.spike"), ("c", 1, -1, None, "error")],
        "run_id string, seq bigint, iter bigint, loss double, aborted string",
    )
    got = {r["run_id"]: tuple(r)[1:] for r in telemetry.progress(points).collect()}
    assert got == {"a": (2, 0.5, "running", None), "b": (7, 0.1, "rollback", "rollback.spike"), "c": (None, None, "error", "error")}
    events = spark.createDataFrame(
        [("s", 1, "start", None), ("s", 2, "ok", "done"), ("t", 3, "err", "bad")], "stage string, seq bigint, status string, detail string"
    )
    want = [("s", "ok", "done"), ("t", "err", "bad")]
    assert sorted(map(tuple, telemetry.stage_status(events).collect())) == want
    assert sorted(map(tuple, stage_stream(events).collect())) == want


def _sequential(losses, keep, take):
    levels, level = [], None
    for loss in losses:
        level = loss if level is None else keep * level + take * loss
        levels.append(level)
    return levels


@pytest.mark.parametrize("keep", [0.9, 0.999, 0.5])
def test_smoothed_loss_remembers_across_blocks(spark, keep):
    limits = telemetry.Limits(keep=keep, take=1 - keep)
    losses = [100.0] * 7192 + [1.0] * 13000
    losses[7190] = 1e60 if keep == 0.9 else 100.0
    points = spark.createDataFrame([("r", i, i, x, None) for i, x in enumerate(losses)], "run_id string, seq bigint, iter bigint, loss double, reward double")
    rows = telemetry.smoothed_losses(telemetry.placed_points(points), limits).orderBy("seq").collect()
    expected = _sequential(losses, keep, 1 - keep)
    assert [r["after"] for r in rows] == pytest.approx(expected, rel=1e-9)
    assert [r["before"] for r in rows[1:]] == pytest.approx(expected[:-1], rel=1e-9)
    assert rows[0]["before"] is None


def test_smoothed_loss_starts_anew_inside_a_block(spark):
    losses = [float(i % 7 + 1) for i in range(20000)]
    points = spark.createDataFrame([("r", i, i, x, None) for i, x in enumerate(losses)], "run_id string, seq bigint, iter bigint, loss double, reward double")
    later = telemetry.placed_points(points).filter("seq > 5000")
    rows = telemetry.smoothed_losses(later).orderBy("seq").collect()
    assert [r["after"] for r in rows] == pytest.approx(_sequential(losses[5001:], 0.9, 0.1), rel=1e-9)


def test_windows_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(telemetry, "BLOCK", 8)
    limits = telemetry.Limits(window=30, bad_streak=20)
    points = spark.createDataFrame(
        [("r", i, i, float("nan") if 40 <= i < 65 else 1.0, float(i)) for i in range(100)],
        "run_id string, seq bigint, iter bigint, loss double, reward double",
    )
    placed = telemetry.placed_points(points)
    assert telemetry.reward_variance(placed, limits).count() == 71
    assert sorted(r["seq"] for r in telemetry.bad_losses(placed, limits).collect()) == list(range(59, 65))


def test_losses_of_many_short_runs_go_through_in_order_not_run_by_run(spark):
    rows = [(run, seq, seq, float((run or 0) + seq), None, False) for run in (*range(40), None) for seq in range(3)]
    points = spark.createDataFrame(rows, "run_id long, seq long, iter long, loss double, reward double, skipped boolean")
    smooth = telemetry.smoothed_losses(telemetry.placed_points(points))
    assert "FlatMapGroups" not in smooth._jdf.queryExecution().analyzed().toString()
    found = {(r["run_id"], r["seq"]): (r["before"], r["after"]) for r in smooth.collect()}
    for run in range(40):
        second = 0.9 * run + 0.1 * (run + 1)
        assert found[run, 0] == (None, run) and found[run, 1] == (run, second)
        assert found[run, 2] == (second, 0.9 * second + 0.1 * (run + 2))
