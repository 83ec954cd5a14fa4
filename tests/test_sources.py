import json

import pytest
from pyspark.sql import functions as F

from siftwork.operators import splitting
from siftwork.schemas import MESSAGES
from siftwork.sources import hooks, readers, sinks
from siftwork.streaming.supervisor import log_points


def _manifest(names):
    run = {"userPrompt": "p", "call": {"name": "n", "arguments": {"b": 1, "a": "x"}}, "result": {"ok": True}}
    return {
        "tools": [
            {
                "type": "function",
                "function": {"name": n, "description": "A tool of some use.", "parameters": {"type": "object", "properties": {"a": {"type": "string"}, "b": {"type": "integer"}}, "required": ["a"]}},
                "meta": {"jsBody": "function f(args) { return {} }", "requiresNetwork": False, "trajectories": [run] * 3, "sourceWorker": "w", "sourceChunks": ["c"]},
            }
            for n in names
        ],
        "source": "swarm",
        "count": len(names),
    }


def test_corpus(spark, tmp_path):
    assert readers.read_corpus(spark, str(tmp_path / "none.json")) is None
    path = tmp_path / "corpus.json"
    chunk = {"id": "cli.txt#0000", "source": "cli", "text": "t", "tokenCount": 1, "ordinal": 0}
    path.write_text(json.dumps({"chunks": [chunk, {**chunk, "id": "b"}], "byTopic": {}, "fetchedAt": "2024-01-01T00:00:00Z", "sourceBytes": 9}))
    rows = readers.read_corpus(spark, str(path))
    assert rows.columns == ["id", "source", "text", "token_count", "ordinal"] and rows.count() == 2
    assert readers.corpus_metadata(spark, str(path)).first()["source_chars"] == 9


def test_manifest_round_trip(spark, tmp_path):
    path = tmp_path / "tools.json"
    path.write_text(json.dumps(_manifest(["one", "two"]), indent=2))
    tools = readers.read_tools(spark, str(path))
    params = {(r["tool"], r["param"]): (r["type"], r["required"]) for r in readers.tool_parameters(tools).collect()}
    assert params[("one", "a")] == ("string", True) and params[("two", "b")] == ("integer", False)
    runs = readers.tool_runs(tools).collect()
    assert len(runs) == 6 and runs[0]["arguments"] == '{"a":"x","b":1}'
    failures = spark.createDataFrame([("schema", 2)], "gate string, failures bigint")
    out = str(tmp_path / "manifest")
    sinks.write_manifest(tools, out, "swarm", failures, 9, 5)
    meta = spark.read.json(f"{out}/meta").first()
    assert meta["count"] == 2 and meta["meta"]["rawCandidates"] == 9 and meta["meta"]["gateFailures"]["schema"] == 2
    path.write_text(json.dumps(_manifest(["Bad-Name"])))
    bad = readers.read_tools(spark, str(path))
    assert sinks.broken_tools(bad).first()["broken"] == ["name"]
    with pytest.raises(ValueError):
        sinks.write_manifest(bad, str(tmp_path / "m2"), "swarm", failures, 1, 1)


def test_large_split_reads_back(spark, tmp_path):
    split = splitting.with_split(spark.range(2_000_000), "id")
    sinks.write_split(split, "id", str(tmp_path / "s"))
    assert readers.read_split(spark, str(tmp_path / "s"), "id").count() == 2_000_000


def test_split_round_trip(spark, tmp_path):
    split = splitting.with_split(spark.range(100), "id")
    sinks.write_split(split, "id", str(tmp_path / "s"))
    back = readers.read_split(spark, str(tmp_path / "s"), "id")
    assert sorted(map(tuple, back.select("id", "split").collect())) == sorted(map(tuple, split.select("id", "split").collect()))
    assert readers.read_split(spark, str(tmp_path / "nothing"), "id") is None
    split.filter("id > 50").select("id", "split").write.mode("overwrite").partitionBy("split").parquet(str(tmp_path / "s" / "ids"))
    with pytest.raises(ValueError):
        readers.read_split(spark, str(tmp_path / "s"), "id")


def _examples(spark):
    rows = [
        {"messages": [{"role": "user", "content": "hi", "tool_calls": [], "tool_call_id": "", "name": ""}, {"role": "assistant", "content": "é", "tool_calls": [{"id": "c", "type": "function", "function": {"name": "n", "arguments": "{}"}}]}]}
    ]
    table = spark.createDataFrame([(json.dumps(r),) for r in rows], "v string")
    return table.select(F.from_json("v", f"messages {MESSAGES}").alias("e")).select("e.*")


def test_training_sink_drops_empty_fields(spark, tmp_path):
    path = tmp_path / "tools.json"
    path.write_text(json.dumps(_manifest(["one"])))
    tools = readers.read_tools(spark, str(path)).agg(F.collect_list(F.struct("type", "function", "meta")).alias("tools"))
    sinks.write_training(_examples(spark).crossJoin(tools), str(tmp_path / "out"))
    line = json.loads(spark.read.text(str(tmp_path / "out")).first()[0])
    assert line["messages"][0] == {"role": "user", "content": "hi"}
    assert set(line["messages"][1]) == {"role", "content", "tool_calls"}
    assert list(line["tools"][0]) == ["type", "function"] and line["tools"][0]["function"]["parameters"]["required"] == ["a"]


def test_eval_items_and_limit(spark, tmp_path):
    path = tmp_path / "eval.jsonl"
    lines = [json.dumps({"id": f"eval-factual-{i}", "kind": "factual", "prompt": "p", "expected": "e", "sourceChunks": ["c"]}) for i in range(9)]
    path.write_text("\n\n".join(lines) + "\n  \n")
    assert readers.read_eval_items(spark, str(path)).count() == 9
    assert [r["id"] for r in readers.read_eval_items(spark, str(path), 3).collect()] == [f"eval-factual-{i}" for i in range(3)]
    assert readers.read_eval_items(spark, str(path), 0).count() == 9
    assert readers.read_eval_items(spark, str(path), -2).count() == 9


def test_log_files_keep_line_order(spark, tmp_path):
    for run in ("one", "two"):
        body = [f"Iter {i}: Train loss {i}.5" if i % 3 else "noise" for i in range(500)]
        (tmp_path / f"{run}.log").write_text("\n".join(body))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        points = log_points(readers.read_log_files(spark, str(tmp_path)))
        for run in ("one", "two"):
            iters = [r["iter"] for r in points.filter(F.col("run_id") == run).orderBy("seq").collect()]
            assert iters == [i for i in range(500) if i % 3]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_log_stream(spark, tmp_path):
    for part in range(2):
        (tmp_path / f"p{part}.json").write_text("\n".join(json.dumps({"run_id": "r", "seq": part * 10 + i, "value": f"loss: {i}.0"}) for i in range(3)))
    stream = log_points(readers.read_log_stream(spark, str(tmp_path)))
    started = stream.writeStream.format("memory").queryName("lines_seen").trigger(availableNow=True).start()
    started.awaitTermination()
    assert spark.table("lines_seen").count() == 6


def test_checkpoint_sinks(spark, tmp_path):
    rows = spark.range(60).select(F.col("id").alias("example_id"), F.lit("dba").alias("persona"))
    path = str(tmp_path / "c")
    sinks.append_checkpoint(rows, path, start=True)
    sinks.append_checkpoint(rows, path)
    assert spark.read.json(path).count() == 120
    sinks.append_checkpoint(rows.limit(5), path, start=True)
    assert spark.read.json(path).count() == 5
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    sinks.start_checkpoint_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sinks.read_checkpointed(spark, str(tmp_path / "out"), rows.schema).count() == 60


def test_a_replayed_batch_is_written_once(spark, tmp_path, monkeypatch):
    """A batch is written, the stream dies before it is noted, and a restart writes it again."""
    rows = spark.range(90).selectExpr("id", "'x' as v").repartition(3)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    commit, seen = sinks.commit_batch, []

    def dies(batch, number, path):
        commit(batch, number, path)
        seen.append(number)
        if number == 1:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(sinks, "commit_batch", dies)
    paths = str(tmp_path / "out"), str(tmp_path / "state")
    with pytest.raises(Exception, match="lost after"):
        sinks.start_checkpoint_stream(stream, *paths).awaitTermination()
    monkeypatch.setattr(sinks, "commit_batch", commit)
    sinks.start_checkpoint_stream(stream, *paths).awaitTermination()
    found = sinks.read_checkpointed(spark, paths[0], rows.schema)
    assert seen == [0, 1] and found.columns == ["id", "v"]
    assert sorted(r["id"] for r in found.collect()) == list(range(90))


def test_prompt_answer_sides(spark, tmp_path):
    rows = spark.createDataFrame([("p", "a", "train"), ("q", "b", "valid")], "prompt string, answer string, side string")
    sinks.write_prompt_answers(rows, str(tmp_path / "g"))
    assert spark.read.json(str(tmp_path / "g" / "valid")).first()["prompt"] == "q"


def test_hooks(spark):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "id int, text string")
    sizes = hooks.map_batches(rows.coalesce(1), "text", lambda batch: [len(batch)] * len(batch), "n", "int", batch=4)
    assert sorted(r["n"] for r in sizes.collect()) == [2, 2, 4, 4, 4, 4, 4, 4, 4, 4]
    assert hooks.embed(rows, "text", lambda b: [[1.0, 2.0]] * len(b)).first()["embedding"] == [1.0, 2.0]
    judged = hooks.judge(rows, "text", lambda b: [[5, 5, 4, 4]] * len(b), "primary").first()
    assert judged["scores"] == [5, 5, 4, 4] and judged["judge"] == "primary"
    prompts = spark.createDataFrame([(1, "s", "u")], "index int, system string, user string")
    assert hooks.generate(prompts, lambda b: [x.upper() for x in b]).first()["reply"] == "S\n\nU"
    with pytest.raises(Exception, match="one value per row"):
        hooks.map_batches(rows, "text", lambda b: [], "n", "int").collect()
