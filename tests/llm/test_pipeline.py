"""The pipeline against its operators' brute-force results, and its edges."""

import corpus_pipeline
from siftwork.llm import quality

from .helpers import documents, prose
from .test_dedup import brute_components, brute_repeats


def test_stages_act_on_what_is_left(spark, tmp_path):
    base, shared = prose(1, 200), prose(2, 110)
    secret = "0641917ea4e9feb9cda83477b57ac2654884f485"
    texts = [
        base, base + " end", "tick " * 300, "too short", None, "",
        prose(3, 90) + " " + shared + " " + prose(4, 90), prose(5, 90) + " " + shared + " " + prose(6, 90),
        prose(7, 90) + f' token = "{secret}" ' + prose(8, 90),
    ] + [prose(20 + i, 120) + f" password=12ab{i:04d}34cd56ef and card {10**15 + i}" for i in range(20)]
    docs = documents(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, 0, "user", "some words")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    kept = [i for i, t in enumerate(texts) if not (lambda b: b[0] < 50 or 100 * b[4] > 50 * b[0])(quality.measure((t or "").encode())[0])]
    functions = [f for _, f in corpus_pipeline.STAGES]
    after = functions[0](spark, docs, str(tmp_path))
    assert after.columns == docs.columns
    assert sorted(r["doc_id"] for r in after.collect()) == kept
    after = functions[1](spark, after, str(tmp_path))
    firsts = [kept[i] for i, _, c, _ in brute_components([texts[i] for i in kept]) if i == c]
    assert sorted(r["doc_id"] for r in after.collect()) == firsts
    after = functions[2](spark, after, str(tmp_path))
    found = {r["doc_id"]: r["text"] for r in after.collect()}
    removed = brute_repeats([texts[i] for i in firsts], corpus_pipeline.REPEATED)
    assert {i: len(t.encode()) for i, t in found.items()} == {firsts[k]: n - gone for k, n, gone, _, _ in removed}
    assert sum(gone for _, _, gone, _, _ in removed) > 0
    after = functions[3](spark, after, str(tmp_path))
    masked = {r["doc_id"]: r for r in after.collect()}
    assert secret not in masked[8]["text"] and all(r["n_chars"] == len(r["text"]) for r in masked.values())
    last = functions[4](spark, after, str(tmp_path))
    assert {r["doc_id"] for r in last.collect()} == set(firsts)


def test_run_on_an_empty_table(spark, tmp_path):
    documents(spark, []).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
