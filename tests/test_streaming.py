"""H1, H2: streaming dedupe and incremental preparation across restarts."""

import json
import os

import pytest

from corpusmill.plans import workflows
from corpusmill.sources.slices import SliceStore, commit_in_slices
from corpusmill.streaming import records as S


def _drop(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n\n")


def test_h1_first_record_wins_across_restarts(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, d) for d in ("src", "sink", "ck"))
    _drop(src, "a.json", [{"url": "u1", "text": "first"}, {"url": "u1", "text": "dup"}, {"url": None, "text": "no url"},
                          {"url": "u3", "text": "late", "ord": 9}, {"url": "u3", "text": "early", "ord": 2}])
    S.first_records(spark, src, sink, ck).awaitTermination()

    def kept():
        return sorted((str(r.url), r.text) for r in S.record_store(spark, sink).read("records").collect())

    assert kept() == [("None", "no url"), ("u1", "first"), ("u3", "early")]
    _drop(src, "b.json", [{"url": "u1", "text": "again"}, {"url": "u2", "text": "new"}, {"url": None, "text": "other"},
                          {"url": "u3", "text": "earlier still", "ord": 0}])
    S.first_records(spark, src, sink, ck).awaitTermination()
    assert kept() == [("None", "no url"), ("u1", "first"), ("u2", "new"), ("u3", "early")]


def test_h1_one_file_a_batch_and_a_repeated_batch(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, d) for d in ("src", "sink", "ck"))
    for k in range(3):
        _drop(src, f"{k}.json", [{"url": f"u{i}", "text": f"{k}", "ord": k} for i in range(k, k + 3)])
        os.utime(os.path.join(src, f"{k}.json"), (1_000_000 + k, 1_000_000 + k))
    S.first_records(spark, src, sink, ck, max_files_per_trigger=1).awaitTermination()
    want = {"u0": "0", "u1": "0", "u2": "0", "u3": "1", "u4": "2"}
    store = S.record_store(spark, sink)
    assert {r.url: r.text for r in store.read("records").collect()} == want
    # the last batch was committed, but the stream's own checkpoint didn't get that far
    for name in os.listdir(os.path.join(ck, "commits")):
        if name.lstrip(".").startswith("2"):
            os.remove(os.path.join(ck, "commits", name))
    S.first_records(spark, src, sink, ck, max_files_per_trigger=1).awaitTermination()
    assert {r.url: r.text for r in store.read("records").collect()} == want and store.read("records").count() == 5


def _failing(bad):
    def generate(pdf):
        if any(c.startswith(bad) for c in pdf["context"]):
            raise RuntimeError("model is down")
        return pdf.assign(question="Q " + pdf["context"], answer=None if pdf["context"].iloc[0] == "Null." else "A")

    return generate


def test_h2_failed_calls_stay_pending(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, d) for d in ("src", "sink", "ck"))
    _drop(src, "a.json", [{"url": "u1", "text": "Bad one.", "ord": 1}, {"url": "u2", "text": "Fine.", "ord": 2},
                          {"url": "u3", "text": "Null.", "ord": 3}])
    cfg = workflows.PrepareConfig(generator=_failing("Bad"), on_error="row", slices=2)
    S.generate_stream(spark, src, sink, ck, cfg).awaitTermination()
    store = workflows.example_store(spark, sink)
    assert sorted(r.ord for r in store.read("keys").collect()) == [2, 2]
    assert {(r.ord, r.error) for r in workflows.failed_calls(store).collect()} == {(1, "RuntimeError('model is down')"), (3, "no reply")}
    _drop(src, "b.json", [{"url": "u4", "text": "More.", "ord": 4}, {"url": "u2", "text": "Fine.", "ord": 2}])
    S.generate_stream(spark, src, sink, ck, cfg).awaitTermination()
    healthy = workflows.PrepareConfig(generator=_failing("nothing"), on_error="row", slices=2)
    workflows.retry_failed(store, healthy)
    assert sorted(r.ord for r in store.read("keys").collect()) == [1, 1, 2, 2, 4, 4]
    assert {r.ord for r in workflows.failed_calls(store).collect()} == {3}
    assert store.read("examples").where("ord = 1").first().messages[1].content == "Q Bad one."


def test_h2_examples_once_and_equal_to_batch(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, d) for d in ("src", "sink", "ck"))
    text = " ".join(f"S{i}." for i in range(1, 17))
    _drop(src, "a.json", [{"url": "u1", "text": text, "ord": 1}])
    S.prepare_stream(spark, src, sink, ck).awaitTermination()
    assert spark.read.parquet(sink).count() == 4               # 2 chunks x 2 questions
    _drop(src, "b.json", [{"url": "u2", "text": "A. B.", "ord": 2}])
    S.prepare_stream(spark, src, sink, ck).awaitTermination()
    streamed = spark.read.parquet(sink)
    assert streamed.count() == 6
    batch = S.example_stream(spark.read.schema(S.STREAM_RECORD_DDL).json(src))
    assert sorted(streamed.select("ord", "chunk_no", "question_no").collect()) == \
        sorted(batch.select("ord", "chunk_no", "question_no").collect())


def test_h2_streaming_split_by_hash(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, d) for d in ("src", "sink", "ck"))
    _drop(src, "a.json", [{"url": f"u{i}", "text": "A. B.", "ord": i} for i in range(300)])
    S.prepare_stream(spark, src, sink, ck, split_seed=4).awaitTermination()
    got = {r.split: r["count"] for r in spark.read.parquet(sink).groupBy("split").count().collect()}
    assert set(got) == {"train", "test", "valid"} and sum(got.values()) == 600
    assert 0.7 < got["train"] / 600 < 0.9


def test_e8_crash_between_slices(spark, tmp_dir):
    """A make that fails on its third slice: two slices stay, the rest is done by the next run, nothing twice."""
    made = []

    def make(broken):
        def run(rows):
            made.append(len(made))
            if broken and len(made) == 3:
                raise RuntimeError("crash")
            return {"rows": rows, "again": rows}

        return run

    store = SliceStore(spark, os.path.join(tmp_dir, "store"), {"rows": "k bigint, v string", "again": "k bigint"})
    work = spark.range(500).selectExpr("id as k", "concat('v', id) as v")

    def todo():
        return work.join(store.read("again").select("k"), "k", "left_anti")

    with pytest.raises(RuntimeError):
        commit_in_slices(store, todo, ["k"], 5, make(True))
    assert len(store.entries("commit")) == 2 and 0 < store.read("rows").count() < 500
    # a crash while a slice is written: its folder is there, the log doesn't name it
    store.read("rows").select("k", "v").write.parquet(store.folder("rows", "g000000-2"))
    before = store.read("rows").count()
    assert len(commit_in_slices(store, todo, ["k"], 5, make(False), stop_after=1)) == 1
    assert before < store.read("rows").count() < 500
    commit_in_slices(store, todo, ["k"], 5, make(False))
    assert sorted(r.k for r in store.read("rows").collect()) == list(range(500)) and len(made) == 6
    assert commit_in_slices(store, todo, ["k"], 5, make(False)) == [] and store.read("rows").count() == 500


def test_e8_empty_work(spark, tmp_dir):
    store = SliceStore(spark, os.path.join(tmp_dir, "store"), {"rows": "k bigint"})
    assert commit_in_slices(store, lambda: spark.createDataFrame([], "k bigint"), ["k"], 3, lambda r: {"rows": r}) == []
    assert store.read("rows").collect() == []
