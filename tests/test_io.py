"""A1-A7 round trips and the G-level workflows on files in a scratch folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from corpusmill.session import session_conf
from corpusmill.plans import catalog, workflows
from corpusmill.sources import export, records as R


def test_records_round_trip_t12(spark, tmp_dir):
    path = os.path.join(tmp_dir, "recs")
    df = spark.createDataFrame([("u1", "a\n\nb é"), ("u2", "c")], "url string, text string")
    R.write_records(df, path, mode="overwrite")
    raw = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path))
                  if f.startswith("part-"))
    pieces = [p for p in raw.split("\n\n") if p.strip()]
    assert sorted(json.loads(p)["url"] for p in pieces) == ["u1", "u2"]   # blank-line format
    back = {r.url: r.text for r in R.read_records(spark, path).collect()}
    assert back == {"u1": "a\n\nb é", "u2": "c"}
    R.write_records(df.limit(1), path, mode="append")
    assert R.read_records(spark, path).count() == 3
    R.write_records(df.limit(1), path, mode="overwrite")                   # A3 explicit reset
    assert R.read_records(spark, path).count() == 1


def test_examples_and_splits_io(spark, tmp_dir):
    recs = catalog._records(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "data")
    res = workflows.prepare(recs, workflows.PrepareConfig(seed=5), out_dir=out)
    n = res.count()
    parts = {s: R.read_examples(spark, os.path.join(out, f"split={s}")).count()
             for s in ("train", "test", "valid")}
    assert sum(parts.values()) == n
    hold = -(-n // 5)
    assert parts["valid"] == -(-hold // 3) and parts["test"] == hold - parts["valid"]
    ex = R.read_examples(spark, os.path.join(out, "split=train")).first()
    assert [m.role for m in ex.messages] == ["system", "user", "assistant"]


def test_prepare_resume_by_key(spark, tmp_dir):
    recs = catalog._records(spark, SF_SMALL)
    cfg = workflows.PrepareConfig(seed=1)
    ex_path = os.path.join(tmp_dir, "examples")
    first_half = recs.where(F.col("ord") % 2 == 0)
    workflows.prepare(first_half, cfg, examples_path=ex_path)
    once = workflows.example_store(spark, ex_path).read("examples").count()
    full = workflows.prepare(recs, cfg, examples_path=ex_path)         # resumes
    keys = full.select("ord", "chunk_no", "question_no")
    assert keys.count() == keys.distinct().count() > once
    again = workflows.prepare(recs, cfg, examples_path=ex_path)        # nothing left to do
    assert again.count() == full.count()
    one_run = workflows.prepare(recs, cfg)
    assert sorted(one_run.select("ord", "chunk_no", "question_no").collect()) == sorted(keys.collect())


def test_export_last_wins_t5(spark, tmp_dir):
    df = spark.createDataFrame([(1, "https://a.b/x", "old"), (2, "http://a.b/x", "new"),
                                (3, "https://a.b/y", "y")], "ord long, url string, text string")
    tbl = {r.file_key: r.text for r in export.export_table(df).collect()}
    assert tbl == {"a.b_x": "new", "a.b_y": "y"}
    out = os.path.join(tmp_dir, "files")
    export.export_documents(df, out)
    assert {f: open(os.path.join(out, f)).read() for f in os.listdir(out)} == {"a.b_x.txt": "new", "a.b_y.txt": "y"}
    export.export_documents(df.where("ord = 1"), out)                # replaces the folder
    assert os.listdir(out) == ["a.b_x.txt"] and os.listdir(tmp_dir) == ["files"]


def test_export_failed_job_leaves_nothing(spark, tmp_dir):
    out = os.path.join(tmp_dir, "files")
    df = spark.createDataFrame([(i, f"https://a.b/{i}", "t") for i in range(20)], "ord long, url string, text string")
    export.export_documents(df, out)
    bad = df.withColumn("text", F.when(F.col("ord") == 13, F.raise_error(F.lit("broken"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken"):
        export.export_documents(bad, out)
    assert len(os.listdir(out)) == 20 and os.listdir(tmp_dir) == ["files"]
    with pytest.raises(Exception, match="overwrite"):
        export.export_table(df).write.format("document_files").mode("append").save(out)
    empty = os.path.join(tmp_dir, "empty")
    export.export_documents(df.where("false"), empty)
    assert os.listdir(empty) == []


def test_records_in_order_across_splits(spark, tmp_dir):
    """Two files, read in splits of a few hundred bytes: numbers follow the files, last record wins."""
    path = os.path.join(tmp_dir, "recs")
    os.makedirs(path)
    rows = [{"url": f"https://a.b/{i % 7}", "text": f"text {i} " + "x" * (i % 50)} for i in range(400)]
    for name, part in (("b.json", rows[250:]), ("a.json", rows[:250])):
        with open(os.path.join(path, name), "w") as f:
            f.write("\n\n".join(json.dumps(r) for r in part))
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "100"}):
        small = {r.ord: (r.url, r.text) for r in R.read_records_in_order(spark, path).collect()}
        out = os.path.join(tmp_dir, "files")
        workflows.export_documents(spark, path, out)
    assert small == {i: (r["url"], r["text"]) for i, r in enumerate(rows)}
    assert {r.ord: (r.url, r.text) for r in R.read_records_in_order(spark, path).collect()} == small
    want = {r["url"].replace("https://", "").replace("/", "_") + ".txt": r["text"] for r in rows}
    assert {f: open(os.path.join(out, f)).read() for f in os.listdir(out)} == want


def test_run_switches(spark, tmp_dir):
    recs_path = os.path.join(tmp_dir, "recs")
    R.write_records(catalog._records(spark, SF_SMALL).select("url", "text"), recs_path, "overwrite")
    cfg = workflows.RunConfig(records_path=recs_path, out_dir=os.path.join(tmp_dir, "out"),
                              train=False)
    assert workflows.run(spark, cfg) is None
    cfg.train = True
    assert workflows.run(spark, cfg).count() > 0


def test_metrics_g5(spark):
    recs = catalog._records(spark, SF_SMALL)
    df, obs = workflows.with_metrics(recs, "docs", empty=F.length("text") == 0)
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == recs.count() and obs.get["empty"] >= 0


def test_write_examples_batches_e8(spark, tmp_dir):
    recs = catalog._records(spark, SF_SMALL)
    ex = workflows.generate_examples(workflows.chunk_work(recs, workflows.PrepareConfig()),
                                     workflows.PrepareConfig())
    path = os.path.join(tmp_dir, "ex")
    R.write_examples(ex.coalesce(1), path, mode="overwrite", max_records_per_file=5)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == -(-ex.count() // 5)
    lines = [json.loads(x) for f in files for x in open(os.path.join(path, f)) if x.strip()]
    assert all(set(d) == {"messages"} for d in lines)


def test_shuffle_order_f3(spark):
    from corpusmill.operators import splits
    df = spark.range(50).withColumnRenamed("id", "k")
    a = [r.k for r in splits.shuffle_order(df, "k", seed=2).collect()]
    b = [r.k for r in splits.shuffle_order(df.repartition(3), "k", seed=2).collect()]
    assert a == b and sorted(a) == list(range(50)) and a != list(range(50))


def test_export_documents_g4(spark, tmp_dir):
    recs_path = os.path.join(tmp_dir, "recs")
    df = spark.createDataFrame([("https://a.b/x", "one"), ("https://a.b/y", "two")],
                               "url string, text string")
    R.write_records(df, recs_path, "overwrite")
    out = os.path.join(tmp_dir, "files")
    workflows.export_documents(spark, recs_path, out)
    assert sorted(os.listdir(out)) == ["a.b_x.txt", "a.b_y.txt"]


def test_read_records_bad_json_fails_a1(spark, tmp_dir):
    import pytest
    path = os.path.join(tmp_dir, "bad")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write('{"url": "u", "text": "t"}\n\n{"url": broken\n\n')
    with pytest.raises(Exception):
        R.read_records(spark, path).collect()


def test_records_with_order_is_partition_independent(spark):
    df = spark.createDataFrame([(f"u{i % 7}", f"t{i}") for i in range(40)], "url string, text string")
    a = sorted((r.url, r.text, r.ord) for r in workflows.records_with_order(df).collect())
    b = sorted((r.url, r.text, r.ord) for r in workflows.records_with_order(df.repartition(5)).collect())
    assert a == b and sorted(r[2] for r in a) == list(range(40))


def test_session_conf_restores(spark):
    import pytest
    from corpusmill.session import session_conf
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError):
        with session_conf(spark, {"spark.sql.shuffle.partitions": "3"}):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            raise RuntimeError("boom")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_work_is_staged_once_per_chunk(spark, tmp_dir):
    """However many questions a chunk gets, its context is shuffled and written once; only failed calls keep it."""
    recs = spark.createDataFrame([(1, "u", "A. B."), (2, "v", " ".join(f"S{i}." for i in range(1, 17)))], "ord long, url string, text string")
    cfg = workflows.PrepareConfig(questions=5, slices=2)
    store = workflows.example_store(spark, f"{tmp_dir}/store")
    workflows.generate_in_slices(recs, store, cfg)
    staged = spark.read.parquet(f"{tmp_dir}/store/work/g000000")
    assert staged.count() == 3 and store.read("keys").distinct().count() == 15
    # a run with more questions makes just the open slots, also of work that an ended run left staged
    more = workflows.PrepareConfig(questions=6, slices=2)
    workflows.generate_in_slices(recs, store, more, stop_after=0)
    workflows.retry_failed(store, more)
    assert sorted(r.question_no for r in store.read("keys").collect()) == sorted([*range(6)] * 3)

    def refuse(pdf):
        raise RuntimeError("down")

    work = workflows.chunk_work(recs, cfg)
    parts = workflows.example_parts(work, workflows.PrepareConfig(generator=refuse, on_error="row"))
    assert {r.context for r in parts["failed"].collect()} == {r.context for r in work.collect()}
    made = workflows.example_parts(work, workflows.PrepareConfig(on_error="row"))["keys"]
    assert made.count() == 15 and made.where("context IS NOT NULL").count() == 0


def test_numbered_records_stay_where_they_are_read(spark, tmp_dir):
    """A split's first number reaches its records without an exchange of the records."""
    R.write_records(spark.range(60).selectExpr("concat('u', id) AS url", "'t' AS text").repartition(3), tmp_dir + "/r")
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):     # as where the records are many
        out = R.read_records_in_order(spark, tmp_dir + "/r")
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(_file" not in plan
    assert sorted(r.ord for r in out.collect()) == list(range(60))
