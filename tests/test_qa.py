"""E1-E9 goldens (FIXTURES T8-T10) and plug-in generator behaviour."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from helpers import SF_SMALL
from corpusmill.functions import prompts as P
from corpusmill.operators import qa
from corpusmill.plans import catalog


def _chunks(spark, rows):
    return spark.createDataFrame(rows, "ord long, chunk_no long, url string, data string")


def test_lookback_t8_global(spark):
    ch = _chunks(spark, [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "v", "c"), (3, 0, "w", "d")])
    got = qa.lookback_context(ch, 2).orderBy("ord", "chunk_no").collect()
    assert [r.context for r in got] == ["a", "ab", "abc", "bcd"]
    assert [r.data for r in got] == ["a", "b", "c", "d"]


def test_lookback_within(spark):
    ch = _chunks(spark, [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "v", "c"), (2, 1, "v", "d")])
    got = qa.lookback_context(ch, 1, within="ord").orderBy("ord", "chunk_no").collect()
    assert [r.context for r in got] == ["a", "ab", "c", "cd"]


def test_lookback_zero_is_copy(spark):
    ch = _chunks(spark, [(1, 0, "u", "a")])
    assert qa.lookback_context(ch, 0).first().context == "a"


def test_pending_t9_keyed(spark):
    work = qa.expand_questions(_chunks(spark, [(1, i, "u", str(i)) for i in range(4)]), 2)
    done = work.where("chunk_no < 2").select(*qa.WORK_KEYS)
    left = qa.pending(work, done).select("chunk_no").distinct().orderBy("chunk_no").collect()
    assert [r.chunk_no for r in left] == [2, 3]
    st = qa.resume_status(work, done).first()
    assert (st.n_total, st.n_done, st.n_pending, st.status) == (8, 4, 4, "continue")
    assert qa.resume_status(work, done.limit(0)).first().status == "start"
    assert qa.resume_status(work, work).first().status == "done"


def test_prompts_t10(spark):
    df = spark.createDataFrame([("Q?", "C.")], "q string, c string")
    m = df.select(P.answer_messages(F.col("q"), F.col("c")).alias("m")).first().m
    assert m[0].role == "system" and "basedon" in m[0].content
    assert (m[1].role, m[1].content) == ("user", "Q? C.")
    qm = df.select(P.question_messages(F.col("c")).alias("m")).first().m
    assert [x.role for x in qm] == ["system", "user"] and qm[1].content == "C."


def test_chat_example_e6(spark):
    df = spark.createDataFrame([(1, 0, 0, "it’s?", "“yes”")],
                               "ord long, chunk_no long, question_no long, question string, answer string")
    m = qa.to_examples(df).first().messages
    assert [x.role for x in m] == ["system", "user", "assistant"]
    assert m[0].content.endswith("consultative adivce.")
    assert (m[1].content, m[2].content) == ("it's?", '"yes"')


def test_stub_generator(spark):
    df = spark.createDataFrame([("First one. Second.",)], "context string")
    r = qa.generate_qa(df).first()
    assert (r.question, r.answer) == ("What is meant by: First one.", "First one.")


def test_plugin_generator(spark):
    def gen(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"question": "q:" + pdf["context"], "answer": pdf["context"].str.upper()})

    work = qa.expand_questions(catalog._records(spark, SF_SMALL)
                               .select("ord", F.col("text").alias("context")).limit(20), 2)
    out = qa.generate_qa(work, gen, partitions=3)
    assert out.count() == 40
    r = out.first()
    assert r.question == "q:" + r.context and r.answer == r.context.upper()


def test_expand_questions(spark):
    df = _chunks(spark, [(1, 0, "u", "a")])
    assert [r.question_no for r in qa.expand_questions(df, 3).orderBy("question_no").collect()] == [0, 1, 2]


def test_chat_generator_two_dependent_calls(spark):
    def chat(messages):
        system, user = messages[0]["content"], messages[1]["content"]
        if system == P.QUESTION_SYSTEM:
            return "Q(" + user + ")"
        assert system == P.ANSWER_SYSTEM
        return "A(" + user + ")"

    df = spark.createDataFrame([(1, 0, 0, "ctx.")],
                               "ord long, chunk_no long, question_no long, context string")
    r = qa.generate_qa(df, qa.chat_generator(chat)).first()
    assert (r.question, r.answer) == ("Q(ctx.)", "A(Q(ctx.) ctx.)")


def test_cheap_calls_cost_no_frame_each():
    """A call per row, but one frame per batch: a frame per call made a cheap generator's job some hundred times longer."""
    class Rows:                                                      # hands out what generate_qa would run in the tasks
        schema = StructType([StructField("ord", LongType()), StructField("context", StringType())])

        def mapInPandas(self, run, schema):
            return run

    calls = []

    def generate(part):
        calls.append(len(part))
        if part["context"].iloc[0] == "c3":
            raise ConnectionError("down")
        return {"question": ["Q " + c for c in part["context"]], "answer": [None if c == "c5" else "A" for c in part["context"]]}

    pdf = pd.DataFrame({"ord": range(300), "context": [f"c{i}" for i in range(300)]})
    run = qa.generate_qa(Rows(), generate, on_error="row")
    (out,) = run(iter([pdf]))
    assert calls == [1] * 300 and list(out["ord"]) == list(range(300))
    assert list(out["question"])[2:7] == ["Q c2", None, "Q c4", None, "Q c6"]
    assert list(out["error"])[2:7] == [None, "ConnectionError('down')", None, "no reply", None]
    calls.clear()
    (by_seven,) = qa.generate_qa(Rows(), generate, on_error="row", call_rows=7)(iter([pdf]))
    assert calls == [7] * 42 + [6] and list(by_seven["status"])[:7] == ["ok"] * 5 + ["failed", "ok"]


def test_open_slots_equal_pending_work(spark):
    chunks = _chunks(spark, [(1, 0, "u", "a"), (1, 1, "u", "b"), (1, 1, "u", "b"), (2, 0, None, "c"), (None, 0, "w", "d")])
    done = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 1), (None, 0, 0), (2, 0, 7), (2, 0, None)],
                                 "ord long, chunk_no long, question_no long")

    def rows(df):
        return sorted(map(str, df.select(*qa.WORK_KEYS, "url", "data").collect()))

    for made in (done, done.limit(0)):
        slots = qa.open_slots(chunks, made, 2)
        assert rows(qa.expand_slots(slots)) == rows(qa.pending(qa.expand_questions(chunks, 2), made))
    assert qa.open_slots(chunks, done, 2).count() == 4               # one row per chunk with work left, copies included
