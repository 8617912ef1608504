"""Context, question expansion, generation and resume.

Work is keyed by ``(ord, chunk_no, question_no)``; resume is an anti-join on
those keys, never on line counts or positions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.functions import prompts as P
from corpusmill.functions.text import first_sentence
from corpusmill.operators.rowindex import with_row_index

WORK_KEYS = ("ord", "chunk_no", "question_no")


#: Consecutive chunks that one look-back task holds.
BLOCK_ROWS = 65536


def lookback_context(chunks: DataFrame, k: int = 0, within: str | None = None,
                     order: Sequence[str] = ("ord", "chunk_no"), data: str = "data",
                     name: str = "context", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Previous ``k`` chunks + the current one, joined without separator.

    ``within=None`` runs over the whole ordered chunk list (documents are
    crossed, as in the reference); ``within=<col>`` restarts per value of that
    column, ordered by the last ``order`` column. Positions may have gaps: the
    chunks before are those that come before in the order.

    The order is cut into blocks of ``block_rows`` chunks whatever documents they
    belong to, so no key makes a large one; the last ``k`` chunks of a block are
    also sent to the next (a halo), the others only to their own.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    if k == 0:
        return chunks.withColumn(name, F.col(data))
    by = list(order) if within is None else [within, order[-1]]
    placed = with_row_index(chunks, by, "_lb_i")
    own = F.floor(F.col("_lb_i") / block_rows)
    halo = F.explode(F.sequence(own, F.floor((F.col("_lb_i") + k) / block_rows)))
    frame = Window.partitionBy("_lb_b").orderBy("_lb_i").rowsBetween(-k, 0)
    group = F.col(within) if within is not None else F.lit(0)
    read = placed.withColumn("_lb_b", halo).withColumn("_lb_g", group).withColumn(
        "_lb_f", F.collect_list(F.struct(F.col("_lb_g").alias("g"), F.col(data).alias("d"))).over(frame))
    same = F.filter("_lb_f", lambda x: x["g"].eqNullSafe(F.col("_lb_g")))
    return read.where(F.col("_lb_b") == own).select(
        *chunks.columns, F.array_join(F.transform(same, lambda x: x["d"]), "").alias(name))


def expand_questions(df: DataFrame, n: int = 2) -> DataFrame:
    """``n`` independent question slots per chunk: adds ``question_no``."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return df.withColumn("question_no",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))


def open_slots(chunks: DataFrame, done: DataFrame, n: int = 2) -> DataFrame:
    """E2 + E7 a chunk at a time: adds ``questions``, the slots 0 to ``n - 1`` whose key is not done.

    Chunks without an open slot vanish. A context is carried once for all slots of its
    chunk until ``expand_slots`` makes the work items.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    made = done.groupBy(*WORK_KEYS[:2]).agg(F.collect_set(WORK_KEYS[2]).alias("_made"))
    slots = F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    left = F.filter(slots, lambda q: ~F.coalesce(F.array_contains("_made", q), F.lit(False)))
    rows = chunks.join(made, list(WORK_KEYS[:2]), "left").withColumn("questions", left)
    return rows.where(F.size("questions") > 0).drop("_made")


def expand_slots(df: DataFrame) -> DataFrame:
    """One work item per open slot: ``question_no`` from ``questions``."""
    return df.withColumn("question_no", F.explode("questions")).drop("questions")


def generate_qa(df: DataFrame, generator: Callable[[pd.DataFrame], pd.DataFrame | dict[str, list]] | None = None,
                context: str = "context", partitions: int | None = None, on_error: str = "raise",
                call_rows: int = 1) -> DataFrame:
    """E5: add ``question`` and ``answer``.

    Without a generator, the deterministic extractive stub runs as column
    expressions. A generator receives pandas batches (all input columns) and
    returns ``question, answer`` per row in order, as a frame or as a dict of lists
    (a frame costs a call about a millisecond); it runs in
    ``mapInPandas`` over ``partitions`` tasks. Calls may repeat on task retry,
    so outputs stay keyed by the work keys.

    ``on_error="raise"``: a call that raises fails the job. ``on_error="row"``: the
    generator gets ``call_rows`` rows a call, and rows of a call that raised, or that
    came back without question or answer, carry ``status="failed"`` and the reason in
    ``error`` (others ``status="ok"``), with question and answer null.
    """
    if on_error not in ("raise", "row"):
        raise ValueError("on_error must be 'raise' or 'row'")
    if generator is None:
        first = df.withColumn("_qa_s1", first_sentence(F.col(context)))
        out = (first.withColumn("question", P.stub_question(F.col("_qa_s1")))
               .withColumn("answer", P.stub_answer(F.col("_qa_s1"))).drop("_qa_s1"))
        if on_error == "row":
            out = out.withColumn("status", F.lit("ok")).withColumn("error", F.lit(None).cast("string"))
        return out
    src = df.repartition(partitions) if partitions else df
    added = ["question", "answer"] + (["status", "error"] if on_error == "row" else [])
    schema = StructType(df.schema.fields + [StructField(c, StringType()) for c in added])

    def run(batches):
        for pdf in batches:
            if on_error == "raise":
                out = generator(pdf)
                yield pdf.assign(question=list(out["question"]), answer=list(out["answer"]))
            else:
                # one frame a batch: a frame per call costs far more than a cheap call
                out = {c: [] for c in added}
                for at in range(0, len(pdf), call_rows):
                    for c, values in _call(generator, pdf.iloc[at:at + call_rows]).items():
                        out[c] += values
                yield pdf.assign(**out)

    return src.mapInPandas(run, schema)


def _call(generator: Callable[[pd.DataFrame], pd.DataFrame | dict[str, list]], part: pd.DataFrame) -> dict[str, list]:
    """One call's columns; an exception or a missing reply becomes a failed row."""
    n = len(part)
    try:
        out = generator(part)
        question, answer = list(out["question"]), list(out["answer"])
        if len(question) != n or len(answer) != n:
            raise ValueError(f"{len(question)} questions and {len(answer)} answers for {n} rows")
    except Exception as e:  # the caller's function: whatever it raises is that call's failure
        return {"question": [None] * n, "answer": [None] * n, "status": ["failed"] * n, "error": [repr(e)] * n}
    ok = [isinstance(q, str) and isinstance(a, str) for q, a in zip(question, answer)]
    return {"question": [q if o else None for q, o in zip(question, ok)], "answer": [a if o else None for a, o in zip(answer, ok)],
            "status": ["ok" if o else "failed" for o in ok], "error": [None if o else "no reply" for o in ok]}


def chat_generator(chat: Callable[[list[dict]], str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """E5 with a chat model: per row, question = chat(E3 prompt), then
    answer = chat(E4 prompt built from the raw question and the context).

    ``chat`` takes a list of ``{"role", "content"}`` messages and returns the
    reply text; it is the caller's client (retries and timeouts are its own).
    """
    def generate(pdf: pd.DataFrame) -> pd.DataFrame:
        questions, answers = [], []
        for ctx in pdf["context"]:
            q = chat([{"role": "system", "content": P.QUESTION_SYSTEM},
                      {"role": "user", "content": ctx}])
            a = chat([{"role": "system", "content": P.ANSWER_SYSTEM},
                      {"role": "user", "content": f"{q} {ctx}"}])
            questions.append(q)
            answers.append(a)
        return pd.DataFrame({"question": questions, "answer": answers})

    return generate


def to_examples(qa: DataFrame) -> DataFrame:
    """Keys + ``messages`` in chat format."""
    keys = [c for c in WORK_KEYS if c in qa.columns]
    return qa.select(*keys, P.chat_messages(F.col("question"), F.col("answer")).alias("messages"))


def pending(work: DataFrame, done: DataFrame, keys: Sequence[str] = WORK_KEYS) -> DataFrame:
    """Work items whose key is not done yet."""
    return work.join(done.select(*keys), list(keys), "left_anti")


def resume_status(work: DataFrame, done: DataFrame, keys: Sequence[str] = WORK_KEYS) -> DataFrame:
    """One row ``n_total, n_done, n_pending, status`` (start/continue/done)."""
    flagged = work.select(*keys).join(done.select(*keys).distinct().withColumn("_d", F.lit(True)),
                                      list(keys), "left")
    counts = flagged.agg(F.count(F.lit(1)).alias("n_total"),
                         F.count_if(F.col("_d").isNotNull()).alias("n_done"))
    return counts.select(
        "n_total", "n_done", (F.col("n_total") - F.col("n_done")).alias("n_pending"),
        F.when(F.col("n_done") == 0, "start")
         .when(F.col("n_total") > F.col("n_done"), "continue")
         .otherwise("done").alias("status"))
