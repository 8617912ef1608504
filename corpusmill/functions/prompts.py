"""Prompt and chat-message columns.

The system texts are fixed values that must equal the reference's,
including its spelling ("basedon", "adivce").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import normalize_quotes

# Fixed values.
QUESTION_SYSTEM = ("Create a question as though you are a user based on the given data. "
                   "The question should be clear, friendly, precise, and concise. "
                   "It should be no longer than a few sentences.")
ANSWER_SYSTEM = ("Create a consultative answer basedon the given data and question. "
                 "The answer should be clear, friendly, precise, and concise. "
                 "It should be no longer than a few sentences.")
CHAT_SYSTEM = ("You give clear, friendly, precise, and concise answers to the user "
               "along with consultative adivce.")
STUB_QUESTION_PREFIX = "What is meant by: "


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def question_messages(context: Column) -> Column:
    """System + user(context)."""
    return F.array(_msg("system", F.lit(QUESTION_SYSTEM)), _msg("user", context))


def answer_messages(question: Column, context: Column) -> Column:
    """System + user(question, one space, context); the raw question."""
    return F.array(_msg("system", F.lit(ANSWER_SYSTEM)),
                   _msg("user", F.concat(question, F.lit(" "), context)))


def chat_messages(question: Column, answer: Column) -> Column:
    """The training example: system, user(question), assistant(answer)."""
    return F.array(_msg("system", F.lit(CHAT_SYSTEM)),
                   _msg("user", normalize_quotes(question)),
                   _msg("assistant", normalize_quotes(answer)))


def stub_question(first: Column) -> Column:
    """Deterministic extractive stand-in for the model's question (from the first sentence)."""
    return F.concat(F.lit(STUB_QUESTION_PREFIX), first)


def stub_answer(first: Column) -> Column:
    """Deterministic extractive stand-in for the model's answer: the first sentence."""
    return first
