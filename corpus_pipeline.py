"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, mixing, packing.

Each stage takes the documents its predecessor kept, calls one operator of
``corpusmill.llm`` and returns documents (the last one: packed pieces).

Every stage takes any columns besides ``doc_id``, ``text`` and ``source`` and gives them
back (the last one reads only ids and texts); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import linededup, mixing, packing, quality, queries, simhash
from corpusmill.session import cut_lineage, read_table

#: Documents scored below this by the quality classifier go.
KEEP_SCORE = 0.7


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, unchanged.

    Labels are those of ``sf_dir``, held-out ids left out. Null and empty texts have
    one score and stay or go together, as do rows that repeat a text; null ids are
    scored like any other; long texts are scored whole.
    """
    model = queries.quality_model(spark, docs, sf_dir)
    return quality.score(docs, model, name="_score").where(F.col("_score") >= KEEP_SCORE).select(*docs.columns)


def drop_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document or line has, exactly or but for a word.

    Null texts stay null and have no lines; rows that repeat an id, and rows without
    one, are one document each; ``n_chars`` is measured anew where it is there.
    """
    return _measured(linededup.dedup_lines(docs, counts=False))


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, with all its columns: the one of the smallest id.

    Texts without words, null ones too, have one fingerprint and are one group; of rows
    that tie, one stays, the same in every run; null ids come after all others.
    """
    return simhash.keep_one(docs, k=3, distance=2)


def mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as documents: a row per drawn copy, with the columns of its document.

    Null and wordless texts weigh nothing and are never drawn; a null source is the
    last one; rows that repeat id and text count as one document.
    """
    return _measured(mixing.mixed_documents(docs, weights=(5, 2, 1), share=1.5, repeats=2, block_words=1024))


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences (see ``packing.pack``); every row is packed, null texts as their end id."""
    return packing.pack(docs, vocabulary=queries.vocabulary(), capacity=4096, end_id=2)


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources", mix),
    ("packing", pack),
]

#: A trained classifier, seeded draws and differencing are not SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; each stage's result is written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
