"""Tables that grow slice by slice and survive a crash between any two steps.

A *slice* is a named set of rows that is written once: each of its parts (say examples,
keys and failed calls) goes to a folder of its own, then one row of the commit log names
the slice. Readers see only slices the log names, so what a crash leaves half written
is invisible, and the next attempt at the same slice overwrites it. Naming a slice twice
in the log changes nothing. Everything goes through Spark's readers and writers, so a
store may lie in any shared folder.

``commit_in_slices`` stages the pending work once, cut into slices by key, and
commits one slice after the other; a run that ended early goes on with the first
staged slice that the log doesn't name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

LOG_DDL = "kind string, name string, n bigint"
COMMIT, STAGE = "commit", "stage"


def read_if_there(spark: SparkSession, path: str | Sequence[str], ddl: str, fmt: str = "parquet",
                  base: str | None = None) -> DataFrame:
    """The table at ``path``, or an empty one where nothing was written yet."""
    paths = [path] if isinstance(path, str) else list(path)
    if paths:
        reader = spark.read.schema(ddl).format(fmt)
        try:
            return (reader.option("basePath", base) if base else reader).load(paths)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], ddl).limit(0)                   # known to be empty when planned: joins with it go


class SliceStore:
    """Parts (name -> DDL) under one folder, readable as far as the log names their slices."""

    def __init__(self, spark: SparkSession, path: str, parts: Mapping[str, str],
                 formats: Mapping[str, str] | None = None, options: Mapping[str, str] | None = None):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), dict(parts)
        self.formats, self.options = dict(formats or {}), dict(options or {})

    def log(self) -> DataFrame:
        return read_if_there(self.spark, f"{self.path}/log", LOG_DDL, "json").distinct()

    def entries(self, kind: str) -> dict[str, int]:
        """Names in the log with their numbers: one per slice, so their count is the caller's choice."""
        return {r["name"]: r["n"] for r in self.log().where(F.col("kind") == kind).collect()}

    def note(self, kind: str, name: str, n: int) -> None:
        self.spark.createDataFrame([(kind, name, n)], LOG_DDL).coalesce(1).write.mode("append").json(f"{self.path}/log")

    def folder(self, part: str, name: str) -> str:
        return f"{self.path}/{part}/slice={name}"

    def read(self, part: str) -> DataFrame:
        """Rows of all committed slices, with the slice's name in ``slice``."""
        paths = [self.folder(part, s) for s in sorted(self.entries(COMMIT))]
        return read_if_there(self.spark, paths, f"{self.parts[part]}, slice string", self.formats.get(part, "parquet"),
                             base=f"{self.path}/{part}")

    def commit(self, name: str, tables: Mapping[str, DataFrame]) -> None:
        """Write every part of the slice, then name it. Repeating an unfinished commit overwrites its folders."""
        if name in self.entries(COMMIT):
            return
        for part in self.parts:
            rows = tables[part].select(*_names(self.spark, self.parts[part]))
            (rows.write.mode("overwrite").options(**self.options).format(self.formats.get(part, "parquet"))
             .save(self.folder(part, name)))
        self.note(COMMIT, name, 1)


def _names(spark: SparkSession, ddl: str) -> list[str]:
    return spark.createDataFrame([], ddl).columns


def commit_in_slices(store: SliceStore, pending: Callable[[], DataFrame], keys: Sequence[str], slices: int,
                     make: Callable[[DataFrame], Mapping[str, DataFrame]], stop_after: int | None = None) -> list[str]:
    """Do the pending work in ``slices`` commits and return the names committed by this call.

    The rows of ``pending()`` are computed only when no staged work is left over from an
    earlier run; they are written once, cut by a hash of ``keys``, so neither a slice nor
    a restart computes them again. ``make`` turns the rows of a slice into the store's
    parts. ``stop_after`` ends the call after so many commits.
    """
    staged = store.entries(STAGE)
    done = store.entries(COMMIT)
    left = [(g, n) for g, n in sorted(staged.items()) if any(f"{g}-{k}" not in done for k in range(n))]
    todo = pending()
    if not left:
        name = f"g{len(staged):06d}"
        rows = todo.withColumn("slice_no", F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))
        # sorted ranges of (slice, hash): a slice spans as many tasks as its size needs, a task few slices
        (rows.repartitionByRange(F.col("slice_no"), F.xxhash64(*keys)).write.mode("overwrite")
         .partitionBy("slice_no").parquet(f"{store.path}/work/{name}"))
        n = 0 if _staged(store, name, todo).isEmpty() else slices
        store.note(STAGE, name, n)
        left = [(name, n)]
    out = []
    for g, n in left:
        rows = _staged(store, g, todo)
        for k in range(n):
            if f"{g}-{k}" in done:
                continue
            if stop_after is not None and len(out) >= stop_after:
                return out
            store.commit(f"{g}-{k}", make(rows.where(F.col("slice_no") == k).drop("slice_no")))
            out.append(f"{g}-{k}")
    return out


def _staged(store: SliceStore, name: str, like: DataFrame) -> DataFrame:
    schema = StructType([*like.schema.fields, StructField("slice_no", IntegerType())])
    return store.spark.read.schema(schema).parquet(f"{store.path}/work/{name}")

