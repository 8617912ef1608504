"""Export one text file per document, keyed by the sanitised URL."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from corpusmill.functions.text import file_key


def export_table(records: DataFrame, max_len: int = 50, order_col: str = "ord") -> DataFrame:
    """``file_key, text``: on a key collision the record with the larger order wins.

    ``max_by`` is a partial aggregate, so a hot key sends one row per task.
    """
    keyed = records.select(file_key("url", max_len).alias("file_key"), "text", order_col)
    return keyed.groupBy("file_key").agg(F.max_by("text", F.col(order_col)).alias("text"))


@dataclass
class _Written(WriterCommitMessage):
    files: int


class _FileWriter(DataSourceWriter):
    """Files are made in a folder beside the target, which takes the target's place when all tasks are done.

    A file gets its name when it is complete. A task that runs again makes the same files
    again; a job that fails takes its folder with it.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.staging = f"{self.path}.{uuid.uuid4().hex}.part"

    @staticmethod
    def _open(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path)

    def write(self, iterator: Iterator) -> _Written:
        files, folder = self._open(self.staging)
        files.create_dir(folder, recursive=True)
        n = 0
        for row in iterator:
            half = f"{folder}/.{uuid.uuid4().hex}"
            with files.open_output_stream(half) as out:
                out.write((row["text"] or "").encode())
            files.move(half, f"{folder}/{row['file_key']}.txt")
            n += 1
        return _Written(n)

    def commit(self, messages: list[_Written | None]) -> None:
        from pyarrow import fs

        files, folder = self._open(self.staging)
        target = self._open(self.path)[1]
        files.create_dir(folder, recursive=True)                     # no task had rows
        if files.get_file_info(target).type != fs.FileType.NotFound:
            files.delete_dir(target)
        files.move(folder, target)

    def abort(self, messages: list[_Written | None]) -> None:
        from pyarrow import fs

        files, folder = self._open(self.staging)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


class DocumentFiles(DataSource):
    """Sink ``document_files``: rows ``file_key, text`` become ``<path>/<file_key>.txt``, replacing the folder.

    The path is one that pyarrow's file systems reach from every executor (an absolute
    path or a ``file``, ``hdfs``, ``s3`` or ``gs`` URI).
    """

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if not overwrite:
            raise ValueError("document_files replaces its folder: write with mode('overwrite')")
        return _FileWriter(self.options["path"])


def export_documents(records: DataFrame, out_dir: str, max_len: int = 50,
                     order_col: str = "ord") -> None:
    """Write ``<out_dir>/<file_key>.txt`` holding exactly the document's text (null: empty)."""
    rows = export_table(records, max_len, order_col)
    rows.sparkSession.dataSource.register(DocumentFiles)
    rows.write.format(DocumentFiles.name()).mode("overwrite").save(out_dir)
