"""File writers as Spark data sources, with a commit by list.

Each task writes files under names of its own and reports them; the driver then writes one list of what all tasks have
reported. Readers follow lists only, so what a failed or repeated task left behind is never seen. In a stream the
list bears the number of the batch, and a batch that is repeated after its list was made changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pa_csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from boxframe.sources.stores import open_store

LISTS = "_lists"


@dataclass
class Written(WriterCommitMessage):
    files: list
    rows: int


class _Folder:
    """What the writers share: the folder, its lists, and how a task writes its files."""

    def __init__(self, options: dict):
        self.path, self.kind = options["path"], options.get("kind", "csv")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = open_store(self.path)
        store.create_dir(folder, recursive=True)
        return self._named(store, folder, iterator) if self.kind == "named" else self._csv(store, folder, iterator)

    def _csv(self, store: fs.FileSystem, folder: str, batches: Iterator[pa.RecordBatch]) -> Written:
        """One CSV file with a header, unless there is no row."""
        name, rows, writer, file = f"part-{uuid.uuid4().hex}.csv", 0, None, None
        try:
            for batch in batches:
                if batch.num_rows:
                    if writer is None:
                        file = store.open_output_stream(f"{folder}/{name}")
                        writer = pa_csv.CSVWriter(file, batch.schema)
                    writer.write(batch)
                    rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
                file.close()
        return Written([name] if rows else [], rows)

    def _named(self, store: fs.FileSystem, folder: str, batches: Iterator[pa.RecordBatch]) -> Written:
        """A file for each row, as its ``name`` says. A repeated task writes the same files again."""
        rows, known = 0, set()
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
                parent = f"{folder}/{name}".rpartition("/")[0]
                if parent not in known:
                    store.create_dir(parent, recursive=True)
                    known.add(parent)
                with store.open_output_stream(f"{folder}/{name}") as file:
                    file.write((text or "").encode())
                rows += 1
        return Written([], rows)

    def commit_as(self, name: str, messages: Sequence[Written | None]) -> None:
        store, folder = open_store(self.path)
        done = [m for m in messages if m is not None]
        target = f"{folder}/{LISTS}/{name}.json"
        if store.get_file_info(target).type == fs.FileType.File:
            self.abort(messages)
            return
        store.create_dir(f"{folder}/{LISTS}", recursive=True)
        text = json.dumps({"files": sorted(f for m in done for f in m.files), "rows": sum(m.rows for m in done)})
        # Under another name first: a list is there whole or not at all.
        with store.open_output_stream(f"{target}.tmp") as file:
            file.write(text.encode())
        store.move(f"{target}.tmp", target)

    def abort(self, messages: Sequence[Written | None], *_: object) -> None:
        store, folder = open_store(self.path)
        for message in messages:
            for name in message.files if message is not None else []:
                store.delete_file(f"{folder}/{name}")


class _Writer(_Folder, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self.commit_as(f"list-{uuid.uuid4().hex}", messages)


class _StreamWriter(_Folder, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.commit_as(f"batch-{batchId:012d}", messages)

    def abort(self, messages: list, batchId: int = 0) -> None:
        _Folder.abort(self, messages)


class ListedFiles(DataSource):
    """``boxframe_listed``: CSV files (``kind`` csv) or named text files (``kind`` named) in a folder with lists."""

    @classmethod
    def name(cls) -> str:
        return "boxframe_listed"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options)


def _ordered(rows: DataFrame, keys: Sequence[str], files: int) -> DataFrame:
    """At most ``files`` parts along the order of the keys, so that a long video takes several and a short one shares."""
    return rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys)


def write_csv_buckets(rows: DataFrame, folder: str, keys: Sequence[str], files: int = 16) -> None:
    """Append rows as at most ``files`` CSV files with headers, in order of ``keys``; all of them become visible at once."""
    rows.sparkSession.dataSource.register(ListedFiles)
    _ordered(rows, keys, files).write.format(ListedFiles.name()).mode("append").option("path", folder).save()


def stream_csv_buckets(stream: DataFrame, folder: str, checkpoint: str, keys: Sequence[str], trigger: dict, files: int = 4) -> StreamingQuery:
    """Append each batch of a stream as at most ``files`` CSV files. A repeated batch is ignored by its number."""
    stream.sparkSession.dataSource.register(ListedFiles)
    parts = stream.repartition(files, *keys)
    writer = parts.writeStream.format(ListedFiles.name()).option("path", folder).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def read_csv_buckets(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all listed files. As many names as files, a bounded number a write, are read on the driver."""
    store, inner = open_store(folder)
    info = store.get_file_info(fs.FileSelector(f"{inner}/{LISTS}", allow_not_found=True))
    names = []
    for file in info:
        if file.path.endswith(".json"):
            with store.open_input_stream(file.path) as lines:
                names += json.loads(lines.read())["files"]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv([f"{folder}/{name}" for name in sorted(names)])


def write_named_texts(texts: DataFrame, folder: str) -> None:
    """A file for each ``(name, text)``, also for an empty text. Names are paths below the folder, each once."""
    texts.sparkSession.dataSource.register(ListedFiles)
    slim = texts.select(F.col("name").cast("string"), F.col("text").cast("string"))
    # Making a file costs more than its bytes, so tasks get even numbers of files, however few blocks the input has.
    slim = slim.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name")
    slim.write.format(ListedFiles.name()).mode("append").option("path", folder).option("kind", "named").save()
