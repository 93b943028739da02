"""File readers as Spark data sources: whole texts, and image sizes from headers.

The folder is listed once, when the read is planned; the list fixes the number of partitions by bytes and by a price
for opening a file. Only the columns of the schema that a read asks for are filled: without ``text``, no file is
opened.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from boxframe.schemas import IMAGE_EXTENSIONS
from boxframe.sources.images import header_size
from boxframe.sources.stores import RangeBytes, folders_in, listed, open_store

#: Bytes of a partition, and what opening a file counts for, unless options say otherwise.
PARTITION_BYTES, OPEN_COST = 64 << 20, 64 << 10
#: Bytes of text after which a batch is handed on.
BATCH_BYTES = 8 << 20
TEXT_FILES = "path string, size bigint, text string"
_TEXT_FILES = StructType().add("path", "string").add("size", "long").add("text", "string")
IMAGE_SIZES = "path string, size bigint, width int, height int, error string, bytes_read bigint"


@dataclass
class _Files(InputPartition):
    files: list


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType, suffixes: tuple[str, ...]):
        self.path, self.columns = options["path"], schema.names
        self.suffixes = tuple(s for s in options.get("suffixes", "").split(",") if s) or suffixes
        self.recursive = options.get("recursive", "true").lower() == "true"
        self.bytes, self.cost = int(options.get("partitionbytes", PARTITION_BYTES)), int(options.get("opencost", OPEN_COST))

    def partitions(self) -> list[_Files]:
        out, part, filled = [], [], 0
        for file in listed(self.path, self.suffixes, self.recursive):
            price = file[1] + self.cost
            if part and filled + price > self.bytes:
                out.append(_Files(part))
                part, filled = [], 0
            part.append(file)
            filled += price
        return [*out, _Files(part)]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        store = open_store(self.path)[0] if partition.files else None
        for path, size in partition.files:
            rows.append(self.row(store, path, size))
            held += size if self.reads_text else 1024
            if held >= BATCH_BYTES:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @property
    def reads_text(self) -> bool:
        return "text" in self.columns

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], self.kinds[c]) for c in self.columns], names=self.columns)

    kinds = {"path": pa.string(), "size": pa.int64(), "text": pa.string(), "width": pa.int32(), "height": pa.int32(), "error": pa.string(), "bytes_read": pa.int64()}

    def row(self, store, path: str, size: int) -> dict:
        raise NotImplementedError


class _TextReader(_Reader):
    def row(self, store, path: str, size: int) -> dict:
        text = None
        if self.reads_text:
            with store.open_input_stream(path) as file:
                text = file.read().decode("utf-8", "replace")
        return {"path": path, "size": size, "text": text}


class _SizeReader(_Reader):
    def row(self, store, path: str, size: int) -> dict:
        found, count = None, 0
        if any(c not in ("path", "size") for c in self.columns):
            with store.open_input_file(path) as file:
                data = RangeBytes(file, size)
                try:
                    found = header_size(data)
                except (struct.error, IndexError):
                    found = None
                count = data.bytes_read
        good = found is not None and found[0] > 0 and found[1] > 0
        error = None if good else "unreadable" if found is None else "non_positive_dimension"
        width, height = found if good else (None, None)
        return {"path": path, "size": size, "width": width, "height": height, "error": error, "bytes_read": count}


class TextFiles(DataSource):
    """``boxframe_text_files``: a row for each file, an empty one too."""

    @classmethod
    def name(cls) -> str:
        return "boxframe_text_files"

    def schema(self) -> str:
        return TEXT_FILES

    def reader(self, schema: StructType) -> DataSourceReader:
        return _TextReader(self.options, schema, ())


class ImageSizes(DataSource):
    """``boxframe_image_sizes``: width and height of image files, from some blocks of their headers."""

    @classmethod
    def name(cls) -> str:
        return "boxframe_image_sizes"

    def schema(self) -> str:
        return IMAGE_SIZES

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SizeReader(self.options, schema, IMAGE_EXTENSIONS)


def read_text_files(spark: SparkSession, path: str, suffixes: str = "", columns: str = TEXT_FILES, **options: object) -> DataFrame:
    """Files below a folder. ``columns`` is the schema to fill; options are those of the module."""
    spark.dataSource.register(TextFiles)
    return spark.read.format(TextFiles.name()).options(suffixes=suffixes, **options).schema(columns).load(path)


def read_text_folders(spark: SparkSession, path: str, suffixes: str = "") -> DataFrame:
    """``path``, ``size`` and ``text`` of the files in the folders of a folder, for very many files.

    The driver sees the folders only; a task lists and reads one of them.
    """
    folders = [(f,) for f in folders_in(path)]
    wanted = tuple(s for s in suffixes.split(",") if s)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _TextReader({"path": path}, _TEXT_FILES, wanted)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                yield from reader.read(_Files(listed(f"{path.rstrip('/')}/{folder}", wanted, False)))

    named = spark.createDataFrame(folders, "folder string").repartition(max(1, len(folders)))
    return named.mapInArrow(read, TEXT_FILES)


def read_image_sizes(spark: SparkSession, path: str, columns: str = IMAGE_SIZES, **options: object) -> DataFrame:
    """``path``, ``size``, ``width``, ``height`` and ``error`` of image files below a folder.

    A header is read in blocks of 4 KB where it points to, so an image costs a few blocks, however long it is and
    wherever its size stands. ``error`` is ``unreadable`` or ``non_positive_dimension``; pixels aren't decoded.
    """
    spark.dataSource.register(ImageSizes)
    return spark.read.format(ImageSizes.name()).options(**options).schema(columns).load(path)
