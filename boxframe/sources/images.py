"""Image size from file headers."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.schemas import IMAGE_EXTENSIONS

_NETPBM = re.compile(rb"P([1-6])(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)\s")


def _jpeg_size(data: bytes) -> tuple[int, int] | None:
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF or 0xD0 <= marker <= 0xD8 or marker == 0x01:
            at += 1 if marker == 0xFF else 2
            continue
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def _tiff_size(data: bytes) -> tuple[int, int] | None:
    order = "<" if data[:2] == b"II" else ">"
    (start,) = struct.unpack(order + "I", data[4:8])
    (entries,) = struct.unpack(order + "H", data[start : start + 2])
    found: dict[int, int] = {}
    for i in range(entries):
        raw = data[start + 2 + 12 * i : start + 14 + 12 * i]
        tag, kind = struct.unpack(order + "HH", raw[:4])
        if tag in (256, 257):
            width = 2 if kind == 3 else 4
            found[tag] = int.from_bytes(raw[8 : 8 + width], "little" if order == "<" else "big")
    return (found[256], found[257]) if len(found) == 2 else None


def header_size(data: bytes) -> tuple[int, int] | None:
    """Width and height named by a PNG, BMP, JPEG, TIFF or Netpbm header."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", data[16:24])
    if data[:2] == b"BM":
        width, height = struct.unpack("<ii", data[18:26])
        return width, abs(height)
    if data[:2] == b"\xff\xd8":
        return _jpeg_size(data)
    if data[:4] in (b"II*\x00", b"MM\x00*"):
        return _tiff_size(data)
    match = _NETPBM.match(data[:4096])
    return (int(match[2]), int(match[3])) if match else None


def image_meta(files: DataFrame, id_col: str = "path", content_col: str = "content") -> DataFrame:
    """``(id, width, height, error)`` of image bytes; unreadable or empty sizes are an error."""
    id_type = files.schema[id_col].dataType.simpleString()

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, errors = [], []
            for data in batch[content_col]:
                try:
                    size = header_size(bytes(data)) if data is not None else None
                except (struct.error, IndexError):
                    size = None
                good = size is not None and size[0] > 0 and size[1] > 0
                sizes.append(size if good else (None, None))
                errors.append(
                    None if good else "unreadable" if size is None else "non_positive_dimension"
                )
            yield pd.DataFrame(
                {
                    id_col: batch[id_col],
                    "width": pd.array([s[0] for s in sizes], dtype="Int32"),
                    "height": pd.array([s[1] for s in sizes], dtype="Int32"),
                    "error": errors,
                }
            )

    schema = f"`{id_col}` {id_type}, width int, height int, error string"
    return files.select(id_col, content_col).mapInPandas(decode, schema)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length, content)`` of image files; leave out ``content`` to only list them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return files.filter(suffix.isin(*IMAGE_EXTENSIONS))
