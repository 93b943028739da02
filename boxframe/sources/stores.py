"""Files of any store that Arrow opens, by the paths that Spark uses."""

from __future__ import annotations

import os

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI and the path inside it. Plain paths are local or mounted."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def listed(path: str, suffixes: tuple[str, ...] = (), recursive: bool = True) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the files below a folder, in order, empty ones too; hidden ones (``_``, ``.``) are left out."""
    store, inner = open_store(path)
    found = store.get_file_info(fs.FileSelector(inner, recursive=recursive))
    names = [(f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    return sorted((p, n) for p, n in names if not suffixes or p.lower().endswith(suffixes))


def folders_in(path: str) -> list[str]:
    """Names of the folders in a folder, in order; hidden ones (``_``, ``.``) are left out."""
    store, inner = open_store(path)
    found = store.get_file_info(fs.FileSelector(inner))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith(("_", ".")))


class RangeBytes:
    """A file that can be cut like ``bytes`` but reads only what is asked for, in blocks."""

    BLOCK = 4096

    def __init__(self, file, size: int):
        self.file, self.size, self.blocks = file, size, {}

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at: int | slice) -> int | bytes:
        if isinstance(at, int):
            return self[at : at + 1][0]
        start, stop, _ = at.indices(self.size)
        first, last = start // self.BLOCK, max(start, stop - 1) // self.BLOCK
        data = b"".join(self._block(i) for i in range(first, last + 1))
        return data[start - first * self.BLOCK : max(start, stop) - first * self.BLOCK]

    def _block(self, i: int) -> bytes:
        if i not in self.blocks:
            self.file.seek(i * self.BLOCK)
            self.blocks[i] = self.file.read(self.BLOCK)
        return self.blocks[i]

    @property
    def bytes_read(self) -> int:
        return sum(map(len, self.blocks.values()))
