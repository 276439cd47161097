"""Sorted arrays in files of the shared folder, memory-mapped by the workers.

A file holds several arrays of one length. Writers publish by renaming a
finished file, so a task that runs again, or twice at once, leaves one whole
file with the same bytes.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections import OrderedDict
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def write_arrays(uri: str, arrays: list[np.ndarray]) -> None:
    """Write arrays of equal length one after the other."""
    system, path = (fs.LocalFileSystem(), _local(uri)) if _local(uri) else fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        out.write(np.array([len(arrays[0])], "<i8").tobytes())
        for a in arrays:
            out.write(memoryview(np.ascontiguousarray(a)).cast("B") if len(a) else b"")
    system.move(own, path)


class MappedArrays:
    """The arrays of a file, mapped for the length of a ``with`` block. A file
    of a remote store is first copied to an unlinked temporary file."""

    def __init__(self, uri: str, dtypes: list[str]):
        self.uri, self.dtypes = uri, [np.dtype(d) for d in dtypes]

    def __enter__(self) -> list[np.ndarray]:
        path = _local(self.uri)
        if path:
            self.file = open(path, "rb")
        else:
            self.file = tempfile.TemporaryFile()
            system, name = fs.FileSystem.from_uri(self.uri)
            with system.open_input_stream(name) as src:
                while part := src.read(8 << 20):
                    self.file.write(part)
            self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        n, at, out = int(np.frombuffer(self.map, "<i8", 1)[0]), 8, []
        for d in self.dtypes:
            out.append(np.frombuffer(self.map, d, n, at))
            at += n * d.itemsize
        return out

    def __exit__(self, *_) -> None:
        self.file.close()  # the mapping goes with the last array that views it


class OpenArrays:
    """Files that a task keeps open between its batches: each is opened, and one
    of a remote store copied, once, unless more than ``most_files``, or copies of
    more than ``most_copied`` bytes, are in use; then the one that was used
    longest ago is closed and opened again when it is next wanted."""

    def __init__(self, most_files: int = 4096, most_copied: int = 1 << 30):
        self.most_files, self.most_copied = most_files, most_copied
        self.open: OrderedDict[str, tuple[MappedArrays, list[np.ndarray]]] = OrderedDict()
        self.copied = 0

    def get(self, uri: str, dtypes: list[str]) -> list[np.ndarray]:
        if uri in self.open:
            self.open.move_to_end(uri)
            return self.open[uri][1]
        mapped = MappedArrays(uri, dtypes)
        arrays = mapped.__enter__()
        mapped.__exit__()  # the mapping outlives the file's handle
        self.copied += 0 if _local(uri) else len(mapped.map)
        self.open[uri] = mapped, arrays
        while len(self.open) > 1 and (len(self.open) > self.most_files or self.copied > self.most_copied):
            old, (gone, _) = self.open.popitem(last=False)
            self.copied -= 0 if _local(old) else len(gone.map)
        return arrays


def lookup(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of sorted ``wanted`` in ``sorted_keys`` and whether they are there."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted
