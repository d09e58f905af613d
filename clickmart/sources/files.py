"""Files that tasks open themselves, in any store pyarrow reaches (local, s3, gs, hdfs)."""

from __future__ import annotations

import io
import re

import pyarrow as pa
from pyarrow import fs as pafs

KNOWN_SCHEMES = ("file", "s3", "s3a", "s3n", "gs", "hdfs")


def scheme(path: str) -> str:
    m = re.match(r"([a-z][a-z0-9+.-]*):", path)
    return m[1] if m else "file"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI as Spark writes it, and the path in it."""
    if scheme(path) == "file":
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


class _Input(io.RawIOBase):
    """A file of a file system as Python's libraries expect it."""

    def __init__(self, file: pa.NativeFile):
        super().__init__()
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        try:
            return self.file.seek(offset, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def tell(self) -> int:
        return self.file.tell()

    def close(self) -> None:
        self.file.close()
        super().close()


def open_input(path: str) -> io.BufferedReader:
    """A file handle that can seek."""
    system, name = filesystem(path)
    return io.BufferedReader(_Input(system.open_input_file(name)), 1 << 20)
