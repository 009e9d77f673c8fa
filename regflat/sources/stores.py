"""Files of any store by path, opened inside tasks with random access (local, HDFS, object stores through Arrow)."""

from __future__ import annotations

import re
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and the path in it, for a path as Spark lists it."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    # Spark shows paths as they are; a URI needs its blanks and signs escaped
    return fs.FileSystem.from_uri(quote(path, safe=":/@=,+~!$&'()*;%"))


def open_file(path: str) -> pa.NativeFile:
    """A file that can be read from any place."""
    where, at = locate(path)
    return where.open_input_file(at)


def open_stream(path: str) -> pa.NativeFile:
    """A file from its start on, decompressed by its suffix."""
    where, at = locate(path)
    return where.open_input_stream(at, compression="detect")
