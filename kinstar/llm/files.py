"""Byte files that tasks write to and read from shared storage.

``file:`` URIs and plain paths use the mounted file system (a shared mount on a
cluster); any other scheme goes through pyarrow's file systems, under their names
(``s3a://`` is ``s3://`` there). A file is
written under a temporary name unique to the attempt and renamed when complete,
so a lost or repeated task never leaves a half-written file under a final name.
"""

from __future__ import annotations

import os
import uuid
from typing import BinaryIO
from urllib.parse import unquote, urlparse

from pyarrow import fs


#: Names of object stores in Spark, and in pyarrow.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasb": "abfs", "wasbs": "abfss"}


def known_uri(uri: str) -> str:
    """A URI as pyarrow names it; a path or a file stays."""
    scheme, sign, rest = uri.partition("://")
    return SCHEMES.get(scheme.lower(), scheme) + sign + rest if sign else uri


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path)
    return fs.FileSystem.from_uri(known_uri(uri))


class NewFile:
    """A file that appears under its final name only on :meth:`commit`."""

    def __init__(self, folder: str):
        self.system, root = _located(folder)
        self.root = root.rstrip("/")
        self.temporary = f"{self.root}/_temporary-{uuid.uuid4().hex}"
        self.system.create_dir(self.root, recursive=True)
        self.stream = self.system.open_output_stream(self.temporary, compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def commit(self, name: str) -> None:
        self.stream.close()
        self.system.move(self.temporary, f"{self.root}/{name}")


def open_file(folder: str, name: str) -> BinaryIO:
    system, root = _located(folder)
    return system.open_input_file(os.path.join(root, name))


def file_size(folder: str, name: str) -> int:
    system, root = _located(folder)
    return system.get_file_info(os.path.join(root, name)).size
