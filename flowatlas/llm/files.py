"""Binary files in the shared folder, from inside tasks: any file system that
pyarrow knows by URI (local or shared mounts, HDFS, S3, GCS)."""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path within it."""
    if "://" not in uri:
        uri = uri.replace("file:", "", 1)
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def unique(folder: str, stem: str, suffix: str) -> str:
    """A name that no other task attempt uses: a lost or repeated attempt
    leaves a file that no committed manifest lists."""
    return f"{folder}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"


def write_bytes(uri: str, data: bytes) -> None:
    f, path = open_fs(uri)
    f.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with f.open_output_stream(path) as out:
        out.write(data)


def read_bytes(uri: str) -> bytes:
    f, path = open_fs(uri)
    with f.open_input_stream(path) as src:
        return src.read()


def read_range(uri: str, start: int, length: int) -> bytes:
    """Bytes [start, start + length) of a file, fewer at its end."""
    f, path = open_fs(uri)
    with f.open_input_file(path) as src:
        n = max(0, min(length, src.size() - start))
        return src.read_at(n, start) if n else b""
