"""Files of the shared folder from inside a Python worker."""

from __future__ import annotations

from pyarrow import fs


def shared_files(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path (local, HDFS or an object store) and the path inside it."""
    if path.startswith("/"):
        return fs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").strip("/")
    files, inner = fs.FileSystem.from_uri(path)
    return files, inner.rstrip("/")


def exists(files: fs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != fs.FileType.NotFound
