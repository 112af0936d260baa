"""Files that tasks write and read themselves, in whatever shared store the folder's address names."""

from __future__ import annotations

from pyarrow import fs

# Hadoop's names of stores that Arrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "viewfs": "viewfs"}


def opened(address: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it."""
    scheme, found, rest = address.partition(":/")
    if not found or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if found else address).lstrip("/")
    if scheme in ("hdfs", "viewfs"):
        return fs.HadoopFileSystem.from_uri(address), "/" + rest.lstrip("/").partition("/")[2]
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:/{rest}")


def exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound
