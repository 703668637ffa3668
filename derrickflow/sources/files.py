"""File access by URI for Python tasks (local, HDFS and object stores through Arrow)."""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyarrow import fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a URI or a plain path; percent escapes of file URIs are undone."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


def remove(uri: str) -> None:
    """Delete a folder and all in it; nothing happens if there is none."""
    fs, path = resolve(uri)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)
