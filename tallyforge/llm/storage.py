"""Byte files in the shared folder, written and read by tasks through Arrow's file systems."""

from __future__ import annotations

import uuid

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def fresh_name(stem: str, suffix: str) -> str:
    """A file name no other attempt of the task uses. Who lists the files that count does so
    from the results of tasks that succeeded, so files of lost attempts are never read."""
    return f"{stem}-{uuid.uuid4().hex}{suffix}"


def make_folder(uri: str) -> None:
    system, path = place(uri)
    system.create_dir(path, recursive=True)
