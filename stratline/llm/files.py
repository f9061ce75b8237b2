"""Binary files in the folder that driver and executors share, through Arrow's file systems."""

from __future__ import annotations

import posixpath

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI or a local path."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def put(path: str, content: bytes) -> None:
    """Write a file whole: readers see it under its name only when it is complete."""
    system, plain = opened(path)
    system.create_dir(posixpath.dirname(plain), recursive=True)
    with system.open_output_stream(plain + ".part", compression=None) as out:
        out.write(content)
    system.move(plain + ".part", plain)


def get(path: str) -> bytes:
    system, plain = opened(path)
    with system.open_input_file(plain) as file:
        return file.read()
