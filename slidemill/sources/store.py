"""Small files by path or address: local ones, and those of any file system that Arrow opens (s3, gs, hdfs, ...)."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def size(path: str) -> int | None:
    """The size of a file; None if there is no file."""
    system, at = opened(path)
    info = system.get_file_info(at)
    return info.size if info.type == fs.FileType.File else None


def read(path: str, most: int | None = None) -> bytes:
    system, at = opened(path)
    with system.open_input_stream(at, compression=None) as f:
        return f.read() if most is None else f.read(most)


def write(path: str, data: bytes) -> None:
    """Writes a file as a whole: beside it and renamed, or at once where the store shows only finished objects."""
    system, at = opened(path)
    if isinstance(system, (fs.LocalFileSystem, fs.HadoopFileSystem)):
        system.create_dir(os.path.dirname(at) or ".", recursive=True)
        part = f"{at}.{uuid.uuid4().hex}.part"
        try:
            with system.open_output_stream(part, compression=None) as f:
                f.write(data)
            system.move(part, at)
        finally:
            if system.get_file_info(part).type == fs.FileType.File:
                system.delete_file(part)
    else:
        with system.open_output_stream(at, compression=None) as f:
            f.write(data)


def append_text(path: str, text: str) -> None:
    """Adds to a small text file, such as a log."""
    before = read(path) if size(path) is not None else b""
    write(path, before + text.encode())


def delete(path: str) -> None:
    system, at = opened(path)
    system.delete_file(at)
