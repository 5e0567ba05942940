"""Files of any file system that a path or an address names: listing, moving, reading and writing on the driver."""

from __future__ import annotations

import fnmatch
import os

from pyarrow import fs as _fs


def filesystem(path: str) -> tuple[_fs.FileSystem, str]:
    """The file system of ``path``, local for a plain path, and the path within it."""
    if path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    if "://" in path or path.startswith("file:"):
        return _fs.FileSystem.from_uri(path)
    return _fs.LocalFileSystem(), os.path.abspath(path)


def join(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def _info(path: str) -> _fs.FileInfo:
    system, inner = filesystem(path)
    return system.get_file_info(inner)


def is_file(path: str) -> bool:
    return _info(path).type == _fs.FileType.File


def exists(path: str) -> bool:
    return _info(path).type != _fs.FileType.NotFound


def size_of(path: str) -> int:
    return _info(path).size or 0


def listing(folder: str, *patterns: str, recursive: bool = False, hidden: bool = False) -> list[str]:
    """The files below a folder whose names match any pattern, sorted, each once; none if there is no such folder."""
    system, inner = filesystem(folder)
    found = system.get_file_info(_fs.FileSelector(inner, recursive=recursive, allow_not_found=True))
    prefix = folder[: len(folder) - len(inner)] if folder.endswith(inner) and "://" in folder else ""
    kept = [f for f in found if f.type == _fs.FileType.File and any(fnmatch.fnmatch(f.base_name, p) for p in patterns or ("*",))]
    return sorted(prefix + f.path for f in kept if hidden or not f.base_name.startswith(("_", ".")))


def move(source: str, target: str) -> None:
    system, inner = filesystem(source)
    system.move(inner, filesystem(target)[1])


def make_folder(path: str) -> None:
    system, inner = filesystem(path)
    system.create_dir(inner, recursive=True)


def remove(path: str) -> None:
    """Remove a file or a whole folder, if it is there."""
    system, inner = filesystem(path)
    kind = system.get_file_info(inner).type
    if kind == _fs.FileType.Directory:
        system.delete_dir(inner)
    elif kind == _fs.FileType.File:
        system.delete_file(inner)


def read_text(path: str) -> str:
    system, inner = filesystem(path)
    with system.open_input_stream(inner, compression=None) as stream:
        return stream.read().decode("utf-8")


def write_text(path: str, text: str) -> None:
    system, inner = filesystem(path)
    parent = os.path.dirname(inner)
    if parent:
        system.create_dir(parent, recursive=True)
    with system.open_output_stream(inner, compression=None) as stream:
        stream.write(text.encode("utf-8"))
