"""Files of our own formats in the shared folder, written and read by tasks."""

from __future__ import annotations

from functools import lru_cache

from pyarrow import fs


@lru_cache(maxsize=16)
def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the folder's path in it; the folder is made if absent."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return system, path


def writer(folder: str, name: str):
    system, path = opened(folder)
    return system.open_output_stream(f"{path}/{name}", compression=None)


def reader(folder: str, name: str):
    """A file for range reads: ``read_at(bytes, offset)``."""
    system, path = opened(folder)
    return system.open_input_file(f"{path}/{name}")
