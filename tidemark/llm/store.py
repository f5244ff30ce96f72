"""Files in the folder that driver and executors share, whatever system holds it."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _at(uri: str):
    return fs.FileSystem.from_uri(uri)


def write(folder: str, suffix: str, data: bytes) -> str:
    """A new file with a name of its own, so that a task tried twice harms nothing."""
    system, path = _at(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        out.write(data)
    return f"{folder}/{name}"


def read(uri: str, offset: int = 0, length: int | None = None) -> bytes:
    """The whole file, or ``length`` bytes of it."""
    system, path = _at(uri)
    with system.open_input_file(path) as file:
        if offset:
            file.seek(offset)
        return file.read(length) if length is not None else file.read()


class Ranges:
    """Range reads of one file that stays open."""

    def __init__(self, uri: str):
        system, path = _at(uri)
        self.file = system.open_input_file(path)

    def read(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def close(self) -> None:
        self.file.close()


def mapped(uri: str) -> np.ndarray:
    """The bytes of a file as a memory map.

    A file that is not on a mounted system is copied once to a nameless local file, which
    goes with the process.
    """
    system, path = _at(uri)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with tempfile.TemporaryFile() as copy:
        with system.open_input_stream(path) as source:
            while block := source.read(8 << 20):
                copy.write(block)
        copy.flush()
        return np.memmap(copy, np.uint8, "r")
