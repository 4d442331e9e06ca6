"""Binary files in the shared folder, from Python workers.

A file is written under a name of the attempt and then moved to its final name, so a task that
runs again or twice leaves one whole file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder URI and the path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:") and not folder.startswith("file://"):
        return fs.LocalFileSystem(), folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


class SharedFolder:
    """Writes and reads whole files and byte ranges of one folder."""

    def __init__(self, folder: str) -> None:
        self.system, self.path = opened(folder)

    def write(self, name: str, content: bytes) -> None:
        self.system.create_dir(self.path, recursive=True)
        attempt = f"{self.path}/.{name}-{uuid.uuid4().hex}"
        with self.system.open_output_stream(attempt) as out:
            out.write(content)
        self.system.move(attempt, f"{self.path}/{name}")

    def read(self, name: str, start: int, length: int) -> bytes:
        with self.system.open_input_file(f"{self.path}/{name}") as source:
            source.seek(start)
            return source.read(length)

    def read_all(self, name: str) -> bytes:
        with self.system.open_input_stream(f"{self.path}/{name}") as source:
            return source.read()
