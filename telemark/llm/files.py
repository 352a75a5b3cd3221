"""Opening files of shared storage inside tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _place(path: str):
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def open_input(path: str):
    """A file for reading at any offset."""
    system, inner = _place(path)
    return system.open_input_file(inner)


class NewFile:
    """A file under a name that no other attempt of the task uses; only finished files are reported."""

    def __init__(self, folder: str, stem: str, suffix: str):
        self.path = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
        system, inner = _place(self.path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(inner, compression=None)  # a name ending in .gz would be compressed again
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
