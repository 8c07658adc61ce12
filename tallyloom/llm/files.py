"""Files that tasks write to, and read ranges of, in the shared folder; any address that pyarrow's file systems know."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _at(uri: str):
    """Spark writes file:/path as well as file:///path."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


class Roll:
    """Appends byte strings to files of at most `limit` bytes, or one string; each file has a name no other attempt uses."""

    def __init__(self, folder: str, suffix: str, limit: int, head: bytes = b"", tail: bytes = b""):
        self.folder, self.suffix, self.limit, self.head, self.tail, self.out = folder, suffix, limit, head, tail, None
        self.done: list[tuple[str, int]] = []

    def write(self, data: bytes) -> tuple[str, int, bool]:
        """(file, offset, whether the file is new)."""
        new = self.out is None or self.size + len(data) > self.limit
        if new:
            self.close()
            self.path = f"{self.folder}/{uuid.uuid4().hex}{self.suffix}"
            system, path = _at(self.path)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self.out = system.open_output_stream(path, compression=None)  # else guessed from the suffix
            self.out.write(self.head)
            self.size = len(self.head)
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return self.path, at, new

    def close(self) -> None:
        if self.out is not None:
            self.out.write(self.tail)
            self.out.close()
            self.done.append((self.path, self.size + len(self.tail)))
            self.out = None


class Ranges:
    """Reads ranges; keeps the file of the last read open."""

    def __init__(self):
        self.path = self.file = None

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path != self.path:
            self.close()
            system, at = _at(path)
            self.path, self.file = path, system.open_input_file(at)
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path = self.file = None


def stream(path: str, chunk: int = 1 << 20):
    system, at = _at(path)
    with system.open_input_stream(at, compression=None) as f:
        while data := f.read(chunk):
            yield data
