"""Files of any store that Hadoop reads: listing, small texts, renames."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    size: int
    modified: int


class Storage:
    """The file system of a path, through the session's own configuration."""

    def __init__(self, spark: SparkSession):
        self.spark, self.jvm = spark, spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def entries(self, path: str) -> list[Entry]:
        """What a folder holds, by name; nothing if there is no such folder."""
        fs, at = self._at(path)
        if not fs.exists(at):
            return []
        found = [Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(at)]
        return sorted(found, key=lambda e: e.name)

    def folders(self, path: str) -> list[str]:
        return [e.name for e in self.entries(path) if e.is_dir]

    def read_bytes(self, path: str) -> bytes:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        fs, at = self._at(path)
        stream = fs.create(at, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def write_json(self, path: str, value: object) -> None:
        self.write_text(path, json.dumps(value, indent=1, sort_keys=True, default=str))

    def read_json(self, path: str) -> dict | None:
        """A JSON document; without byte-order mark and NUL bytes, and None if nothing else is in the file, or no file."""
        if not self.exists(path):
            return None
        text = self.read_bytes(path).replace(b"\0", b"").decode("utf-8-sig").strip()
        return json.loads(text) if text else None

    def delete(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.delete(at, True)

    def rename(self, source: str, target: str) -> None:
        fs, at = self._at(source)
        if not fs.rename(at, self._at(target)[1]):
            raise OSError(f"{source} can't become {target}")

    def qualified(self, path: str) -> str:
        """A path in the form in which listings and file metadata give it."""
        fs, at = self._at(path)
        return fs.makeQualified(at).toString()

    def parts(self, path: str) -> list[Entry]:
        """The data files of a folder and the folders in it."""
        out = []
        for e in self.entries(path):
            if e.is_dir and not e.name.startswith(("_", ".")):
                out += self.parts(e.path)
            elif not e.is_dir and e.name.startswith("part-"):
                out.append(e)
        return out
