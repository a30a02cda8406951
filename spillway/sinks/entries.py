"""Numbered entries: small JSON files in a folder of a shared store, each created at most once.

The number is the version of what the folder describes; the entry with the highest number is the state. Putting an entry
under a number that is taken fails, which is how two writers find out that one of them was second
(compare and swap). An entry carries all that the next one needs, so old entries can go and a folder never
holds more than a few.

Create-if-absent is a hard link on a local file system and a rename on others, which HDFS refuses onto an existing
file. An object store without conditional writes does not give this guarantee.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

KEEP = 16  # entries that stay behind the newest


class Entries:
    def __init__(self, spark: SparkSession, folder: str, keep: int = KEEP):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.local = self.fs.getUri().getScheme() == "file"
        self.folder = urlparse(folder).path if self.local else folder
        self.keep, self._jvm = keep, jvm

    def numbers(self) -> list[int]:
        """Numbers of the entries that are there, in order."""
        if self.local:
            names = os.listdir(self.folder) if os.path.isdir(self.folder) else []
        else:
            root = self._path(self.folder)
            names = [s.getPath().getName() for s in self.fs.listStatus(root)] if self.fs.exists(root) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _name(self, number: int) -> str:
        return f"{self.folder}/{number:020d}.json"

    def read(self, number: int) -> dict:
        if self.local:
            with open(self._name(number), encoding="utf-8") as file:
                return json.load(file)
        reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(self.fs.open(self._path(self._name(number))), "UTF-8"))
        try:
            return json.loads(reader.readLine())
        finally:
            reader.close()

    def newest(self, below: int | None = None) -> tuple[int, dict]:
        """(number, entry) of the newest entry (with a number under ``below``), (-1, {}) without one.

        An entry that another writer has just cleaned away is not the newest any more: the folder is listed again."""
        while True:
            own = [n for n in self.numbers() if below is None or n < below]
            if not own:
                return -1, {}
            try:
                return own[-1], self.read(own[-1])
            except Exception:  # noqa: BLE001 - gone, or a real fault, which the next read shows
                if own[-1] in self.numbers():
                    raise

    def put(self, number: int, entry: dict, replace: bool = False) -> bool:
        """Creates the entry; False where the number is taken (unless ``replace``) or older than the newest."""
        text, spare = json.dumps(entry, sort_keys=True), f"{self.folder}/.{uuid.uuid4().hex}"
        if self.local:
            os.makedirs(self.folder, exist_ok=True)
            with open(spare, "w", encoding="utf-8") as file:
                file.write(text)
            try:
                os.replace(spare, self._name(number)) if replace else os.link(spare, self._name(number))
            except FileExistsError:
                return False
            finally:
                if os.path.exists(spare):
                    os.unlink(spare)
        else:
            out = self.fs.create(self._path(spare), True)
            out.write(text.encode())
            out.close()
            if replace:
                self.fs.delete(self._path(self._name(number)), False)
            if not self.fs.rename(self._path(spare), self._path(self._name(number))):
                self.fs.delete(self._path(spare), False)
                return False
        if not replace and self.numbers()[-1] != number:  # the number was free because its entry had been cleaned away
            self.remove(number)
            return False
        for old in self.numbers()[:-self.keep - 1]:
            self.remove(old)
        return True

    def remove(self, number: int) -> None:
        if self.local:
            try:
                os.unlink(self._name(number))
            except FileNotFoundError:
                pass
        else:
            self.fs.delete(self._path(self._name(number)), False)


def folder_of(name: str) -> str:
    """Folder name of a queue or writer: any characters, the same in every process."""
    return hashlib.sha1(name.encode()).hexdigest()[:16]


def subfolders(spark: SparkSession, root: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def newest_of_each(spark: SparkSession, root: str) -> list[dict]:
    """Newest entry of every subfolder of ``root`` (one a queue or writer)."""
    found = [Entries(spark, f"{root}/{name}").newest()[1] for name in subfolders(spark, root)]
    return [e for e in found if e]
