"""Replacing partitions of a Parquet target so that a reader finds the old rows or the new.

New files are written to a folder of their own below the target (``_pending``, which scans of
the target skip). Then one small file, the note, is put in place by a rename: it lists the new
files and the partition folders that they replace. From that moment the load counts as done.
Moving the files in and deleting the old ones comes after, a file at a time:

- before the note, the target is as it was; what a lost load left in ``_pending`` is removed by
  the next one;
- with the note, ``visible_files`` finds each new file where it is, moved or not, and hides
  the old ones, so a reader needs no lock and changes nothing;
- ``finish`` moves what has not been moved, deletes what is replaced and drops the note. It
  can be repeated from any point; every load and every call of it after a crash completes the
  swap before anything else.

The note lasts as long as the swap; there is no history. A target has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Optional

from pyspark.sql import SparkSession

PENDING, NOTE = "_pending", "_swap.json"
#: File-system calls under way at once while a swap is completed.
CALLS = 8


class FileSystem:
    """The few file-system calls of a swap, on the file system that ``path`` lies on."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self.at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self.at(path)))

    def size(self, path: str) -> int:
        return int(self._fs.getFileStatus(self.at(path)).getLen())

    def delete(self, path: str) -> None:
        self._fs.delete(self.at(path), True)

    def make_parent(self, path: str) -> None:
        self._fs.mkdirs(self.at(path).getParent())

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self.at(old), self.at(new)):
            raise OSError(f"could not rename {old} to {new}")

    def names(self, folder: str, *, folders: bool) -> list[str]:
        """Names below ``folder`` that scans see: data files, or sub-folders."""
        if not self.exists(folder):
            return []
        found = [st for st in self._fs.listStatus(self.at(folder)) if bool(st.isDirectory()) == folders]
        names = [st.getPath().getName() for st in found]
        return sorted(n for n in names if not n.startswith(".") and (not n.startswith("_") or "=" in n))

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self.at(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        stream = self._fs.open(self.at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _join(*parts: str) -> str:
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate(parts) if p)


def leaf_folders(fs: FileSystem, path: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below ``path``, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [_join(f, n) if f else n for f in found for n in fs.names(_join(path, f), folders=True) if "=" in n]
    return found


def note_of(spark: SparkSession, path: str) -> Optional[dict]:
    """The note of a swap under way at ``path``: its pending folder, new files and replaced
    partition folders; ``None`` in the ordinary case (one existence check)."""
    fs = FileSystem(spark, path)
    where = _join(path, NOTE)
    return json.loads(fs.read(where)) if fs.exists(where) else None


def new_pending(spark: SparkSession, path: str) -> str:
    """Completes a swap that was broken off, clears what unfinished loads left, and returns a
    fresh folder below ``path`` to write new partitions to."""
    finish(spark, path)
    fs = FileSystem(spark, path)
    fs.delete(_join(path, PENDING))
    return _join(path, PENDING, uuid.uuid4().hex)


def decide(spark: SparkSession, path: str, pending: str, depth: int, *, replace_all: bool) -> dict:
    """Puts the note in place: the files below ``pending`` take the place of the partitions they
    belong to, or with ``replace_all`` of everything in the target."""
    fs = FileSystem(spark, path)
    folders = leaf_folders(fs, pending, depth)
    files = [_join(f, n) if f else n for f in folders for n in fs.names(_join(pending, f), folders=False)]
    replaced = sorted({*folders, *(leaf_folders(fs, path, depth) if replace_all else [])})
    note = {"pending": pending[len(path.rstrip("/")) + 1 :], "files": files, "folders": replaced}
    draft = f"{pending}{NOTE}"  # no reader knows this name
    fs.write(draft, json.dumps(note))
    fs.rename(draft, _join(path, NOTE))
    return note


def visible_files(spark: SparkSession, path: str, note: dict, folders: Optional[list[str]] = None) -> dict[str, list[str]]:
    """{base path: new files} of a swap under way, each where it is now: below the target or
    still pending. ``folders`` restricts them to some partition folders."""
    fs = FileSystem(spark, path)
    pending = _join(path, note["pending"])
    found: dict[str, list[str]] = {}
    for name in note["files"]:
        if folders is not None and name.rpartition("/")[0] not in folders:
            continue
        base = path.rstrip("/") if fs.exists(_join(path, name)) else pending
        found.setdefault(base, []).append(_join(base, name))
    return found


def finish(spark: SparkSession, path: str) -> bool:
    """Completes the swap that a note at ``path`` describes, from wherever it stands; False if
    there is none."""
    note = note_of(spark, path)
    if note is None:
        return False
    fs = FileSystem(spark, path)
    new = set(note["files"])

    def move(name: str) -> None:
        if not fs.exists(_join(path, name)):
            fs.make_parent(_join(path, name))
            fs.rename(_join(path, note["pending"], name), _join(path, name))

    def clear(folder: str) -> None:
        mine = [_join(folder, n) if folder else n for n in fs.names(_join(path, folder), folders=False)]
        if folder and not any(n in new for n in mine):
            fs.delete(_join(path, folder))
            return
        for name in mine:
            if name not in new:
                fs.delete(_join(path, name))

    with ThreadPoolExecutor(max_workers=CALLS) as pool:  # file-system calls wait for the store, not for us
        list(pool.map(move, note["files"]))
        list(pool.map(clear, note["folders"]))
    fs.delete(_join(path, PENDING))
    fs.delete(_join(path, NOTE))
    return True
