"""Landed books as a Python data source: one flat text file per book, many files per folder.

A landing directory holds files ``book_id_<id>.txt``, directly or in folders ``shard=<n>`` of bounded
size, so that neither a folder nor a commit belongs to a single book.  The writer's tasks put each
file under its final name by a rename, so a task that is run again leaves the same files.  The reader
makes a partition of each folder (tasks list their own folder) and of each slice of the loose files;
files of other extensions are skipped by name.  Filters on ``book_id`` are pushed down: an equality
or an IN list opens only the files of these books.

``listed`` gives the names of the files alone, ``contents`` the bytes of files so named: tasks list the
folders and open the files, whatever their number.

Paths go through ``pyarrow.fs``, so any file system that it knows can hold the landing.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition,
                                    WriterCommitMessage)

from lectern.session import BATCH_BYTES

NAME = re.compile(r"book_id_(-?\d+)\.")
SHARD = "shard="
#: loose files that one reader partition takes
FILES_PER_PARTITION = 512
SCHEMA = "book_id long, file_name string, modified timestamp, text string"


def file_system(path: str):
    """(pyarrow file system, path in it)."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def shard_of(book_id: int, shards: int) -> int:
    """The folder of a book (the same wherever it is computed)."""
    return int.from_bytes(hashlib.md5(str(book_id).encode()).digest()[:8], "big") % shards


@dataclass
class Folder(InputPartition):
    path: str
    recursive: bool


@dataclass
class Files(InputPartition):
    paths: list[str]


class LandedBooksReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.suffix = options.get("suffix", ".txt")
        self.slice = int(options.get("filesPerPartition", FILES_PER_PARTITION))
        self.books: set[int] | None = None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("book_id",):
                books = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.books = books if self.books is None else self.books & books
            yield f  # names are not trusted alone: Spark filters the rows as well

    def partitions(self):
        from pyarrow import fs
        system, root = file_system(self.path)
        top = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        folders = sorted(i.path for i in top if i.type == fs.FileType.Directory)
        loose = sorted(i.path for i in top if i.type == fs.FileType.File and self._wanted(i.path))
        if self.books is not None:
            # a book's folder among the n shards of a writer is known
            shards = [f for f in folders if posixpath.basename(f).startswith(SHARD)]
            known = {f"{SHARD}{shard_of(b, len(shards)):05d}" for b in self.books} if shards else set()
            folders = [f for f in folders if f not in shards or posixpath.basename(f) in known]
        out: list[InputPartition] = [Folder(f, True) for f in folders]
        out += [Files(loose[i:i + self.slice]) for i in range(0, len(loose), self.slice)]
        return out or [Files([])]

    def _wanted(self, path: str) -> bool:
        name = posixpath.basename(path)
        if not name.endswith(self.suffix) or name.startswith((".", "_")):
            return False
        if self.books is None:
            return True
        key = NAME.search(name)
        return key is not None and int(key.group(1)) in self.books

    def read(self, partition):
        from pyarrow import fs
        system, _ = file_system(self.path)
        if isinstance(partition, Folder):
            infos = system.get_file_info(fs.FileSelector(partition.path, recursive=partition.recursive))
        else:
            infos = system.get_file_info(partition.paths)
        for i in sorted(infos, key=lambda i: i.path):
            if i.type != fs.FileType.File or not self._wanted(i.path):
                continue
            key = NAME.search(posixpath.basename(i.path))
            with system.open_input_stream(i.path) as f:
                text = f.read().decode("utf-8", "replace")
            yield (int(key.group(1)) if key else None, posixpath.basename(i.path), i.mtime, text)


class LandedBooksWriter(DataSourceWriter):
    """Rows (book_id, text) as files; a newline ends each file."""

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.shards = int(options.get("shards", 1))
        system, root = file_system(self.path)
        if overwrite:
            from pyarrow import fs
            if system.get_file_info(root).type == fs.FileType.Directory:
                system.delete_dir_contents(root)
        system.create_dir(root, recursive=True)
        for s in range(self.shards):
            system.create_dir(f"{root}/{SHARD}{s:05d}", recursive=True)

    def write(self, rows):
        system, root = file_system(self.path)
        n, attempt = 0, uuid.uuid4().hex[:8]
        for row in rows:
            if row["book_id"] is None:
                continue  # a book without key has no name
            book, text = row["book_id"], row["text"] or ""
            folder = f"{root}/{SHARD}{shard_of(book, self.shards):05d}"
            part, final = f"{folder}/.book_id_{book}.{attempt}", f"{folder}/book_id_{book}.txt"
            with system.open_output_stream(part) as f:
                f.write((text + "\n").encode())
            system.move(part, final)
            n += 1
        return WriterCommitMessage()

    def commit(self, messages):
        pass  # every file is complete under its name already

    def abort(self, messages):
        pass  # complete files stay, as a rerun writes them again


class LandedBooks(DataSource):
    @classmethod
    def name(cls):
        return "landed_books"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return LandedBooksReader(self.options)

    def writer(self, schema, overwrite):
        return LandedBooksWriter(self.options, overwrite)


LISTED = "path string, modified_ns long"


def listed(spark, path: str, suffix: str = ".txt"):
    """(path, modified_ns) of every file of that extension in a folder and the folders in it, as they are now.

    Tasks list the folders, all those of a level together; the driver learns how many there are.  Returns
    the rows, which are persisted, and a function that lets go of them."""
    top = path.rstrip("/")

    def entries(batches):
        from pyarrow import fs
        system, root = file_system(top)
        for pdf in batches:
            for folder in pdf["path"]:
                found = [i for i in system.get_file_info(fs.FileSelector(folder or root))
                         if not posixpath.basename(i.path).startswith((".", "_"))]
                found = [i for i in found if i.type == fs.FileType.Directory or i.path.endswith(suffix)]
                if found:
                    yield pd.DataFrame({"path": [i.path for i in found],
                                        "modified_ns": pd.array([i.mtime_ns for i in found], dtype="Int64"),
                                        "folder": [i.type == fs.FileType.Directory for i in found]})

    most = 4 * spark.sparkContext.defaultParallelism
    levels, folders, n = [], spark.createDataFrame([("",)], "path string"), 1
    while n:
        levels.append(folders.repartition(min(n, most)).mapInPandas(entries, f"{LISTED}, folder boolean")
                      .persist(StorageLevel.MEMORY_AND_DISK))
        folders = levels[-1].filter("folder").select("path")
        n = folders.count()
    files = reduce(lambda a, b: a.unionByName(b), levels).filter("not folder").drop("folder")
    return files, lambda: [x.unpersist() for x in levels]


def contents(files, path: str):
    """(path, modified_ns, content) of listed files under ``path``; files of no bytes are left out."""
    top = path.rstrip("/")

    def read(batches):
        system, _ = file_system(top)
        for pdf in batches:
            held, size = [], 0
            for name, modified in zip(pdf["path"], pdf["modified_ns"]):
                with system.open_input_stream(name) as f:
                    content = f.read()
                if content:
                    held.append((name, modified, content))
                    size += len(content)
                if size >= BATCH_BYTES:
                    yield pd.DataFrame(held, columns=["path", "modified_ns", "content"])
                    held, size = [], 0
            if held:
                yield pd.DataFrame(held, columns=["path", "modified_ns", "content"])

    return files.mapInPandas(read, f"{LISTED}, content binary")


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedBooks)
