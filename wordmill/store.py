"""Files and folders of the store that Spark writes to (Hadoop's file systems,
through the session's JVM): existence, exclusive moves, names. Data is never
read or written here, only names and one-line commit files are."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


# The marker of a staged input; a folder written by a Spark job has _SUCCESS.
STAGED = "_STAGED"


class Store:
    """The file system of ``path``; all paths are strings."""

    def __init__(self, spark: SparkSession, path: str):
        sc = spark.sparkContext
        self._jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        self._no_options = sc._gateway.new_array(kind, 0)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _full(self, path: str):
        return self._fs.makeQualified(self._path(path))

    def qualified(self, path: str) -> str:
        """``path`` with the scheme and host of its file system, so that it means
        the same on every machine."""
        return self._full(path).toString()

    def beside(self, path: str, kind: str, tag: str | None = None) -> str:
        """A hidden name in the folder of ``path``: ``.<name>.<kind>-<tag>``, new
        without a tag (Spark's readers pass over names that start with a dot)."""
        full = self._full(path)
        return f"{full.getParent().toString().rstrip('/')}/.{full.getName()}.{kind}-{tag or uuid.uuid4().hex}"

    def kept_beside(self, path: str, kind: str) -> list[str]:
        """The paths that :meth:`beside` named and that exist."""
        full = self._full(path)
        start = f".{full.getName()}.{kind}-"
        parent = full.getParent()
        return [f"{parent.toString().rstrip('/')}/{name}" for name in self.names(parent.toString())
                if name.startswith(start)]

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_file(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isFile()

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if it is missing."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def move(self, source: str, target: str) -> bool:
        """Rename; False (and nothing done) where ``target`` exists. The folder
        of ``target`` is made. One rename of the store: no half-moved target."""
        to = self._full(target)
        self._fs.mkdirs(to.getParent())
        try:
            self._context.rename(self._full(source), to, self._no_options)
        except Exception as exc:
            if "FileAlreadyExists" in str(exc):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def complete(self, path: str) -> bool:
        """Whether ``path`` is a file, or a folder that a job finished (its
        marker is there)."""
        return self.is_file(path) or any(self.exists(f"{path}/{m}") for m in ("_SUCCESS", STAGED))

    def current(self, path: str) -> str:
        """Where the data of ``path`` is: there, or, if a replacement was cut
        off between its two renames, beside it: the new one if it is whole,
        else the old one. A path that nobody was replacing is just missing."""
        old = [] if self.exists(path) else self.kept_beside(path, "old")
        for moved in old:
            new = self.beside(path, "new", moved.rsplit("-", 1)[1])
            if self.complete(new):
                return new
        return next(iter(old), path)

    def replace(self, path: str, write) -> None:
        """``write(folder)`` in a hidden folder beside ``path``, then put that in
        its place by two renames. If the job fails, ``path`` is as it was; if
        the process dies between the renames, :meth:`current` finds the data
        and the next replacement goes on from there."""
        left = self.current(path)
        if left != path:
            self.move(left, path)
        tag = uuid.uuid4().hex
        new, old = self.beside(path, "new", tag), self.beside(path, "old", tag)
        try:
            write(new)
        except BaseException:
            self.delete(new)
            raise
        if self.exists(path):
            for rest in self.kept_beside(path, "old"):  # of a replacement that died at its end
                self.delete(rest)
            self.move(path, old)
        if not self.move(new, path):
            raise FileExistsError(f"{path} was written by another job; this one's result is in {new}")
        self.delete(old)

    def write_new(self, path: str, text: str) -> bool:
        """A small file with ``text``, whole or not at all; False where ``path``
        exists already."""
        draft = self.beside(path, "draft")
        stream = self._fs.create(self._path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.move(draft, path):
            return True
        self.delete(draft)
        return False
