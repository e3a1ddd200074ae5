"""The few file-system calls Spark's reader and writer do not offer."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import SparkSession


class Folder:
    """A folder on whatever file system Spark resolves its path to."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self.path = path.rstrip("/")
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def child(self, name: str) -> "Folder":
        return Folder(self._spark, f"{self.path}/{name}")

    def exists(self) -> bool:
        return self._fs.exists(self._hadoop)

    def names(self) -> list[str]:
        """Direct children only; hidden and marker files are left out."""
        if not self.exists():
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._hadoop))
        return sorted(n for n in found if "=" in n or not n.startswith(("_", ".")))

    def size(self) -> tuple[int, int]:
        """(bytes, files) below the folder, from the file system's own summary."""
        summary = self._fs.getContentSummary(self._hadoop)
        return summary.getLength(), summary.getFileCount()

    def file_sizes(self) -> list[int]:
        """Bytes of every data file below the folder."""
        found, sizes = self._fs.listFiles(self._hadoop, True), []
        while found.hasNext():
            status = found.next()
            if not status.getPath().getName().startswith(("_", ".")):
                sizes.append(status.getLen())
        return sizes

    def write(self, content: bytes) -> None:
        """Make a file of this name, with the folders above it."""
        out = self._fs.create(self._hadoop)
        out.write(bytearray(content))
        out.close()

    def read(self) -> bytes:
        """The whole content of a small file."""
        size = self._fs.getFileStatus(self._hadoop).getLen()
        jvm, opened = self._spark._jvm, self._fs.open(self._hadoop)
        try:
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(opened, size))
        finally:
            opened.close()

    def modified(self) -> dt.datetime:
        """When the folder or a file in it last changed."""
        times, found = [self._fs.getFileStatus(self._hadoop).getModificationTime()], \
            self._fs.listFiles(self._hadoop, True)
        while found.hasNext():
            times.append(found.next().getModificationTime())
        return dt.datetime.fromtimestamp(max(times) / 1000, dt.timezone.utc)

    def hidden_names(self) -> list[str]:
        """Direct children that readers of the folder don't see."""
        if not self.exists():
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._hadoop))
        return sorted(n for n in found if n.startswith("_"))

    def folders_with_files(self, levels: int) -> list[str]:
        """Partition folders so many levels down that hold files, as paths from here."""
        if not levels:
            return [""] if self.names() else []
        return [f"{n}/{p}".rstrip("/") for n in self.names() if "=" in n
                for p in self.child(n).folders_with_files(levels - 1)]

    def date(self, time: dt.datetime) -> None:
        """Set when the file last changed."""
        self._fs.setTimes(self._hadoop, int(time.timestamp() * 1000), -1)

    def make(self) -> None:
        self._fs.mkdirs(self._hadoop)

    def move_to(self, target: "Folder") -> None:
        self._fs.mkdirs(target._hadoop.getParent())
        if not self._fs.rename(self._hadoop, target._hadoop):
            raise OSError(f"cannot move {self.path} to {target.path}")

    def delete(self) -> None:
        self._fs.delete(self._hadoop, True)


#: File systems whose rename never replaces a file, so that a finished file can get its name.
RENAMES = ("hdfs", "viewfs")


def publish(target: Folder, content: bytes) -> bool:
    """Create a small file as a whole, if there is none of its name; False if there is.

    A local file is written under another name and then linked, one on HDFS renamed: both fail
    if the name is taken. Object stores show a file only when it is closed, and make the create
    itself conditional.
    """
    fs, path = target._fs, target._hadoop
    if target.exists():
        return False
    jvm, scheme = target._spark._jvm, fs.getUri().getScheme()
    fs.mkdirs(path.getParent())
    if scheme != "file" and scheme not in RENAMES:
        try:
            out = fs.create(path, False)
            out.write(bytearray(content))
            out.close()
            return True
        except Py4JJavaError:
            if target.exists():
                return False
            raise
    draft = Folder(target._spark, f"{path.getParent().toString()}/.{uuid.uuid4().hex}")
    draft.write(content)
    try:
        if scheme == "file":
            local = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), _array(jvm))
                     for p in (path, draft._hadoop)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            names = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
            names.rename(draft._hadoop, path, _array(
                jvm, jvm.org.apache.hadoop.fs.Options.Rename.NONE,
                kind=jvm.org.apache.hadoop.fs.Options.Rename))
        return True
    except Py4JJavaError:
        if target.exists():
            return False
        raise
    finally:
        draft.delete()


def _array(jvm, *values, kind=None):
    """A Java array, as calls with any number of arguments take it."""
    array = SparkContext._gateway.new_array(kind or jvm.java.lang.String, len(values))
    for i, value in enumerate(values):
        array[i] = value
    return array


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the outermost partition column, from the folder names."""
    prefix = f"{column}="
    names = Folder(spark, path).names()
    return [n[len(prefix):] for n in names if n.startswith(prefix)]


def as_date(date: str | dt.date) -> dt.date:
    return date if isinstance(date, dt.date) else dt.date.fromisoformat(date)
