"""Numbered documents that concurrent writers agree on.

A folder holds one small JSON document per number, each created exactly once: a
document is written under a name of its own and then renamed without
overwriting, so of two writers that want one number, one fails and looks again.
This is the only place where writers meet; data files are written beforehand,
under fresh names, and count only once a document names them.

Readers never list the folder. They start at a hint that writers leave, look
for higher numbers until one is missing, and read back to the last document
that stands for all before it (``whole``).
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_HINT = "_latest"


class Versions:
    """The documents below ``path``, numbered from 0."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def _fs(self):
        return self._at("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _create(self, name: str, text: str, overwrite: bool) -> bool:
        """Make a whole file appear at once; False if it is there already and may not be replaced."""
        jvm = self.spark._jvm
        draft = self._at(f"_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if overwrite else rename.NONE
        try:
            context.rename(draft, self._at(name), how)
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if not overwrite and e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def _text(self, name: str) -> str | None:
        fs, at = self._fs, self._at(name)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def latest(self) -> int:
        """The highest number in use, -1 for none."""
        hint = (self._text(_HINT) or "").strip()
        n = int(hint) if hint.isdigit() else -1
        while self.has(n + 1):
            n += 1
        return n

    def has(self, n: int) -> bool:
        return self._fs.exists(self._at(name_of(n)))

    def get(self, n: int) -> dict:
        return json.loads(self._text(name_of(n)))

    def put(self, n: int, document: dict) -> bool:
        """Create document ``n``; False if another writer was first."""
        if not self._create(name_of(n), json.dumps(document), overwrite=False):
            return False
        self._hint(n)
        return True

    def _hint(self, n: int) -> None:
        """Where readers begin to look; a stale one costs them some looks, nothing else."""
        self._create(_HINT, str(n), overwrite=True)

    def tail(self, upto: int | None = None) -> list[tuple[int, dict]]:
        """(number, document) from the last whole one up to ``upto``, in order."""
        n = self.latest() if upto is None else upto
        found = []
        while n >= 0:
            found.append((n, self.get(n)))
            if found[-1][1].get("whole"):
                break
            n -= 1
        return found[::-1]

    def append(self, document: dict) -> int:
        """Put the document under the next free number, however many writers there are."""
        n = self.latest() + 1
        while not self.put(n, document):
            n = self.latest() + 1
        return n


def name_of(n: int) -> str:
    return f"{n:020d}.json"
